import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) or longer rows."""

    def build(rows, *, extra=False):
        full = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
        docs = spark.createDataFrame(full, SCHEMA)
        if extra:  # names that operators use inside or return
            for name in ("fp", "size", "score", "words", "place", "row", "kept", "label", "text_hash", "found", "k", "taken"):
                docs = docs.withColumn(name, F.lit("x"))
        return docs

    return build


MESSY = [
    (1, None, "en", "a"), (2, "", None, "a"), (3, " \t\n\r ", "en", None), (4, "one", None, None), (None, "no name at all", "en", "b"),
    (5, "the same text twice in a row of words", "en", "a"), (5, "the same text twice in a row of words", "en", "a"),
    (6, "the same text twice in a row of words", "fr", "b"), (7, LONG, "en", "b"), (8, "ÉTÉ çà 中文 – \x1c  x", "fr", "c"),
    (9, "a\nb\nc\nd\n\n\n\n\na\nb\nc\nd", None, "c"), (10, "!!! ... 12 34", "de", "c"),
]


@pytest.fixture(scope="session")
def messy(make):
    return make(MESSY, extra=True)


@pytest.fixture(scope="session")
def none(make):
    return make([])
