import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.llm import langid
from tillwise.llm.texts import fold

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def profiles(docs):
    return langid.learn(docs.filter(fold(F.col("doc_id"), 4) != 2))


def brute_bundle(text, seed, dimensions):
    """Letter by letter: the sum over trigrams of rotated, multiplied letter vectors."""
    runs = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    symbols = f" {' '.join(runs)} " if runs else " "
    vector = np.zeros(dimensions)
    for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
        one, two, three = (langid._letter(0 if s == " " else ord(s), seed, dimensions).astype(int) for s in (a, b, c))
        vector += np.roll(one, 2) * np.roll(two, 1) * three
    return vector


def test_bundles_are_sums_of_bound_trigrams():
    texts = ["Été, 12 the-cat", None, "", "!!", "a", "中文 text  中文", "the the THE"]
    got = langid.bundle(texts, 7, 64)
    for text, row in zip(texts, got):
        assert np.array_equal(row, brute_bundle(text or "", 7, 64))


def test_large_alphabets_give_the_same(monkeypatch):
    texts = ["abc def ghi", "xyz zyx", "qrs"]
    small = langid.bundle(texts, 7, 64)
    monkeypatch.setattr(langid, "CELLS", 2)
    monkeypatch.setattr(langid, "GRAMS", 3)
    assert np.array_equal(langid.bundle(texts, 7, 64), small)


def test_held_out_accuracy(docs, profiles):
    got = langid.identify(docs, profiles, ["doc_id", "lang", "n_chars"]).filter(fold(F.col("doc_id"), 4) == 2).toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.99 and got.score.between(0, 1).all()


def test_only_the_text_counts(docs, profiles):
    blind = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("s"), "doc_id": F.col("doc_id") + 5})
    one = langid.identify(docs, profiles, ["doc_id"]).collect()
    two = langid.identify(blind, profiles, ["doc_id"]).collect()
    assert sorted((r.doc_id + 5, r.lang_pred, r.score) for r in one) == sorted(map(tuple, two))


def test_prototypes_do_not_depend_on_the_dealing(docs, profiles):
    again = langid.learn(docs.filter(fold(F.col("doc_id"), 4) != 2).repartition(5))
    assert again.languages == profiles.languages and np.array_equal(again.prototypes, profiles.prototypes)


def test_messy_rows(messy, none, profiles):
    got = langid.identify(messy, profiles, ["doc_id", F.lit(1).alias("n")]).collect()
    assert len(got) == 12
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {1, 2, 3, 10} and all(r.score == 0 for r in got if r.lang_pred == "und")
    kept = langid.keep_identified(messy, profiles)
    assert kept.columns == messy.columns and {r.doc_id for r in kept.collect()} >= {None, 4, 5, 6, 9} and 10 not in {r.doc_id for r in kept.collect()}
    assert langid.identify(none, profiles, ["doc_id"]).count() == 0
    empty = langid.learn(none)
    assert {r.lang_pred for r in langid.identify(messy, empty, ["doc_id"]).collect()} == {"und"}
    taught = langid.learn(messy)
    assert taught.languages == ["de", "en", "fr"]


@pytest.mark.parametrize("left_out", ["de", "fr"])
def test_a_language_left_out_is_rejected_and_clean_texts_stay(spark, left_out):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(8)
    learned, held_out = F.col("lang") != left_out, fold(F.col("doc_id"), 4) == 2
    taught = docs.filter(learned & ~held_out)
    profiles = langid.learn(taught)
    bounds = langid.least_cosines(taught, profiles)
    long = docs.filter(F.length("text") >= 200)

    def share(some):
        return langid.keep_identified(some, profiles, bounds=bounds).count() / some.count()

    assert share(long.filter(~learned)) < 0.07 and share(long.filter(learned & held_out)) > 0.985


def test_bounds_need_enough_texts(docs, profiles, none):
    few = langid.least_cosines(docs.filter("doc_id < 50"), profiles)
    assert (few == 0.15).all() and few.shape == (len(profiles.languages), langid.BINS)
    assert (langid.least_cosines(docs, profiles) > 0.15).any()
    assert langid.least_cosines(none, langid.learn(none)).shape == (0, langid.BINS)


def test_long_texts_are_bundled_in_parts(monkeypatch):
    """Cuts change nothing, and a long text takes little more memory than itself."""
    import tracemalloc

    texts = ["ab c d1ef. Été ΑΣ. b 12 34 x" * 9, "abcdefghij" * 8, "a", None, "12 34 " * 30, "a1b2c3,d4" * 12, " x  y " * 20]
    whole = langid.bundle(texts, 7, 64)
    monkeypatch.setattr(langid, "CHARS", 10)
    got = np.zeros_like(whole)
    for piece, vectors in langid.bundles(texts, 7, 64):
        got[piece] = vectors
    assert np.array_equal(got, whole)
    monkeypatch.undo()
    text = "some words, and Ünïcode 12 " * 400_000
    tracemalloc.start()
    list(langid.bundles([text], 7, 1024))
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()


def test_many_short_texts_take_little_memory():
    import tracemalloc

    tracemalloc.start()
    rows = sum(len(v) for _, v in langid.bundles([f"word {i}" for i in range(10_000)], 7, 1024))
    assert rows == 10_000 and tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()


def test_cosines_by_brute_force(docs, profiles):
    """Prototypes are the sums of their texts' bundles, scores the cosines with the nearest."""
    taught = docs.filter(fold(F.col("doc_id"), 4) != 2).filter("lang is not null and text is not null and doc_id < 60").collect()
    learned = langid.learn(docs.filter(fold(F.col("doc_id"), 4) != 2).filter("doc_id < 60"), 7, 64)
    for lang, prototype in zip(learned.languages, learned.prototypes):
        assert np.array_equal(prototype, sum(brute_bundle(r.text, 7, 64) for r in taught if r.lang == lang))
    texts = [r.text for r in docs.filter("doc_id between 60 and 75").collect()]
    for text, (lang, score) in zip(texts, learned.predict(texts)):
        v = brute_bundle(text or "", 7, 64)
        cosines = [float(v @ p / np.linalg.norm(v) / np.linalg.norm(p)) if v.any() else 0.0 for p in learned.prototypes]
        if v.any():
            assert lang == learned.languages[int(np.argmax(cosines))] and abs(score - max(0.0, *cosines)) < 1e-9
