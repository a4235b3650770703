"""The operators as registered queries, and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import brown, centroids, decontaminate, hostrep, interplay, isolation, langid, linededup, lshforest, mixing, pii, simhash, sql, tokenfile
from tillwise.llm.texts import fold, read_table
from tillwise.sources import scratch


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(read_table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", "taken")


#: Pseudonyms are as secret as this key; a real run takes its own.
PSEUDONYM_KEY = "test tables"


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymise(read_table(spark, sf_dir, "documents"), PSEUDONYM_KEY)
    return found.select("doc_id", "text", F.size("found").cast("long").alias("n_found"), F.array_join("found", ",").alias("kinds"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.remove_repeated(read_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = (fold(F.col("doc_id"), 4) == 2).alias("held_out")
    profiles = langid.learn(docs.filter(fold(F.col("doc_id"), 4) != 2))
    return langid.identify(docs, profiles, ["doc_id", held_out])


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return isolation.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


#: Rounds of exchange end when they bring less than a hundredth of a nat a token.
CLASS_MODEL = brown.Settings(held=65_536, least_gain=0.01)


def op8_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 10) == 0
    return brown.score(read_table(spark, sf_dir, "documents"), ~held_out, held_out, CLASS_MODEL)


def token_file(docs: DataFrame, remembered: int = 600_000) -> DataFrame:
    """Write the documents' ids to a new token file in the shared folder and index it from the file."""
    import public_tokenizers

    path = scratch.new_path(docs.sparkSession, "tokens")
    tokenfile.write(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2, remembered=remembered)
    return tokenfile.read_index(docs.sparkSession, path)


def op9_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file(read_table(spark, sf_dir, "documents"))


RULES = [
    hostrep.Rule("allow", "com", "/"),
    hostrep.Rule("block", "example.com", "/en/"),
    hostrep.Rule("allow", "www.example.com", "/en/"),
    hostrep.Rule("block", "net", "/es/"),
    hostrep.Rule("block", "net", "/fr/"),
]


def op10_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's url ends in the number of the document it was made from, whose labels are its outcome."""
    pages = read_table(spark, sf_dir, "pages")
    number = F.regexp_extract(hostrep.path_of(F.col("url")), "^/[^/]*/([0-9]{1,18})(?:[^0-9]|$)", 1)
    numbered = pages.select("page_id", number.try_cast("long").alias("doc_id"))
    labels = read_table(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
    outcomes = numbered.join(labels, "doc_id").select("page_id", "good")
    return hostrep.judge(pages, outcomes, RULES).drop("bound")


def op11_interplay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interplay.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lshforest.near_duplicates(read_table(spark, sf_dir, "documents"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read_table(spark, sf_dir, "embeddings"))


ALL = [
    op1_mixing, op2_pii, op3_line_dedup, op4_language_id, op5_quality_rules, op6_decontaminate, op7_simhash, op8_brown_lm,
    op9_token_file, op10_host_reputation, op11_interplay, op12_lsh_forest, op13_centroids,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in ALL}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLE)
