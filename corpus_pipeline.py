"""From raw documents to a token file: the stages in order, each written before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import decontaminate, langid, mixing, simhash
from tillwise.llm.registry import token_file
from tillwise.llm.texts import fold, read_table
from tillwise.sources import scratch


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from their labels."""
    taught = docs.filter(fold(F.col("doc_id"), 4) != 2)
    profiles = langid.learn(taught)
    return langid.keep_identified(docs, profiles, bounds=langid.least_cosines(taught, profiles))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights ask for, the last time in part."""
    return mixing.take(docs)


#: Words a worker keeps when it writes tokens: fewer than it could, as the other stages leave their memory with the same executor.
REMEMBERED = 100_000


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token file, and its index as read back: doc_id, start, n_tokens, ids_crc32."""
    return token_file(docs, REMEMBERED)


STAGES = [
    ("language", language),
    ("near duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("mix", mix),
    ("tokens", tokens),
]

#: The rows come from learned profiles, trees and a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each is written as a table that the next one reads."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
