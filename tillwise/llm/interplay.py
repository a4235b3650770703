"""What each filter removes in every order of the filters, by ranks of permutations."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm import texts
from tillwise.sources import scratch

FILTERS = "ABCDE"
#: The marks that filter D looks for.
MARKS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
#: Bytes of UTF-8 that begin no character.
CONTINUED = bytes(range(0x80, 0xC0))


def failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails: short, few distinct words, capitals, marks."""
    n_words, distinct = 0, set()
    for words in texts.word_pieces(text):
        n_words += len(words)
        distinct.update(words)
    points = len(text.translate(None, CONTINUED))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    marked = len(text.translate(None, MARKS)) < len(text)
    failed = (n_words < 200, 100 * len(distinct) < 50 * n_words, 100 * capitals > 2 * points, marked)
    return sum(fails << bit for bit, fails in enumerate(failed))


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, text_key) of every document: bits of A to D and a digest of the text; null text is empty."""

    def rows(columns: dict[str, list]) -> Iterator[tuple]:
        for doc_id, part, text in zip(columns["doc_id"], columns["part"], columns["text"]):
            text = text or b""
            yield doc_id, part, failures(text), hashlib.sha256(text).digest()[:16]

    plain = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.col("text").cast("binary").alias("text"))
    return texts.map_rows(plain, rows, "doc_id long, part string, mask int, text_key binary")


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the set of filters they fail.

    Filter E fails where the same text stands under a smaller doc_id anywhere in
    the table; a null doc_id is neither smaller nor larger. The first doc_id of a
    text comes from a partial aggregate and is joined back by text and doc_id
    together, so that copies of one text do not meet in one task. A document is
    good or toxic if any of its labels says so.
    """
    seen = scratch.stage(judged(docs), "judged")
    first = seen.filter("doc_id is not null").groupBy("text_key").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = (
        labels.groupBy("doc_id")
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
        .filter("doc_id is not null")
    )
    copied = F.col("first").isNull() & F.col("doc_id").isNotNull()
    whole = seen.join(first, ["doc_id", "text_key"], "left").join(marks, "doc_id", "left")
    by_mask = whole.select("part", F.col("mask").bitwiseOR(copied.cast("int") * 16).alias("mask"), "good", "toxic")
    return by_mask.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")
    )


def rank_interval(prefix: tuple[int, ...], n: int) -> tuple[int, int]:
    """Lexicographic ranks, the last one excluded, of the permutations of 0..n-1 that begin with ``prefix``.

    Each item of the prefix counts the smaller items that are still free, its
    Lehmer digit, times the permutations of what comes after it.
    """
    start = 0
    for i, item in enumerate(prefix):
        smaller = sum(x not in prefix[:i] for x in range(item))
        start += smaller * factorial(n - 1 - i)
    return start, start + factorial(n - len(prefix))


def removal_ends(n: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, rank, sign): ends of the rank intervals in which a mask's documents go at a step.

    They go at the first of their filters: the orders that begin with step - 1
    other filters and then one of theirs.
    """
    ends = []
    for mask in range(1 << n):
        own = [f for f in range(n) if mask >> f & 1]
        others = [f for f in range(n) if not mask >> f & 1]
        for step in range(1, len(others) + 2):
            for before in permutations(others, step - 1):
                for f in own:
                    start, end = rank_interval((*before, f), n)
                    ends += [(mask, step, start, 1), (mask, step, end, -1)]
    return ends


def totals(by_mask: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from (part, mask, n, good, toxic).

    Each mask adds its counts at the starts of its rank intervals and takes them
    off at their ends; a running sum over the ranks of a part gives what goes at
    each step in every order. The work is one row per part, mask and interval
    end, whatever the number of documents; a part has at most 2^n masks. Parts
    with no documents have no rows.
    """
    spark, n = by_mask.sparkSession, len(filters)
    steps = range(1, n + 1)
    measures = ("n", "good", "toxic")
    ends = spark.createDataFrame(removal_ends(n), "mask int, step int, rank int, sign int")
    by_mask = scratch.stage(by_mask.repartition("part"), "masks")
    grid = by_mask.select("part").distinct().select(
        "part", F.lit(1).alias("step"), F.explode(F.sequence(F.lit(0), F.lit(factorial(n) - 1))).alias("rank"), *(F.lit(0).alias(m) for m in measures)
    )
    change = by_mask.join(F.broadcast(ends), "mask").select("part", "step", "rank", *((F.col("sign") * F.col(m)).alias(m) for m in measures))
    here = [
        F.sum(F.when(F.col("step") == s, F.col(m)).otherwise(0)).alias(f"{m}{s}") for s in steps for m in measures
    ]
    changes = change.unionByName(grid).groupBy("part", "rank").agg(*here)
    upto = Window.partitionBy("part").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    gone = changes.select("part", "rank", *(F.sum(f"{m}{s}").over(upto).alias(f"{m}{s}") for s in steps for m in measures))
    orders = spark.createDataFrame([(i, "".join(p)) for i, p in enumerate(permutations(filters))], "rank int, filter_order string")
    ordered = gone.join(F.broadcast(orders), "rank")

    fails = [F.sum(F.when(F.col("mask").bitwiseAND(F.lit(1 << f)) > 0, F.col("n")).otherwise(0)) for f in range(n)]
    alone = [F.sum(F.when(F.col("mask") == 1 << f, F.col("n")).otherwise(0)) for f in range(n)]
    of_part = by_mask.groupBy("part").agg(F.sum("n").alias("total"), F.array(*fails).alias("fails"), F.array(*alone).alias("alone"))

    def step_row(s: int) -> Column:
        kept = F.col("total") - sum((F.col(f"n{t}") for t in range(2, s + 1)), F.col("n1"))
        at = F.instr(F.lit(filters), F.substring("filter_order", s, 1)) - 1
        return F.struct(
            F.lit(s).alias("step"), at.alias("filter_at"), kept.alias("kept"), F.col(f"n{s}").alias("removed"),
            (F.get("fails", at) - F.col(f"n{s}")).alias("redundant"), F.get("alone", at).alias("unique_fails"),
            F.col(f"good{s}").alias("good_lost"), F.col(f"toxic{s}").alias("toxic_lost"),
        )

    rows = ordered.join(of_part, "part").select("part", "filter_order", F.explode(F.array(*(step_row(s) for s in steps))).alias("s"))
    rows = rows.select("part", "filter_order", "s.*")
    every = Window.partitionBy("part", "filter_at")
    return rows.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        F.sum("removed").over(every).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What five filters remove, alone and together, in each of their 120 orders, by source.

    A: under 200 words; B: under half of the words are distinct; C: more than 2 %
    of the characters are A to Z; D: holds one of the marks; E: the same text
    stands under a smaller doc_id. Returns part (the source; null as empty),
    filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley, 600 rows per part.

    A null text is empty: it fails A, and E if it is not the first. Repeated rows
    count each; rows that share doc_id and text are not copies of each other. An
    empty table gives no rows. Other columns are not looked at.
    """
    return totals(masks(docs, labels))
