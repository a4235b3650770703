"""Repeated passages: windows of three consecutive lines that stood in the corpus before."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import texts
from tillwise.sources import scratch

#: Lines of a window.
WINDOW = 3


def windows(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, at, a, b): each window of consecutive lines with a word in it; a, b are 128 bits of hash."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.split("text", "\n").alias("lines"))
    starts = F.when(F.size("lines") >= width, F.sequence(F.lit(0), F.size("lines") - width))

    def window(i):
        rows = [F.get("lines", i + k) for k in range(width)]
        return F.struct(
            i.alias("at"), F.xxhash64(*rows).alias("a"), F.xxhash64(F.lit("b"), *rows).alias("b"),
            F.concat(*rows).rlike(texts.WORD).alias("worded"),
        )

    found = lines.select("doc_id", "text_hash", F.explode(F.transform(starts, window)).alias("w"))
    return found.filter("w.worded").select("doc_id", "text_hash", "w.at", "w.a", "w.b")


def later_windows(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, at) of every window that also stands at an earlier place.

    Places are ordered by doc_id (null first), a hash of the text and the line.
    The earliest place of a window comes from a partial aggregate and goes back by
    a join that broadcasts the few windows with very many places, so these are
    never gathered in one task.
    """
    found = scratch.stage(windows(docs, width), "line-windows")
    place = F.struct("doc_id", "text_hash", "at")
    repeated = found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1")
    later = texts.spread_join(found, repeated, ["a", "b"], "n", found.count()).filter(~place.eqNullSafe(F.col("first")))
    return later.select("doc_id", "text_hash", "at")


def remove_repeated(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """Texts without the lines that a later occurrence of a repeated window covers.

    Lines are what stands between newlines, compared as they are; a window is
    ``width`` consecutive lines, at least one with a word. Of the places where a
    window stands in the whole corpus the earliest is kept, so some copy of every
    line survives. Returns doc_id, text, n_lines and n_removed, one row per input
    row.

    A null text stays null with no lines; an empty text is one empty line; texts
    shorter than a window never change; a text that is removed whole becomes
    empty. Rows that repeat both doc_id and text count as one document and are
    treated alike. Other columns are left out.
    """
    covered = later_windows(docs, width).groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("starts"))
    covered = covered.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), "starts")
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    same = hashed["doc_id"].eqNullSafe(covered["of_id"]) & (hashed["text_hash"] == covered["of_hash"])
    joined = hashed.join(covered, same, "left").select("doc_id", "text", "starts")

    def rows(columns: dict[str, list]) -> Iterator[tuple]:
        for doc_id, text, starts in zip(columns["doc_id"], columns["text"], columns["starts"]):
            if text is None:
                yield doc_id, None, 0, 0
                continue
            lines = text.split("\n")
            gone = {at + k for at in starts or () for k in range(width)}
            yield doc_id, "\n".join([line for i, line in enumerate(lines) if i not in gone]), len(lines), len(gone)

    return texts.map_rows(joined, rows, "doc_id long, text string, n_lines long, n_removed long", flush=2000)
