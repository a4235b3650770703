"""Benchmark items found in documents, up to a budget of single-letter edits."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import texts

_WORD = re.compile(r"[^\W_]+")


def plain(text: str | None) -> str:
    """Lower-case runs of letters and digits, joined by single spaces."""
    return " ".join(_WORD.findall(text.lower())) if text else ""


@dataclass(frozen=True)
class Item:
    item_id: int | None
    text: str
    budget: int

    def pieces(self) -> list[tuple[str, int]]:
        """The text cut into budget + 1 parts of nearly equal length, each with its place."""
        parts = self.budget + 1
        cuts = [len(self.text) * i // parts for i in range(parts + 1)]
        return [(self.text[a:b], a) for a, b in zip(cuts, cuts[1:])]


def nearest(pattern: str, window: str, budget: int) -> tuple[int, int] | None:
    """(distance, end) of the window's part nearest to the pattern, if within the budget.

    Myers' bit-parallel recurrence, one step per character of the window, with
    the pattern's column of differences in two integers.
    """
    has: dict[str, int] = {}
    for i, c in enumerate(pattern):
        has[c] = has.get(c, 0) | 1 << i
    m = len(pattern)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    rise, fall, score = mask, 0, m
    best = (budget + 1, 0)
    for end, c in enumerate(window, 1):
        eq = has.get(c, 0)
        level = (((eq & rise) + rise) ^ rise) | eq | fall
        up, down = fall | (mask & ~(level | rise)), rise & level
        score += bool(up & top) - bool(down & top)
        up, down = up << 1 & mask, down << 1 & mask
        rise, fall = down | (mask & ~((eq | fall) | up)), up & (eq | fall)
        if score < best[0]:
            best = (score, end)
    return best if best[0] <= budget else None


class Finder:
    """Finds the items of one block in whole texts."""

    def __init__(self, items: list[Item]):
        import ahocorasick

        self.items = items
        self.automaton = ahocorasick.Automaton()
        owners: dict[str, list[tuple[int, int]]] = {}
        for i, item in enumerate(items):
            for piece, place in item.pieces():
                owners.setdefault(piece, []).append((i, place))
        for piece, at in owners.items():
            self.automaton.add_word(piece, (len(piece), at))
        if owners:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int | None, int, int]]:
        """(item_id, distance, end in the plain text) of every item within its budget."""
        if not self.items:
            return []
        whole = plain(text)
        spans: dict[int, list[tuple[int, int]]] = {}
        for last, (size, owners) in self.automaton.iter(whole):
            for i, place in owners:
                start, item = last + 1 - size - place, self.items[i]
                spans.setdefault(i, []).append((max(0, start - item.budget), start + len(item.text) + item.budget))
        found = []
        for i, hits in spans.items():
            item, best = self.items[i], None
            for start, end in _joined(hits):
                near = nearest(item.text, whole[start:end], item.budget)
                if near and (best is None or near[0] < best[0]):
                    best = (near[0], start + near[1])
            if best:
                found.append((item.item_id, *best))
        return found


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


@lru_cache(maxsize=2)
def _finder(items: tuple[Item, ...]) -> Finder:
    return Finder(list(items))


def blocks(benchmark: DataFrame, error_rate: float, min_chars: int, block_chars: int) -> Iterator[tuple[Item, ...]]:
    """The benchmark's items in blocks of about ``block_chars`` characters.

    Only one block is at the driver and with the tasks of a scan, so a large
    benchmark means more scans, not more memory.
    """
    total = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-total // block_chars))
    dealt = benchmark.select("item_id", "text", F.pmod(F.xxhash64("text"), F.lit(count)).alias("block"))
    for k in range(count):
        rows = dealt.filter(F.col("block") == k).select("item_id", "text").distinct().collect()
        cleaned = sorted({(r["item_id"] is None, r["item_id"] or 0, plain(r["text"])) for r in rows})
        yield tuple(Item(None if null else i, t, int(len(t) * error_rate)) for null, i, t in cleaned if len(t) >= min_chars)


def matches(
    docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.05, min_chars: int = 50, block_chars: int = 4_000_000
) -> DataFrame:
    """Every (document, benchmark item) with the item in the document's text.

    An item is in a text if some part of the text is within
    ``error_rate * length`` insertions, deletions and replacements of it, both
    reduced to lower-case letters and digits with single spaces. One of
    budget + 1 pieces of the item then stands in the text unchanged; pieces are
    found exactly and the surroundings verified. Returns doc_id, item_id,
    distance (the least) and ends_at (where the nearest part ends in the reduced
    text; the first such).

    Null and empty texts match nothing. Items of under ``min_chars`` reduced
    characters (null texts too) are no evidence and are left out. Repeated
    documents give repeated rows, equal items one row for each item_id. Other
    columns are ignored.
    """
    read = docs.select("doc_id", "text")
    out = None
    for items in blocks(benchmark, error_rate, min_chars, block_chars):

        def rows(columns: dict[str, list], items=items) -> Iterator[tuple]:
            finder = _finder(items)
            for doc_id, text in zip(columns["doc_id"], columns["text"]):
                for item_id, distance, end in finder.find(text):
                    yield doc_id, item_id, distance, end

        found = texts.map_rows(read, rows, "doc_id long, item_id long, distance int, ends_at long")
        out = found if out is None else out.unionByName(found)
    return out


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.05, min_chars: int = 50, block_chars: int = 4_000_000
) -> DataFrame:
    """The documents without any benchmark item, all columns kept; see ``matches``."""
    place = docs.columns.index("text")
    for items in blocks(benchmark, error_rate, min_chars, block_chars):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            finder = _finder(items)
            for batch in batches:
                clean = [not finder.find(text) for text in batch.column(place).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pc.filter(c, pa.array(clean, pa.bool_())) for c in batch.columns], names=batch.schema.names
                )

        docs = docs.mapInArrow(run, docs.schema)
    return docs
