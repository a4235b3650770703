"""Quality rules: statistics of whole texts, and an isolation forest over them."""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm import texts
from tillwise.sources import scratch

SPACE, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
MARKS = string.punctuation.encode()
RUN = 5
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTS = [*BASE, "n_marks"]
#: Scores are counted in so many steps when the threshold is looked for.
STEPS = 2000


def _repeated_words(words: list[bytes]) -> int:
    """Words in a run of five that stands in the text twice or more."""
    runs = list(zip(*[words[k:] for k in range(RUN)]))
    if len(set(runs)) == len(runs):
        return 0
    times, covered = Counter(runs), bytearray(len(words))
    for i, run in enumerate(runs):
        if times[run] > 1:
            covered[i : i + RUN] = b"\1" * RUN
    return sum(covered)


def measure(text: bytes | None) -> tuple[int, ...]:
    """The counts named in COUNTS; all are 0 for a null or wordless text's words."""
    text = text or b""
    words = text.split()
    without = text.translate(None, SPACE)
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (
        len(words), len(without.decode()), len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
        _repeated_words(words), len(text) - len(text.translate(None, MARKS)),
    )


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, COUNTS) of every document."""

    def rows(columns: dict[str, list]) -> Iterator[tuple]:
        for doc_id, text in zip(columns["doc_id"], columns["text"]):
            yield doc_id, *measure(text)

    whole = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("binary").alias("text"))
    return texts.map_rows(whole, rows, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def features(counts: np.ndarray) -> np.ndarray:
    """What the forest sees: letters per word, symbols per word and punctuation per letter.

    None grows with the text. Repeated words and lines are left to the base
    rules: most texts have none, which makes any repetition look anomalous.
    """
    column = dict(zip(COUNTS, counts.astype(np.float64).T))
    words, chars = np.maximum(column["n_words"], 1), np.maximum(column["word_chars"], 1)
    return np.stack([chars / words, np.log1p(100 * column["n_symbols"] / words), column["n_marks"] / chars], axis=1)


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary search tree of n points."""
    n = np.asarray(n, np.float64)
    many = 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, many, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays, one row each: the feature and cut of inner nodes, and the path length at leaves."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    path: np.ndarray
    depth: int
    norm: float

    def score(self, points: np.ndarray) -> np.ndarray:
        """Anomaly from 0 to 1: two to the power of minus the mean path length over the usual one."""
        total = np.zeros(len(points))
        rows = np.arange(len(points))
        for feature, cut, child, path in zip(self.feature, self.cut, self.child, self.path):
            at = np.zeros(len(points), np.int64)
            for _ in range(self.depth):
                at = child[at] + (points[rows, feature[at]] >= cut[at]) * (child[at] != at)
            total += path[at]
        return 2.0 ** (-total / len(self.path) / self.norm)


def grow(points: np.ndarray, trees: int, sample: int, seed: int) -> Forest:
    """An isolation forest: random features cut at random values, down to log2(sample) levels."""
    random = np.random.default_rng(seed)
    sample = min(sample, len(points))
    depth = max(1, int(np.ceil(np.log2(max(sample, 2)))))
    size = 2 ** (depth + 1)
    shape = (trees, size)
    feature, cut, path = np.zeros(shape, np.int64), np.full(shape, np.inf), np.zeros(shape)
    child = np.tile(np.arange(size), (trees, 1))
    for t in range(trees):
        nodes, free = [(0, random.choice(len(points), sample, replace=False), 0)], 1
        while nodes:
            at, rows, level = nodes.pop()
            low, high = points[rows].min(0), points[rows].max(0)
            open_features = np.flatnonzero(high > low)
            if level == depth or len(rows) <= 1 or not len(open_features):
                path[t, at] = level + average_path(len(rows))
                continue
            f = random.choice(open_features)
            feature[t, at], cut[t, at], child[t, at] = f, random.uniform(low[f], high[f]), free
            right = points[rows, f] >= cut[t, at]
            nodes += [(free, rows[~right], level + 1), (free + 1, rows[right], level + 1)]
            free += 2
    return Forest(feature, cut, child, path, depth, float(max(average_path(sample), 1e-9)))


@dataclass(frozen=True)
class Settings:
    """The forest is grown on ``good_rows`` good labelled rows at most and a hundredth of that of bad ones.

    Rows are chosen by a hash of doc_id. Bad rows must be rare among them: a
    forest finds what few rows have, and without any it would never cut between them.
    """

    good_rows: int = 4096
    good_per_bad: int = 100
    trees: int = 100
    sample: int = 256
    seed: int = 7
    most_good_lost: float = 0.005


def threshold(histogram: list[tuple[int, int, int]], most_good_lost: float) -> float:
    """The score from which documents go, from (step, quality, rows).

    Of the steps that cost at most that share of the good rows, the one that
    separates good from bad rows best; of equally good neighbours the middle one,
    of several such runs the highest. Without good or without bad rows nothing goes.
    """
    good, bad = np.zeros(STEPS + 2), np.zeros(STEPS + 2)
    for step, quality, n in histogram:
        (good if quality else bad)[step] += n
    if not good.sum() or not bad.sum():
        return 2.0
    lost, caught = good[::-1].cumsum()[::-1] / good.sum(), bad[::-1].cumsum()[::-1] / bad.sum()
    gain = np.where(lost <= most_good_lost, caught - lost, -1)
    best = np.flatnonzero(gain == gain.max())
    run = best[best - np.arange(len(best)) == best[-1] - len(best) + 1]
    return (int(run[0]) + int(run[-1])) // 2 / STEPS


def judge(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Counts and verdict of every document.

    Returns doc_id, the counts in BASE, base_failed (under 10 words, or over a
    fifth of them in repeated runs of five), kept and score. ``kept`` is false if
    the base rules fail, else if the forest's score reaches the threshold that
    all labelled rows give.

    ``labels`` has doc_id and quality (1 good, 0 bad); null quality and unknown or
    null documents say nothing; of several labels the lowest counts. Without good
    or bad labelled rows the base rules alone decide. Null and wordless texts have
    counts of 0 and fail. Repeated rows are judged alike. Other columns are left out.
    """
    counted = scratch.stage(statistics(docs), "statistics")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    counted = counted.withColumn("base_failed", failed)
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    labelled = counted.filter("not base_failed").join(known, "doc_id")
    order = [F.xxhash64("doc_id", F.lit(settings.seed)), "doc_id", *COUNTS]

    def some(quality: int, most: int) -> np.ndarray:
        rows = labelled.filter((F.col("quality") > 0) == bool(quality)).orderBy(*order).limit(most)
        return rows.select(*COUNTS).toPandas().to_numpy(np.int64)

    good = some(1, settings.good_rows)
    bad = some(0, -(-len(good) // settings.good_per_bad))
    if not len(good) or not len(bad):
        decided = counted.withColumn("kept", ~F.col("base_failed")).withColumn("score", F.lit(0.0))
        return decided.select("doc_id", *BASE, "base_failed", "kept", "score")
    forest = grow(features(np.concatenate([good, bad])), settings.trees, settings.sample, settings.seed)
    scored = scratch.stage(_scored(counted, forest), "isolation")
    step = F.floor(F.col("score") * STEPS).cast("int")
    seen = scored.filter("not base_failed").join(known, "doc_id").groupBy(step.alias("step"), (F.col("quality") > 0).cast("int").alias("good"))
    limit = threshold([tuple(r) for r in seen.count().collect()], settings.most_good_lost)
    kept = ~F.col("base_failed") & (F.floor(F.col("score") * STEPS) < limit * STEPS)
    return scored.select("doc_id", *BASE, "base_failed", kept.alias("kept"), "score")


def _scored(counted: DataFrame, forest: Forest) -> DataFrame:
    names = ["doc_id", *BASE, "base_failed"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in COUNTS], axis=1)
            score = forest.score(features(counts))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(score)], [*names, "score"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, score double"
    return counted.mapInArrow(run, schema)
