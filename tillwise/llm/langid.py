"""Language identification by hyperdimensional profiles of letter trigrams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for everything between two runs of letters.
GAP = 0
UNICODE = 0x110000
#: Characters, texts, table cells and n-grams handled together; they bound a task's memory, not its results.
CHARS, ROWS, CELLS, GRAMS = 1 << 20, 1024, 1 << 22, 4096
_SPACE, _NO_LETTER = re.compile(r"\s"), re.compile(r"[\W\d_]")


@cache
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(UNICODE)), bool, UNICODE)


@cache
def _letter(symbol: int, seed: int, dimensions: int) -> np.ndarray:
    """The random vector of +1 and -1 that stands for a letter, the same on every machine."""
    bits = np.random.Generator(np.random.Philox(key=[seed, symbol])).integers(0, 2, dimensions, np.int8)
    return bits * np.int8(2) - np.int8(1)


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of the texts with one gap around each run, and each symbol's text."""
    lowered = [f" {t.lower()} " if t else " " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(lowered)), [len(t) for t in lowered])
    letter = _is_letter()[codes]
    opens = np.append(True, owner[1:] != owner[:-1])
    kept = letter | opens | np.append(False, letter[:-1])
    return np.where(letter, codes, GAP)[kept].astype(np.int64), owner[kept]


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, n-gram) of every position, and the symbols of each distinct n-gram."""
    code, owner = symbols(texts)
    present = np.zeros(UNICODE, bool)
    present[code] = True
    alphabet = np.flatnonzero(present)
    rank = (np.cumsum(present) - 1)[code]
    whole = owner[2:] == owner[:-2]
    size = len(alphabet)
    gram = ((rank[:-2] * size + rank[1:-1]) * size + rank[2:])[whole]
    if size**3 <= CELLS:
        seen = np.bincount(gram, minlength=size**3) > 0
        distinct, place = np.flatnonzero(seen), (np.cumsum(seen) - 1)[gram]
    else:
        distinct, place = np.unique(gram, return_inverse=True)
    letters = np.stack([alphabet[distinct // size**2], alphabet[distinct // size % size], alphabet[distinct % size]])
    return owner[2:][whole], place, letters


def bind(letters: np.ndarray, seed: int, dimensions: int) -> np.ndarray:
    """N-gram vectors: the first letter rotated by two, the second by one, all three multiplied."""
    alphabet, where = np.unique(letters, return_inverse=True)
    table = np.stack([_letter(int(a), seed, dimensions) for a in alphabet])
    first, second, third = where.reshape(letters.shape)
    return np.roll(table, 2, 1)[first] * np.roll(table, 1, 1)[second] * table[third]


def bundle(texts: list[str | None], seed: int, dimensions: int) -> np.ndarray:
    """One row per text: the sum of the vectors of all its n-grams."""
    owner, place, letters = trigrams(texts)
    out = np.zeros((len(texts), dimensions), np.float32)
    grams = letters.shape[1]
    if not grams:
        return out
    step = max(1, CELLS // grams)
    starts = np.searchsorted(owner, np.arange(0, len(texts) + step, step))
    for i, (a, b) in enumerate(zip(starts, starts[1:])):
        rows = min(step, len(texts) - i * step)
        if rows <= 0 or a == b:
            continue
        counts = np.bincount((owner[a:b] - i * step) * grams + place[a:b], minlength=rows * grams)
        counts = counts.reshape(rows, grams).astype(np.float32)
        for g in range(0, grams, GRAMS):
            vectors = bind(letters[:, g : g + GRAMS], seed, dimensions).astype(np.float32)
            out[i * step : i * step + rows] += counts[:, g : g + GRAMS] @ vectors
    return out


def _pieces(texts: list[str | None]) -> Iterator[slice]:
    """Runs of up to ROWS texts of about CHARS characters; a longer text is a run of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if i > start and (held + size > CHARS or i - start == ROWS):
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(texts):
        yield slice(start, len(texts))


def _cuts(text: str) -> Iterator[str]:
    """A text in parts of about CHARS characters, cut at white space, else at what is no letter."""
    at = 0
    while at < len(text):
        end = at + CHARS
        found = _SPACE.search(text, end, end + CHARS) or _NO_LETTER.search(text, end)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def bundles(texts: list[str | None], seed: int, dimensions: int) -> Iterator[tuple[slice, np.ndarray]]:
    """The bundles of runs of texts, a row per text.

    Bundles add up, so a long text is bundled in parts. A part begins with the
    last letter before it and a gap, for the n-grams that reach over the cut,
    less the n-gram of that letter between gaps.
    """
    for piece in _pieces(texts):
        if piece.stop - piece.start > 1 or len(texts[piece.start] or "") <= CHARS:
            yield piece, bundle(texts[piece], seed, dimensions)
            continue
        total, before = np.zeros((1, dimensions)), ""
        for part in _cuts(texts[piece.start]):
            total += bundle([f"{before} {part}"], seed, dimensions)
            total -= bundle([before], seed, dimensions) if before else 0
            before = next((c for c in reversed(part) if c.isalpha()), before)
        yield piece, total


@dataclass
class LanguageProfiles:
    """Prototype vectors, one row per learned language; languages are in ascending order."""

    languages: list[str]
    prototypes: np.ndarray
    seed: int

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language of the nearest prototype and its cosine (0 where it is negative).

        Without a letter, or without any learned language, ``und`` and 0. Of
        equally near prototypes the first language counts.
        """
        out: list[tuple[str, float]] = []
        unit = self.prototypes / np.maximum(np.linalg.norm(self.prototypes, axis=1, keepdims=True), 1e-300)
        for piece, vectors in bundles(texts, self.seed, self.prototypes.shape[1]):
            vectors = vectors.astype(np.float64)
            norm = np.linalg.norm(vectors, axis=1)
            has_letter = [any(map(str.isalpha, t or "")) for t in texts[piece]]
            if not self.languages:
                out += [("und", 0.0)] * len(vectors)
                continue
            cosine = vectors @ unit.T / np.maximum(norm, 1e-300)[:, None]
            best = np.argmax(cosine, axis=1)
            score = np.clip(cosine[np.arange(len(best)), best], 0, 1)
            out += [
                (self.languages[k], float(s)) if known else ("und", 0.0)
                for k, s, known in zip(best, score, has_letter)
            ]
        return out


def learn(labelled: DataFrame, seed: int = 7, dimensions: int = 1024) -> LanguageProfiles:
    """Bundle the texts of each language into its prototype.

    Uses ``text`` and ``lang``; rows where either is null teach nothing. Tasks
    add up whole numbers per language, so the prototypes do not depend on how
    rows are dealt. The model that reaches the driver has one vector per language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), object)
            for piece, vectors in bundles(texts, seed, dimensions):
                of = langs[piece]
                for lang in dict.fromkeys(of):
                    sums[lang] = sums.get(lang, 0) + vectors[of == lang].astype(np.int64).sum(0)
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dimensions), pa.array(range(dimensions), pa.int32()), pa.array(total, pa.int64())],
                ["lang", "at", "total"],
            )

    taught = labelled.filter("text is not null and lang is not null").select("text", "lang")
    sums = taught.mapInArrow(run, "lang string, at int, total long").groupBy("lang", "at").agg(F.sum("total").alias("total"))
    found = sums.toPandas()
    languages = sorted(found["lang"].unique())
    prototypes = np.zeros((len(languages), dimensions))
    prototypes[np.searchsorted(languages, found["lang"].to_numpy(str)) if languages else [], found["at"]] = found["total"]
    return LanguageProfiles(languages, prototypes, seed)


def identify(docs: DataFrame, profiles: LanguageProfiles, keep: list[str | Column]) -> DataFrame:
    """``keep`` columns of every document with lang_pred and score; only the text decides."""
    spark = docs.sparkSession
    kept = docs.select(*keep)
    names = [f"kept_{i}" for i in range(len(kept.columns))]
    source = docs.select(*keep, F.col("text").alias("the_text")).toDF(*names, "the_text")
    schema = "struct<" + ",".join(f"{n}:{f.dataType.simpleString()}" for n, f in zip(names, kept.schema)) + ",lang_pred:string,score:double>"
    target = spark.createDataFrame([], schema[7:-1]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = profiles.predict(batch.column(len(names)).to_pylist())
            columns = [batch.column(i) for i in range(len(names))]
            columns += [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "score"])

    return source.mapInArrow(run, target).toDF(*kept.columns, "lang_pred", "score")


#: Length bins double from the first length that is judged; cosines are counted in steps.
BINS, STEPS = 10, 1000


def least_cosines(
    labelled: DataFrame, profiles: LanguageProfiles, share: float = 0.005, least: float = 0.15, letters: int = 30
) -> np.ndarray:
    """The least cosine of each learned language and length bin, from labelled rows.

    Below it lie at most ``share`` of the language's own texts of that length,
    each measured against its language without itself. With fewer than 1 /
    ``share`` such texts those of all languages count, then those of all shorter
    bins too, which are less like their language; with too few of these as well
    it is ``least``, which is also the lower limit. Only counts reach the driver.
    """
    languages = profiles.languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(languages) * BINS * STEPS, np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            of = np.searchsorted(languages, batch.column(1).to_pylist())
            for piece, vectors in bundles(texts, profiles.seed, profiles.prototypes.shape[1]):
                vectors = vectors.astype(np.float64)
                others = profiles.prototypes[of[piece]] - vectors
                norm = np.linalg.norm(vectors, axis=1) * np.linalg.norm(others, axis=1)
                cosine = (vectors * others).sum(1) / np.maximum(norm, 1e-300)
                size = np.array([len(t) for t in texts[piece]])
                at = np.minimum(np.log2(size / letters).astype(int), BINS - 1)
                step = np.clip((cosine * STEPS).astype(int), 0, STEPS - 1)
                has_letter = np.array([any(map(str.isalpha, t)) for t in texts[piece]])
                cell = (of[piece] * BINS + at) * STEPS + step
                counts += np.bincount(cell[has_letter], minlength=len(counts))
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(counts[cells], pa.int64())], ["cell", "n"])

    if not languages:
        return np.zeros((0, BINS))
    taught = labelled.filter(F.col("lang").isin(languages) & (F.length("text") >= letters)).select("text", "lang")
    sums = taught.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(languages) * BINS * STEPS, np.int64)
    counts[sums["cell"]] = sums["n"]
    own = counts.reshape(-1, BINS, STEPS)
    every = own.sum(0, keepdims=True)
    out = np.full(own.shape[:2], np.nan)
    for some in (own, every, every.cumsum(1)):
        total = some.sum(2)
        found = np.argmax(some.cumsum(2) > share * total[:, :, None], axis=2) / STEPS
        out = np.where(np.isnan(out) & (total * share >= 1), found, out)
    return np.maximum(np.nan_to_num(out, nan=least), least)


def keep_identified(
    docs: DataFrame, profiles: LanguageProfiles, least: float = 0.15, letters: int = 30, bounds: np.ndarray | None = None
) -> DataFrame:
    """The documents that look like one of the learned languages, all columns kept.

    Rejected are texts without a letter (null and empty ones too) and texts of
    at least ``letters`` characters whose cosine with the nearest prototype is
    below its bound: that of ``bounds`` (see least_cosines) for the language and
    length, or ``least``. A few words alone say too little to reject them.
    """
    columns = docs.columns
    marked = identify(docs, profiles, [docs[c] for c in columns])
    judged = marked.toDF(*[f"kept_{i}" for i in range(len(columns))], "judged_lang", "judged_score")
    size = F.length(f"kept_{columns.index('text')}")
    bound = F.lit(least)
    if bounds is not None and len(bounds):
        at = F.least(F.floor(F.log2(size / letters)), F.lit(BINS - 1)).cast("int")
        for language, row in zip(profiles.languages, bounds.tolist()):
            bound = F.when(F.col("judged_lang") == language, F.get(F.array(*map(F.lit, row)), at)).otherwise(bound)
    stays = (F.col("judged_lang") != "und") & ((size < letters) | (F.col("judged_score") >= bound))
    return judged.filter(stays).drop("judged_lang", "judged_score").toDF(*columns)
