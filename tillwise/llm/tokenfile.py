"""Token ids of whole documents in files of grammar-compressed shards."""

from __future__ import annotations

import json
import os
import string
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.texts import shuffle_partitions

#: Nonterminals of a shard's grammar are numbered from here; token ids lie below.
NONTERMINAL = 1 << 24
#: Pairs are two symbols in 64 bits; the frequent ones are looked up by hash, of at most so many bits, for so many pairs at once.
HASH, HASH_BITS, BLOCK, WIDTH, LOW = np.uint64(0x9E3779B97F4A7C15), 20, 1 << 16, np.uint64(32), np.uint64(0xFFFFFFFF)
MARKS = string.punctuation.encode()
#: One row per shard. Documents lie one after the other: ``symbols`` counts the symbols of each in
#: ``sequence``, ``tokens`` its ids. Rule i, for nonterminal NONTERMINAL + i, is ``left[i] right[i]`` and expands
#: to ``expands[i]`` ids. All binary columns hold little-endian unsigned 32-bit integers.
FORMAT = (
    "part int, number int, shard_tokens long, doc_ids array<long>, symbols binary, tokens binary, "
    "left binary, right binary, expands binary, sequence binary"
)


def _words(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _ByteLetters(dict):
    """For ``str.translate``: what the tokenizer's byte alphabet makes of a character."""

    def __missing__(self, code: int) -> str:
        from tokenizers.pre_tokenizers import ByteLevel

        self[code] = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(code))[0][0]
        return self[code]


def cuts_words(tokenizer) -> bool:
    """Whether a tokenizer lower-cases, cuts at white space, drops it and takes marks apart from letters."""
    settings = json.loads(tokenizer.to_str())
    normal, cut, model = settings["normalizer"] or {}, settings["pre_tokenizer"] or {}, settings["model"]
    steps = [step["type"] for step in normal.get("normalizers", [])]
    parts = [(part["type"], part.get("behavior"), part.get("invert"), part.get("add_prefix_space"), part.get("use_regex")) for part in cut.get("pretokenizers", [])]
    pattern = (cut.get("pretokenizers") or [{}])[0].get("pattern", {}).get("Regex", "")
    return (
        steps == ["NFC", "Replace", "Lowercase"]
        and parts == [("Split", "Removed", True, None, None), ("ByteLevel", None, None, False, False)]
        and pattern.endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        and model["type"] == "BPE" and not model["continuing_subword_prefix"] and not model["dropout"]
    )


class WordEncoder(dict):
    """Words between ASCII white space to their packed ids, by the tokenizer for words not seen yet.

    A tokenizer that ``cuts_words`` gives a text its words' ids joined, and a
    word the ids of its letters and of the marks after them. Words of Latin
    letters, whose lower case and normal form depend on nothing around them,
    need only its merges; all others go through the whole tokenizer. The memory
    is emptied when it is full. Any other tokenizer gets whole texts.
    """

    #: Code points below this are Latin, without combining marks.
    LATIN_END = "\u0250"

    def __init__(self, path: str, full: int = 600_000, longest: int = 64):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.full, self.longest = Tokenizer.from_file(path), full, longest
        self.letters, self.by_words = _ByteLetters(), cuts_words(self.tokenizer)

    def __missing__(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters, which the byte alphabet leaves as they are
            lower = word.lower()
            packed = self.get(lower) or _words([t.id for t in self.tokenizer.model.tokenize(lower.decode())])
        elif (stem := word.rstrip(MARKS)) != word and stem.decode().isalpha():
            packed = self[stem] + self[word[len(stem) :]]
        else:
            text = word.decode()
            if text.isalpha() and max(text) < self.LATIN_END and "\u0130" not in text:
                ids = [t.id for t in self.tokenizer.model.tokenize(text.lower().translate(self.letters))]
            else:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            packed = _words(ids)
        if len(word) <= self.longest:
            if len(self) >= self.full:
                self.clear()
            self[word] = packed
        return packed

    def text(self, text: bytes | None) -> bytes:
        if not text:
            return b""
        if not self.by_words:
            return _words(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids)
        return b"".join(map(self.__getitem__, text.split()))


@lru_cache(maxsize=1)
def _encoder(path: str, remembered: int) -> WordEncoder:
    """One encoder for all tasks of a worker."""
    return WordEncoder(path, remembered)


def _frequent(pair: np.ndarray, least: int):
    """(group of each pair or -1, pairs, times) of the pairs that occur ``least`` times.

    Sorted, equal pairs are neighbours. Every pair then looks up its group by
    hash; those that share a slot with another frequent pair go on to the next turn.
    """
    group = np.full(len(pair), -1, np.int32)
    ordered = np.sort(pair)
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(pair) else np.empty(0, np.int64)
    times = np.diff(first, append=len(pair))
    often = np.flatnonzero(times >= least)
    pairs, times = ordered[first[often]], times[often]
    if not len(pairs):
        return group, pairs, times
    bits = min(len(pairs).bit_length() + 3, HASH_BITS)
    shift, left, tables = np.uint64(64 - bits), np.arange(len(pairs), dtype=np.int32), []
    slot = (pairs * HASH >> shift).astype(np.int64)
    while len(left):
        tables.append(np.full(1 << bits, -1, np.int32))
        tables[-1][slot[left]] = left
        left = left[tables[-1][slot[left]] != left]
    for start in range(0, len(pair), BLOCK):
        there, out = pair[start : start + BLOCK], group[start : start + BLOCK]
        slot = (there * HASH >> shift).astype(np.int64)
        at = np.arange(len(there))
        for table in tables:
            found = table[slot]
            some = np.flatnonzero(found >= 0)
            found, there, slot, at = found[some], there[some], slot[some], at[some]
            same = pairs[found] == there
            out[at[same]] = found[same]
            rest = np.flatnonzero(~same)
            there, slot, at = there[rest], slot[rest], at[rest]
    return group, pairs, times


def compress(ids: np.ndarray, last: np.ndarray, least: int = 8):
    """Re-Pair: (sequence, last, left, right) with frequent neighbours replaced by nonterminals.

    Each round counts neighbouring symbols and replaces every pair that occurs
    ``least`` times, the most frequent first, but for those that could overlap one
    chosen before; rounds go on until no pair occurs so often. A pair of older
    symbols only gets rarer, so a round counts new symbols' pairs and those that
    were frequent in the round before. ``last`` marks the last symbol of each
    document; no pair reaches over it.
    """
    sequence, last, rules = ids.astype(np.uint32), last.copy(), []
    at = np.flatnonzero(~last[:-1])
    while True:
        pair = sequence[at].astype(np.uint64) << WIDTH | sequence[at + 1]
        group, pairs, times = _frequent(pair, least)
        if not len(pairs):
            break
        firsts, seconds, twins, new = set(), set(), False, np.zeros(len(pairs), np.uint32)
        often = np.lexsort((pairs, -times))
        for k, a, b in zip(often.tolist(), (pairs[often] >> WIDTH).tolist(), (pairs[often] & LOW).tolist()):
            if a in seconds or b in firsts:
                continue
            firsts.add(a)
            seconds.add(b)
            twins |= a == b
            new[k] = NONTERMINAL + len(rules)
            rules.append((a, b))
        some = np.flatnonzero(group >= 0)
        at, symbol = at[some], new[group[some]]
        counted = np.zeros(len(sequence), bool)
        counted[at] = True
        some = np.flatnonzero(symbol)
        at, symbol = at[some], symbol[some]
        if twins:  # only pairs of a symbol with itself can overlap
            run = np.arange(len(at)) - np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, np.arange(len(at)), 0))
            some = np.flatnonzero(run % 2 == 0)
            at, symbol = at[some], symbol[some]
        sequence[at] = symbol
        last[at] = last[at + 1]
        kept = np.ones(len(sequence), bool)
        kept[at + 1] = False
        kept = np.flatnonzero(kept)
        sequence, last, counted = sequence[kept], last[kept], counted[kept]
        replaced = at - np.arange(len(at))
        counted[replaced] = True
        counted[np.maximum(replaced - 1, 0)] = True
        at = np.flatnonzero(counted[:-1] & ~last[:-1])
    grammar = np.array(rules, np.int64).reshape(-1, 2)
    return sequence, last, grammar[:, 0], grammar[:, 1]


def expand(sequence: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The ids that a run of symbols stands for."""
    sequence = sequence.astype(np.int64)
    while (rule := sequence >= NONTERMINAL).any():
        size = 1 + rule
        out, at = np.repeat(sequence, size), (np.cumsum(size) - size)[rule]
        out[at], out[at + 1] = left[sequence[rule] - NONTERMINAL], right[sequence[rule] - NONTERMINAL]
        sequence = out
    return sequence


def decode(sequence: np.ndarray, left: np.ndarray, right: np.ndarray, expands: np.ndarray) -> np.ndarray:
    """``expand`` of a whole shard: the ids of every nonterminal are worked out once and copied."""
    ids = expand(NONTERMINAL + np.arange(len(left)), left, right)
    ends, rule = np.cumsum(expands), sequence >= NONTERMINAL
    which = sequence[rule] - NONTERMINAL
    size = np.ones(len(sequence), np.int64)
    size[rule] = expands[which]
    start = np.cumsum(size) - size
    out = np.repeat(sequence, size)
    inside = np.repeat(rule, size)
    out[inside] = ids[np.repeat((ends - expands)[which] - start[rule], size[rule]) + np.flatnonzero(inside)]
    return out


def expansions(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ids under each nonterminal; a rule only uses rules before it."""
    sizes = np.ones(len(left), np.int64)
    inner = [(side >= NONTERMINAL, side[side >= NONTERMINAL] - NONTERMINAL) for side in (left, right)]
    while True:
        new = np.zeros(len(left), np.int64)
        for rule, of in inner:
            size = np.ones(len(left), np.int64)
            size[rule] = sizes[of]
            new += size
        if np.array_equal(new, sizes):
            return sizes
        sizes = new


def _packed(values: np.ndarray) -> bytes:
    return values.astype("<u4").tobytes()


def _numbers(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u4").astype(np.int64)


def _shard(part: int, number: int, doc_ids: list, packed: list[bytes]) -> tuple:
    tokens = np.array([len(p) // 4 for p in packed], np.int64)
    ids = np.frombuffer(b"".join(packed), "<u4")
    last = np.zeros(len(ids), bool)
    last[np.cumsum(tokens) - 1] = True
    sequence, last, left, right = compress(ids, last)
    symbols = np.diff(np.flatnonzero(last), prepend=-1)
    binary = [symbols, tokens, left, right, expansions(left, right), sequence]
    return part, number, len(ids), doc_ids, *map(_packed, binary)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, shard_tokens: int = 1 << 21, remembered: int = 600_000) -> None:
    """Encode whole texts, end each with ``end_id`` and write the ids in ascending doc_id order.

    The file is a Parquet table with a row per shard (see ``FORMAT``); parts and
    numbers in them give the order. A shard has up to ``shard_tokens`` ids and
    whole documents only; a longer document has a shard of its own. A null or
    empty text is its end id alone; a null doc_id comes first; rows with the same
    doc_id follow each other in the order of their texts. Other columns are left out.
    A worker keeps up to ``remembered`` words and their ids from task to task.
    """
    spark = docs.sparkSession
    schema = spark.createDataFrame([], FORMAT).schema
    end = _words([end_id])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, encoder, part = to_arrow_schema(schema), _encoder(tokenizer, remembered), TaskContext.get().partitionId()
        doc_ids, packed, held, number, batch = [], [], 0, 0, None

        def shard() -> pa.RecordBatch:
            row = _shard(part, number, doc_ids, packed)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow)], schema=arrow)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):  # one text at a time out of the batch
                ids = encoder.text(text.as_py()) + end
                if packed and held + len(ids) > shard_tokens:
                    yield shard()
                    doc_ids, packed, held, number = [], [], 0, number + 1
                doc_ids.append(doc_id)
                packed.append(ids)
                held += len(ids)
        if packed:
            yield shard()
        del batch, packed
        pa.default_memory_pool().release_unused()  # the worker goes on to other tasks

    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("binary").alias("text"))
    ordered = texts.repartitionByRange(shuffle_partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, schema).write.parquet(path)


def read_document(shard, place: int) -> np.ndarray:
    """The ids of one document of a shard's row, decoding nothing else."""
    symbols = _numbers(shard["symbols"])
    start = int(symbols[:place].sum())
    sequence = np.frombuffer(shard["sequence"], "<u4", int(symbols[place]), 4 * start)
    return expand(sequence, _numbers(shard["left"]), _numbers(shard["right"]))


def read_tokens(shard, place: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of one document of a shard's row.

    The lengths that nonterminals expand to say which symbols of the document
    hold them; only these are decoded.
    """
    symbols, expands = _numbers(shard["symbols"]), _numbers(shard["expands"])
    before = int(symbols[:place].sum())
    sequence = np.frombuffer(shard["sequence"], "<u4", int(symbols[place]), 4 * before).astype(np.int64)
    size = np.ones(len(sequence), np.int64)
    rule = sequence >= NONTERMINAL
    size[rule] = expands[sequence[rule] - NONTERMINAL]
    ends = np.cumsum(size)
    start, stop = max(start, 0), min(stop, int(ends[-1]))
    if start >= stop:
        return np.empty(0, np.int64)
    first, after = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
    ids = expand(sequence[first:after], _numbers(shard["left"]), _numbers(shard["right"]))
    skipped = start - int(ends[first] - size[first])
    return ids[skipped : skipped + stop - start]


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                ids = decode(*(_numbers(shard[c]) for c in ("sequence", "left", "right", "expands")))
                plain, ends = _packed(ids), np.cumsum(_numbers(shard["tokens"])).tolist()
                starts = [0, *ends[:-1]]
                sums = [zlib.crc32(plain[4 * a : 4 * b]) for a, b in zip(starts, ends)]
                n = len(ends)
                columns = [[shard["part"]] * n, [shard["number"]] * n, shard["doc_ids"], starts]
                columns += [[b - a for a, b in zip(starts, ends)], sums]
                kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "number", "doc_id", "inner", "n_tokens", "ids_crc32"]
                )

    shards = spark.read.schema(FORMAT).parquet(path)
    coded = shards.select("part", "number", "doc_ids", "tokens", "left", "right", "expands", "sequence")
    documents = coded.mapInArrow(run, "part int, number int, doc_id long, inner long, n_tokens long, ids_crc32 long")
    sizes = shards.select("part", "number", "shard_tokens")
    parts = sizes.groupBy("part").agg(F.sum("shard_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.coalesce(F.sum("shard_tokens").over(Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.withColumn("inside", inside).join(parts, "part").select("part", "number", (F.col("before") + F.col("inside")).alias("shard_start"))
    placed = documents.join(starts, ["part", "number"])
    return placed.select("doc_id", (F.col("shard_start") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
