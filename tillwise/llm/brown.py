"""Scores of texts under a Brown class-based bigram model."""

from __future__ import annotations

import hashlib
import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.sources import scratch

#: Stands for the end of a text; no word is empty.
END = b""
MARKS = string.punctuation.encode()
ADD = 0.1
#: Words held in a task before their counts leave it, and bytes of text cut into words together.
FLUSH, CHUNK = 200_000, 1 << 22
#: Pairs counted together in a task, words of a bucket of pairs, and words whose moves are weighed together.
PAIRS, BUCKET, WEIGHED = 1 << 20, 4096, 512


@dataclass(frozen=True)
class Settings:
    """Bounds of the model.

    Every word seen twice or more is clustered by itself, words seen once or
    never with those that share their ending, in ``endings`` groups. The classes
    to start from are found on the driver in up to ``sweeps`` sweeps, with the
    ``clustered`` most frequent words by themselves and all others by endings.
    Tasks hold the counts of ``held`` frequent words of up to ``longest`` bytes;
    the counts of all other words are joined. The exchange ends when all words
    have been weighed and their moves made the training text more likely by less
    than ``least_gain`` (natural logarithm) a token; with 0, when no word does
    better in another class.
    """

    classes: int = 48
    clustered: int = 1000
    endings: int = 256
    held: int = 200_000
    longest: int = 64
    sweeps: int = 6
    backoff: float = 1.0
    least_gain: float = 0.0

    @property
    def symbols(self) -> int:
        return self.clustered + self.endings + 1

    def ending(self, word: bytes) -> int:
        """The symbol of a word that does not start by itself."""
        return self.clustered + zlib.crc32(word.rstrip(MARKS)[-3:]) % self.endings

    def key(self, word: bytes) -> int:
        """63 bits that stand for a word outside the held ones; modulo ``endings`` they give its ending."""
        hashed = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little") >> 2
        return hashed // self.endings * self.endings + self.ending(word) - self.clustered

    def keys(self, words: list[bytes]) -> np.ndarray:
        """The ``key`` of each word."""
        blake2b, crc32 = hashlib.blake2b, zlib.crc32
        digests = b"".join([blake2b(word, digest_size=8).digest() for word in words])
        tails = np.fromiter([crc32(word.rstrip(MARKS)[-3:]) for word in words], np.int64, len(words))
        hashed = (np.frombuffer(digests, "<u8") >> np.uint64(2)).astype(np.int64)
        return hashed // self.endings * self.endings + tails % self.endings


def _words(texts: list[bytes | None]) -> Iterator[list[bytes]]:
    for text in texts:
        yield text.lower().split() if text else []


def _chunks(texts: list[bytes | None]) -> Iterator[list[bytes | None]]:
    start, size = 0, 0
    for i, text in enumerate(texts, 1):
        size += len(text or b"")
        if size >= CHUNK or i == len(texts):
            yield texts[start:i]
            start, size = i, 0


def _columns(rows: DataFrame) -> list[np.ndarray]:
    """The columns of a few rows, without the copies that a pandas table would take."""
    return [column.to_numpy() for column in rows.toArrow().columns]


def count_words(taught: DataFrame) -> DataFrame:
    """(word, c) over all texts of a table with the binary column text; each text adds one END."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            columns = [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "c"])

        for batch in batches:
            for words in _words(batch.column(0).to_pylist()):
                counts.update(words)
                counts[END] += 1
                if len(counts) >= FLUSH:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return taught.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def frequent_words(vocabulary: DataFrame, settings: Settings) -> tuple[list[bytes], np.ndarray]:
    """(words, counts) of words seen twice or more, most frequent first, at most ``held`` of them.

    All words whose count reaches a limit, the lowest on a logarithmic scale
    that no more words reach: found by counting, without sorting the vocabulary.
    """
    step = F.floor(F.log2("c") * 16).cast("int")
    named = vocabulary.filter((F.length("word") > 0) & (F.length("word") <= settings.longest) & (F.col("c") > 1))
    sizes = sorted(((r["step"], r["count"]) for r in named.groupBy(step.alias("step")).count().collect()), reverse=True)
    reached, lowest = 0, None
    for at, n in sizes:
        reached += n
        if reached > settings.held:
            break
        lowest = at
    if lowest is None:
        return [], np.empty(0, np.int64)
    rows = named.filter(step >= lowest).select("word", "c").toArrow()
    order = sorted(zip((-rows["c"].to_numpy()).tolist(), rows["word"].to_pylist()))
    return [w for _, w in order], np.array([-c for c, _ in order], np.int64)


def repeated_keys(vocabulary: DataFrame, frequent: list[bytes], settings: Settings) -> np.ndarray:
    """Ascending keys of the words seen twice or more that are not held: eight bytes a word."""
    places = vocabulary.sparkSession.sparkContext.broadcast(frozenset(frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = places.value
        for batch in batches:
            keys = settings.keys([w for w in batch.column(0).to_pylist() if w not in held])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64())], ["key"])

    named = vocabulary.filter((F.length("word") > 0) & (F.col("c") > 1)).select("word")
    return np.unique(_columns(named.mapInArrow(run, "key long"))[0])


class Coder:
    """Turns words into symbols: held words, endings, the end, all other repeated words; made once in a worker."""

    def __init__(self, words: list[bytes], settings: Settings, rare: np.ndarray):
        self.settings, self.rare, self.place = settings, rare, {w: i for i, w in enumerate(words)}
        self.end = len(words) + settings.endings

    def places(self, words: list[bytes]) -> np.ndarray:
        """Place of each word among the held ones, -1 for others."""
        return np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))

    def symbols(self, words: list[bytes], places: np.ndarray) -> np.ndarray:
        out, at = places.copy(), np.flatnonzero(places < 0)
        if len(at):
            keys = self.settings.keys([words[i] for i in at.tolist()])
            out[at] = len(self.place) + keys % self.settings.endings
            if len(self.rare):
                near = np.minimum(np.searchsorted(self.rare, keys), len(self.rare) - 1)
                found = self.rare[near] == keys
                out[at[found]] = self.end + 1 + near[found]
        return out


def starting_symbols(words: list[bytes], rare: np.ndarray, settings: Settings) -> np.ndarray:
    """The symbol that each symbol of a Coder has in the table the classes start from."""
    top, endings = min(settings.clustered, len(words)), settings.clustered + np.arange(settings.endings)
    held = [*range(top), *map(settings.ending, words[top:])]
    return np.concatenate([held, endings, [settings.symbols - 1], settings.clustered + rare % settings.endings]).astype(np.int32)


_coders: dict = {}


def _coder(words) -> Coder:
    """The coder of a broadcast (words, settings, rare, name); a worker keeps the last one."""
    if words.value[3] not in _coders:
        _coders.clear()
        _coders[words.value[3]] = Coder(*words.value[:3])
    return _coders[words.value[3]]


def _pack(keys: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending keys and their counts, compressed."""
    raw = np.diff(keys, prepend=0).astype("<i8").tobytes() + n.astype("<i8").tobytes()
    return len(keys).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpack(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = int.from_bytes(body[:8], "little")
    both = np.frombuffer(pa.decompress(body[8:], size * 16, "zstd", asbytes=True), "<i8")
    return np.cumsum(both[:size]), both[size:]


def _add_up(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(n)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[first], np.add.reduceat(count[order], first)


def code_texts(texts: DataFrame, words, counts: np.ndarray) -> DataFrame:
    """Every text once in symbols, which pairs are counted on and scores are worked out from.

    (row, doc_id, held_out, taught, n_tokens, held, seen, rest, symbols): a number for the row, tokens with the end,
    held words and the sum of their log10 counts, all other words, and all words' symbols in 32 bits each.
    """
    dealt = texts.sparkSession.sparkContext.broadcast(np.log10(counts + ADD))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, log_count = _coder(words), dealt.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            done = 0
            for chunk in _chunks(batch.column(1).to_pylist()):
                cuts = list(_words(chunk))
                ends = np.append(0, np.cumsum([len(cut) for cut in cuts]))
                every = list(chain.from_iterable(cuts))
                places = coder.places(every)
                known = places >= 0
                held, logs = np.append(0, np.cumsum(known))[ends], log_count[places[known]]
                seen = [float(logs[i:j].sum()) for i, j in zip(held[:-1].tolist(), held[1:].tolist())]
                rest = pa.array([every[i] for i in np.flatnonzero(~known).tolist()], pa.binary())
                symbols = coder.symbols(every, places).astype("<i4")
                columns = [
                    pa.array(np.arange(row, row + len(cuts))), *(batch.column(c).slice(done, len(cuts)) for c in (0, 3, 2)),
                    pa.array(np.diff(ends) + 1), pa.array(np.diff(held)), pa.array(seen, pa.float64()),
                    pa.ListArray.from_arrays(pa.array(ends - held, pa.int32()), rest),
                    pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer((4 * ends).astype("<i4")), pa.py_buffer(symbols)]),
                ]
                row, done = row + len(cuts), done + len(cuts)
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["row", "doc_id", "held_out", "taught", "n_tokens", "held", "seen", "rest", "symbols"]
    schema = "row long, doc_id long, held_out boolean, taught boolean, n_tokens long, held long, seen double, rest array<binary>, symbols binary"
    return texts.select("doc_id", "text", "taught", "held_out").mapInArrow(run, schema)


def count_pairs(coded: DataFrame, end: int, size: int) -> DataFrame:
    """(bucket, body): how often each symbol follows each; texts start after an END.

    ``coded`` has the texts' symbols. A body holds the pairs of the symbols of a
    bucket, twice: keys (symbol * 2 + side) * size + neighbour, where side 0 is
    the neighbour after, 1 before.
    """
    buckets = size // BUCKET + 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, held = [np.array([end])], 0

        def out() -> pa.RecordBatch:
            row = np.concatenate(stream)
            key, n = np.unique(row[:-1] * size + row[1:], return_counts=True)
            a, b = np.divmod(key, size)
            symbol, both = np.concatenate([a, b]), np.concatenate([a * 2 * size + b, (b * 2 + 1) * size + a])
            order = np.lexsort((both, symbol % buckets))
            of, both, n = (symbol % buckets)[order], both[order], np.concatenate([n, n])[order]
            cuts = np.flatnonzero(np.append(True, of[1:] != of[:-1])).tolist()
            bodies = [_pack(both[i:j], n[i:j]) for i, j in zip(cuts, [*cuts[1:], len(of)])]
            return pa.RecordBatch.from_arrays([pa.array(of[cuts], pa.int64()), pa.array(bodies, pa.binary())], ["bucket", "body"])

        for batch in batches:
            for body in batch.column(0).to_pylist():
                symbols = np.frombuffer(body, "<i4")
                stream += [symbols, np.array([end])]
                held += len(symbols) + 1
                if held >= PAIRS:
                    yield out()
                    stream, held = [np.array([end])], 0
        if held:
            yield out()

    def merge(group: pa.Table) -> pa.Table:
        keys, n, held = [], [], 0
        for body in group.column("body"):
            some = _unpack(body.as_py())
            keys.append(some[0])
            n.append(some[1])
            held += len(some[0])
            if held >= 2 * PAIRS:
                keys, n = ([x] for x in _add_up(keys, n))
                held = len(keys[0])
        return pa.table({"bucket": group.column("bucket").slice(0, 1), "body": pa.array([_pack(*_add_up(keys, n))], pa.binary())})

    parts = coded.select("symbols").mapInArrow(run, "bucket long, body binary")
    return parts.groupBy("bucket").applyInArrow(merge, "bucket long, body binary")


def group_table(pairs: DataFrame, of: np.ndarray, groups: int, size: int) -> np.ndarray:
    """How often each group of symbols follows each, ``of`` being the group of each symbol."""
    dealt = pairs.sparkSession.sparkContext.broadcast(of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, of = np.zeros(groups * groups), dealt.value
        for batch in batches:
            for body in batch.column(0).to_pylist():
                keys, n = _unpack(body)
                place, other = np.divmod(keys, size)
                after = place % 2 == 0
                pair = of[place[after] // 2].astype(np.int64) * groups + of[other[after]]
                total += np.bincount(pair, n[after], groups * groups)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at].astype(np.int64))], ["pair", "n"])

    sums = pairs.select("body").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pair, n = _columns(sums)
    dealt.destroy()
    table = np.zeros(groups * groups)
    table[pair] = n
    return table.reshape(groups, groups)


def gain(n: np.ndarray) -> np.ndarray:
    return n * np.log(np.maximum(n, 1))


def likelihood_change(old: np.ndarray, new: np.ndarray) -> float:
    """How much more likely the training text is under other class bigrams."""
    return float((gain(new) - gain(old)).sum() - sum((gain(new.sum(i)) - gain(old.sum(i))).sum() for i in (0, 1)))


def exchange(pairs: np.ndarray, settings: Settings) -> np.ndarray:
    """The class of each symbol, by the exchange algorithm.

    Starting from classes dealt in turn by frequency, every symbol moves to the
    class that makes the class bigrams of the training text most likely, until
    a sweep moves nothing or ``sweeps`` are done. The end of a text has class 0
    to itself.
    """
    size, classes = len(pairs), settings.classes
    weight = pairs.sum(0) + pairs.sum(1)
    order = [s for s in np.argsort(-weight, kind="stable").tolist() if s != size - 1]
    of = np.zeros(size, np.int64)
    of[order] = 1 + np.arange(size - 1) % (classes - 1)

    member = np.zeros((size, classes))
    member[np.arange(size), of] = 1
    after, before = pairs @ member, (member.T @ pairs).T
    table = member.T @ after
    for _ in range(settings.sweeps):
        moved = 0
        for s in order:
            if not weight[s]:
                break
            a, own = of[s], pairs[s, s]
            row, column = after[s].copy(), before[s].copy()
            row[a] -= own
            column[a] -= own
            rest = table.copy()
            rest[a] -= row
            rest[:, a] -= column
            rest[a, a] -= own
            base = gain(rest)
            left, right = gain(rest + row) - base, gain(rest + column[:, None]) - base
            both = gain(np.diag(rest) + row + column + own) - np.diag(base)
            value = left.sum(1) - np.diag(left) + right.sum(0) - np.diag(right) + both
            out, into = rest.sum(1), rest.sum(0)
            value -= gain(out + row.sum() + own) - gain(out) + gain(into + column.sum() + own) - gain(into)
            value[0] = -np.inf
            b = int(np.argmax(value))
            if value[b] <= value[a] + 1e-9:
                continue
            moved += 1
            of[s] = b
            table = rest
            table[b] += row
            table[:, b] += column
            table[b, b] += own
            after[:, a] -= pairs[:, s]
            after[:, b] += pairs[:, s]
            before[:, a] -= pairs[s]
            before[:, b] += pairs[s]
        if not moved:
            break
    return of


def weigh(table: np.ndarray, a: np.ndarray, row: np.ndarray, column: np.ndarray, own: np.ndarray) -> np.ndarray:
    """For each word the log likelihood of each class as its own, up to a constant a word.

    ``a`` are the words' classes, ``row`` and ``column`` how often classes follow
    and precede them without themselves, ``own`` how often they follow themselves;
    ``table`` has the class bigrams with the words in it. Only the neighbours'
    classes that occur are worked out.
    """
    size, classes = row.shape
    every, at = np.arange(classes), np.arange(size)
    value = np.zeros((size, classes))
    # table without the word: in line a its row is missing, in column a its column, in their crossing all three
    for side, mine, other in ((table, row, column), (table.T, column, row)):
        w, k = np.nonzero(mine)
        rest = side[:, k].T.copy()
        n, home = mine[w, k], k == a[w]
        rest[home] -= other[w[home]]
        rest[np.arange(len(w)), a[w]] -= n + np.where(home, own[w], 0)
        change = gain(rest + n[:, None]) - gain(rest)
        change[np.arange(len(w)), k] = 0
        if len(w):
            first = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            value[w[first]] += np.add.reduceat(change, first)
    corner = np.tile(np.diag(table), (size, 1))
    corner[at, a] -= row[at, a] + column[at, a] + own
    value += gain(corner + row + column + own[:, None]) - gain(corner)
    for total, n in ((table.sum(1), row.sum(1) + own), (table.sum(0), column.sum(1) + own)):
        rest = np.tile(total, (size, 1))
        rest[at, a] -= n
        value -= gain(rest + n[:, None]) - gain(rest)
    value[:, every == 0] = -np.inf
    return value


def propose(pairs: DataFrame, of: np.ndarray, table: np.ndarray, end: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, better classes, gains) of all symbols that alone would do better elsewhere."""
    dealt, classes = pairs.sparkSession.sparkContext.broadcast((of, table)), len(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, table = dealt.value
        noise = 1e-6 + 1e-12 * table.sum()
        for batch in batches:
            for body in batch.column(0).to_pylist():
                keys, n = _unpack(body)
                place, other = np.divmod(keys, size)
                symbol, side = place >> 1, place & 1
                distinct, index = np.unique(symbol, return_inverse=True)
                for i in range(0, len(distinct), WEIGHED):
                    x, y = np.searchsorted(index, [i, i + WEIGHED])
                    some = distinct[i : i + WEIGHED]
                    at, m, self = index[x:y] - i, n[x:y].astype(float), other[x:y] == symbol[x:y]
                    cell = (at * 2 + side[x:y]) * classes + of[other[x:y]]
                    counts = np.bincount(cell, np.where(self, 0, m), len(some) * 2 * classes).reshape(-1, 2, classes)
                    own = np.bincount(at, np.where(self & (side[x:y] == 0), m, 0), len(some))
                    a = of[some].astype(np.int64)
                    value = weigh(table, a, counts[:, 0], counts[:, 1], own)
                    best = np.argmax(value, 1)
                    better = value[np.arange(len(some)), best] - value[np.arange(len(some)), a]
                    moves = (better > noise) & (some != end)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some[moves]), pa.array(best[moves].astype(np.int16)), pa.array(better[moves])], ["symbol", "best", "better"]
                    )

    symbol, best, better = _columns(pairs.select("body").mapInArrow(run, "symbol long, best short, better double"))
    dealt.destroy()
    return symbol, best, better


def narrow(pairs: DataFrame, symbols: np.ndarray, size: int) -> DataFrame:
    """(body): the pairs of some symbols only."""
    wanted = np.zeros(size, bool)
    wanted[symbols] = True
    dealt = pairs.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(dealt.value, count=size).astype(bool)
        for batch in batches:
            for body in batch.column(0).to_pylist():
                keys, n = _unpack(body)
                kept = wanted[keys // size >> 1]
                if kept.any():
                    yield pa.RecordBatch.from_arrays([pa.array([_pack(keys[kept], n[kept])], pa.binary())], ["body"])

    narrowed = scratch.stage(pairs.select("body").mapInArrow(run, "body binary"), "moving")
    dealt.destroy()
    return narrowed


def table_change(pairs: DataFrame, of: np.ndarray, moved: np.ndarray, classes: int) -> np.ndarray:
    """What the class bigrams gain and lose when classes ``of`` become ``moved``; needs only the moved symbols' pairs."""
    size, dealt = len(of), pairs.sparkSession.sparkContext.broadcast((of, moved))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, moved = dealt.value
        total, differs = np.zeros(classes * classes), of != moved
        for batch in batches:
            for body in batch.column(0).to_pylist():
                keys, n = _unpack(body)
                symbol = keys // size
                some = np.flatnonzero(differs[symbol >> 1])
                symbol, side, other, m = symbol[some] >> 1, symbol[some] & 1, keys[some] % size, n[some]
                counts = (side == 0) | ~differs[other]  # two moved symbols are one pair: that after the first
                symbol, side, other, m = symbol[counts], side[counts], other[counts], m[counts]
                first, second = np.where(side == 0, symbol, other), np.where(side == 0, other, symbol)
                for dealing, sign in ((of, -1.0), (moved, 1.0)):
                    pair = dealing[first].astype(np.int64) * classes + dealing[second]
                    total += np.bincount(pair, m * sign, classes * classes)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at].astype(np.int64))], ["pair", "n"])

    sums = pairs.select("body").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pair, n = _columns(sums)
    dealt.destroy()
    change = np.zeros(classes * classes)
    change[pair] = n
    return change.reshape(classes, classes)


class Rounds:
    """Exchange of many symbols at once.

    In a round all symbols are weighed against the same classes. Symbols that
    move together can lose what each would gain alone; so a share of them moves,
    dealt anew by a hash in every round, which halves where they lose and
    doubles where they gain most of what was expected, down to the one that
    gains most alone. Every round ends more likely.
    """

    def __init__(self, of: np.ndarray, table: np.ndarray):
        self.of, self.table, self.turn, self.halved, self.risen = of, table, 0, 0, 0.0

    def go(self, pairs: DataFrame, symbol: np.ndarray, best: np.ndarray, better: np.ndarray) -> bool:
        """Move a share of the symbols; false if not even one of them makes the text more likely."""
        while True:
            self.turn += 1
            chosen = _mixed(symbol, self.turn) % np.uint64(1 << self.halved) == 0
            if self.halved and chosen.sum() <= 1:
                chosen = np.arange(len(symbol)) == np.lexsort((symbol, -better))[0]
            moved = self.of.copy()
            moved[symbol[chosen]] = best[chosen]
            changed = self.table + table_change(pairs, self.of, moved, len(self.table))
            rise, hoped = likelihood_change(self.table, changed), better[chosen].sum()
            if rise > 0:
                self.of, self.table, self.risen = moved, changed, self.risen + rise
                self.halved = max(0, self.halved - 1) if rise > 0.6 * hoped else self.halved + int(rise < 0.3 * hoped)
                return True
            if chosen.sum() == 1:
                return False
            self.halved += 1


def exchange_rounds(pairs: DataFrame, of: np.ndarray, end: int, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(class of each symbol, class bigrams): exchange of all symbols until it brings less than ``least_gain`` a token.

    When few symbols are left to move their pairs are taken out, and these
    symbols move until none of them does better; then all are weighed again.
    """
    size = len(of)
    rounds = Rounds(of, group_table(pairs, of, settings.classes, size))
    enough = settings.least_gain * float(rounds.table.sum())
    while True:
        found, before = propose(pairs, rounds.of, rounds.table, end, size), rounds.risen
        few = len(found[0]) * 4 < size
        near = narrow(pairs, found[0], size) if few and len(found[0]) else pairs
        rose, last = False, rounds.risen
        while len(found[0]) and rounds.go(near, *found):
            rose = True
            if not few or rounds.risen - last < enough:
                break
            last = rounds.risen
            found = propose(near, rounds.of, rounds.table, end, size)
        if near is not pairs:
            scratch.discard(near)
        if not rose or rounds.risen - before < enough:
            return rounds.of, rounds.table


def _mixed(symbol: np.ndarray, turn: int) -> np.ndarray:
    """A hash of each symbol in a turn."""
    x = symbol.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn * 0xBF58476D1CE4E5B9 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(20)


@dataclass
class Model:
    """Class of each symbol, log10 of class transitions, log10 of each class's emission denominator."""

    of: np.ndarray
    step: np.ndarray
    room: np.ndarray


def class_sizes(vocabulary: DataFrame, words, of: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, distinct words) of each class over the whole vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, tokens, kinds = _coder(words), np.zeros(settings.classes), np.zeros(settings.classes, np.int64)
        for batch in batches:
            some = batch.column(0).to_pylist()
            at = of[coder.symbols(some, coder.places(some))]
            kinds += np.bincount(at, minlength=settings.classes)
            tokens += np.bincount(at, batch.column(1).to_numpy(zero_copy_only=False), settings.classes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(settings.classes)), pa.array(tokens.astype(np.int64)), pa.array(kinds)], ["class", "n", "v"]
        )

    sums = vocabulary.filter(F.length("word") > 0).mapInArrow(run, "class long, n long, v long").groupBy("class")
    out = np.zeros((2, settings.classes))
    for r in sums.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        out[:, r["class"]] = r["n"], r["v"]
    return out[0], out[1]


def fit(pairs: np.ndarray, of: np.ndarray, sizes: tuple[np.ndarray, np.ndarray], settings: Settings) -> Model:
    """Transitions backed off to how often classes occur, emissions with ADD for every word and one unseen one."""
    member = np.zeros((len(of), settings.classes))
    member[np.arange(len(of)), of] = 1
    table = member.T @ pairs @ member
    return fit_classes(table, of, np.bincount(of, minlength=settings.classes) > 0, sizes, settings)


def fit_classes(table: np.ndarray, of: np.ndarray, used: np.ndarray, sizes: tuple[np.ndarray, np.ndarray], settings: Settings) -> Model:
    """The model from class bigrams and the classes in use."""
    usual = (table.sum(0) + 0.5) * used
    usual /= usual.sum()
    step = (table + settings.backoff * usual) / (table.sum(1, keepdims=True) + settings.backoff)
    room = np.log10(sizes[0] + ADD * (sizes[1] + 1))
    room[0] = 0.0
    return Model(of, np.log10(np.maximum(step, 1e-300)), room)


def score(docs: DataFrame, is_taught: Column, held_out: Column, settings: Settings = Settings()) -> DataFrame:
    """Log10 probability of every whole text under the class model and under a unigram model.

    Learns from the rows where ``is_taught`` is true. A text is lower-cased (A-Z),
    cut at ASCII white space and closed by one end token. Returns doc_id,
    held_out, n_tokens, n_known (tokens that occur in training), train_tokens,
    base_score (add-0.1 unigrams) and score: the sum of log10 P(class | class
    before) + log10 P(word | class).

    Null, empty and wordless texts are one end token. Without training rows
    every token counts as unseen. Repeated rows are learned from and scored as
    often as they stand; other columns are left out.

    Counts of all words come from the whole training text. A few frequent words
    (see Settings) are with the tasks; the others are joined to their counts. Of
    other words seen twice or more tasks and driver hold a key of eight bytes
    and the class.
    """
    spark = docs.sparkSession
    texts = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("binary").alias("text"),
        is_taught.alias("taught"), held_out.alias("held_out"),
    )
    taught = texts.filter("taught")
    vocabulary = scratch.stage(count_words(taught), "vocabulary")
    totals = vocabulary.agg(F.count(F.lit(1)).alias("v"), F.sum("c").alias("n"), F.max(F.when(F.length("word") == 0, F.col("c"))).alias("ends")).first()
    distinct, tokens, ends = totals["v"], totals["n"] or 0, totals["ends"] or 0
    frequent, counts = frequent_words(vocabulary, settings)
    rare = repeated_keys(vocabulary, frequent, settings)
    words = spark.sparkContext.broadcast((frequent, settings, rare, scratch.new_path(spark, "words")))
    start, end = starting_symbols(frequent, rare, settings), len(frequent) + settings.endings
    coded = scratch.stage(code_texts(texts, words, counts), "coded")
    pairs = scratch.stage(count_pairs(coded.filter("taught"), end, len(start)), "pairs")
    first = exchange(group_table(pairs, start, settings.symbols, len(start)), settings)
    of, table = exchange_rounds(pairs, first[start].astype(np.min_scalar_type(settings.classes)), end, settings)
    used = np.bincount(np.concatenate([first, of]), minlength=settings.classes) > 0
    learned = spark.sparkContext.broadcast(fit_classes(table, of, used, class_sizes(vocabulary, words, of, settings), settings))
    all_room, end_log = float(np.log10(tokens + ADD * (distinct + 1))), float(np.log10(ends + ADD))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = learned.value
        step, classes = model.step.ravel(), len(model.step)
        for batch in batches:
            n_tokens, seen = (batch.column(c).to_numpy() for c in (3, 5))
            fixed = []
            for body, held_log in zip(batch.column(6).to_pylist(), seen):
                of = model.of[np.frombuffer(body, "<i4")]
                path = np.concatenate([[0], of, [0]])
                fixed.append(step[path[:-1] * classes + path[1:]].sum() - model.room[of].sum() + held_log)
            base = seen + end_log - n_tokens * all_room
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(base), pa.array(fixed, pa.float64())], names)

    names = ["row", "doc_id", "held_out", "n_tokens", "held", "base", "fixed"]
    scored = coded.select(*names[:5], "seen", "symbols").mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, held long, base double, fixed double"
    )
    rest = coded.select("row", F.explode("rest").alias("word")).join(vocabulary, "word", "left")
    per_row = rest.groupBy("row").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + ADD)).alias("rare_log"), F.count("c").alias("rare_known")
    )
    whole = scored.join(per_row, "row", "left")
    known = F.col("held") + F.lit(int(ends > 0)) + F.coalesce("rare_known", F.lit(0))
    rest_log = F.coalesce("rare_log", F.lit(0.0))
    return whole.select(
        "doc_id", "held_out", "n_tokens", known.alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), (F.col("base") + rest_log).alias("base_score"),
        (F.col("fixed") + rest_log).alias("score"),
    )
