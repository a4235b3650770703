"""Near duplicates by MinHash signatures in an LSH forest, confirmed on whole shingle sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm import texts
from tillwise.llm.components import connected_components
from tillwise.llm.simhash import merge
from tillwise.sources import scratch

#: Bits of a sketch, one per hash function, as four longs.
SKETCH = 256
WORDS = [f"b{i}" for i in range(SKETCH // 64)]
#: Shingles hashed together; bounds memory.
CHUNK = 2048


@dataclass(frozen=True)
class Forest:
    """Settings: words of a shingle, least similarity in percent, orders, values of an order, documents of a region.

    ``slack`` is how many standard deviations a sketch may lie under the least
    similarity before a pair is no candidate.
    """

    shingle: int = 3
    percent: int = 85
    trees: int = 16
    depth: int = 8
    region: int = 1024
    slack: float = 4.5

    def most_apart(self) -> int:
        agree = (1 + self.percent / 100) / 2
        return int(SKETCH * (1 - agree + self.slack * (agree * (1 - agree) / SKETCH) ** 0.5))


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    found = list(texts.shingle_hashes(text or b"", width, 0))
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)


@cache
def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.Generator(np.random.Philox(key=[12, n])).integers(0, 1 << 63, (2, n), np.uint64)
    return drawn[0] * np.uint64(2) + np.uint64(1), drawn[1]


def minima(hashes: np.ndarray, n: int) -> np.ndarray:
    """The least value of each of ``n`` hash functions over the set, mixed so that its first bits are as random as the others."""
    factor, shift = _functions(n)
    least = np.full(n, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), CHUNK):
        np.minimum(least, (hashes[at : at + CHUNK, None] * factor + shift).min(0), out=least)
    mixed = least * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


def signatures(docs: DataFrame, how: Forest) -> DataFrame:
    """One row per document: doc_id, text_hash, n (shingles), node (hash of the set), heads, paths and the sketch.

    Each order has its own values of the signature: the first one whole in
    ``heads``, the others cut to 16 bits in ``paths``.
    """
    used, depth = how.trees * how.depth, how.depth
    if used > SKETCH:
        raise ValueError(f"trees * depth is over {SKETCH}")

    def rows(columns: dict[str, list]) -> Iterator[tuple]:
        import xxhash

        for doc_id, text, text_hash in zip(columns["doc_id"], columns["text"], columns["text_hash"]):
            hashes = shingle_set(text, how.shingle)
            if not len(hashes):
                yield doc_id, text_hash, 0, None, None, None, *[None] * len(WORDS)
                continue
            values = minima(hashes, SKETCH)
            node = int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), 1)).astype(np.int64))
            orders = values[:used].reshape(how.trees, depth)
            paths = (orders[:, 1:] >> np.uint64(48)).astype("<u2")
            bits = np.packbits((values >> np.uint64(63)).astype(bool)).view("<i8")
            yield doc_id, text_hash, len(hashes), node, orders[:, 0].astype(np.int64).tolist(), [p.tobytes() for p in paths], *bits.tolist()

    whole = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("text_hash"))
    sketch = ", ".join(f"{w} long" for w in WORDS)
    schema = f"doc_id long, text_hash long, n long, node long, heads array<long>, paths array<binary>, {sketch}"
    return texts.map_rows(whole, rows, schema, flush=5000)


def _apart(left: str, right: str) -> Column:
    parts = [F.bit_count(F.col(f"{left}.{w}").bitwiseXOR(F.col(f"{right}.{w}"))) for w in WORDS]
    return sum(parts[1:], parts[0])


def hubs(members: DataFrame) -> DataFrame:
    """(label, hub) of groups: the member whose sketch agrees best with the majority of each bit.

    Where many documents differ from one original and hardly any two of them are
    similar enough, the original is that member. Tasks add up bits before they
    are grouped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            labels, back = np.unique(batch.column("label").to_numpy(), return_inverse=True)
            order = np.argsort(back, kind="stable")
            starts = np.searchsorted(back[order], np.arange(len(labels)))
            for i, word in enumerate(WORDS):
                packed = batch.column(word).to_numpy()[order].astype("<i8")
                bits = np.unpackbits(packed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int64)
                balance = np.add.reduceat(2 * bits - 1, starts, axis=0)
                columns = [np.repeat(labels, 64), np.tile(np.arange(i * 64, i * 64 + 64), len(labels)), balance.ravel()]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["label", "bit", "balance"])

    votes = members.select("label", *WORDS).mapInArrow(run, "label long, bit long, balance long")
    won = votes.groupBy("label", "bit").agg(F.sum("balance").alias("balance"))
    bit_of = [
        F.bit_or(F.when((F.col("balance") > 0) & (F.floor(F.col("bit") / 64) == i), F.expr("shiftleft(1L, cast(bit % 64 as int))")).otherwise(0)).alias(w)
        for i, w in enumerate(WORDS)
    ]
    majority = won.groupBy("label").agg(*bit_of).alias("m")
    apart = _apart("c", "m").alias("apart")
    measured = members.alias("c").join(majority, "label").select("label", apart, "node")
    return measured.groupBy("label").agg(F.min(F.struct("apart", "node")).alias("hub")).select("label", F.col("hub.node").alias("node"))


def forest_rows(sets: DataFrame) -> DataFrame:
    """(tree, head, path, node, n, sketch): each set once in every order."""
    rows = sets.select("node", "n", *WORDS, F.posexplode(F.arrays_zip("heads", "paths")).alias("tree", "order"))
    return rows.select("tree", F.col("order.heads").alias("head"), F.col("order.paths").alias("path"), "node", "n", *WORDS)


def in_order(rows: DataFrame) -> DataFrame:
    """Rows of a forest sorted along every order; equal beginnings stand together, crowded ones on several partitions."""
    order = ["tree", "head", "path", "node"]
    return rows.repartitionByRange(texts.shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)


def cuts(tree: np.ndarray, head: np.ndarray, path: np.ndarray, region: int) -> np.ndarray:
    """Where units of sorted rows end.

    Rows that begin with the same value of the same order are a unit, if there
    are at most ``region``. Otherwise a unit ends behind half a region to a whole
    one, where the longest common prefix of neighbours is shortest: so the depth
    to which members of a unit agree follows how crowded the place is.
    """
    together = (tree[1:] == tree[:-1]) & (head[1:] == head[:-1])
    common = np.where(together, 1 + np.cumprod(path[1:] == path[:-1], axis=1).sum(1), 0)
    runs = np.append(np.flatnonzero(common == 0) + 1, len(tree))
    ends, start = [], 0
    for end in runs.tolist():
        while end - start > region:
            low = start + region // 2
            start = low + 1 + int(np.argmin(common[low : start + region]))
            ends.append(start)
        ends.append(end)
        start = end
    return np.array(ends, np.int64)


def _units(batches: Iterator[pa.RecordBatch], region: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows, and the unit of each; a unit may go on in the next batch and is held until then."""
    held, rows = [], 0
    for last, batch in _with_last(batches):
        held.append(batch)
        rows += batch.num_rows
        if rows < 4 * region and not last:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        if not table.num_rows:
            continue
        path = np.frombuffer(b"".join(table.column("path").to_pylist()), "<u2").reshape(table.num_rows, -1)
        ends = cuts(table.column("tree").to_numpy(), table.column("head").to_numpy(), path, region)
        upto = table.num_rows if last else (int(ends[-2]) if len(ends) > 1 else 0)
        yield table.slice(0, upto), np.searchsorted(ends, np.arange(upto), "right")
        held, rows = table.slice(upto).to_batches(), table.num_rows - upto


def _with_last(items: Iterator) -> Iterator[tuple[bool, object]]:
    before = None
    for item in items:
        if before is not None:
            yield False, before
        before = item
    if before is not None:
        yield True, before


def loose_links(unit: np.ndarray, sketch: np.ndarray, n: np.ndarray, most: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as positions, of the pairs in one unit whose sketches and sizes may be similar enough.

    Rows are sorted by unit; a row is compared with the next one, the one after
    it and so on as long as they share its unit.
    """
    label = np.arange(len(unit))
    end = np.searchsorted(unit, unit, "right")
    at, step = np.arange(len(unit)), 1
    while len(at := at[at + step < end[at]]):
        other = at + step
        apart = np.bitwise_count(sketch[at] ^ sketch[other]).sum(1)
        sized = 100 * np.minimum(n[at], n[other]) >= percent * np.maximum(n[at], n[other])
        hit = (apart <= most) & sized & (label[at] != label[other])
        if hit.any():
            label = merge(label, at[hit], other[hit])
        step += 1
    linked = np.flatnonzero(label != np.arange(len(unit)))
    return linked, label[linked]


def loose_pairs(rows: DataFrame, how: Forest) -> DataFrame:
    """(u, v): links that join up all candidates of every unit."""
    most, percent, region = how.most_apart(), how.percent, how.region

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, unit in _units(batches, region):
            node, n = (block.column(c).to_numpy() for c in ("node", "n"))
            sketch = np.stack([block.column(w).to_numpy().view(np.uint64) for w in WORDS], axis=1)
            a, b = loose_links(unit, sketch, n, most, percent)
            yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], ["u", "v"])

    return in_order(rows).mapInArrow(run, "u long, v long").distinct()


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * |a and b| >= percent * |a or b|, of sorted sets."""
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed(sets: list[np.ndarray], sketch: np.ndarray, most: int, percent: int, centres: int = 4) -> list[tuple[int, int]]:
    """Links between similar sets that join up all similar sets among the candidates, as pairs of positions.

    Sets with the most candidates are compared with all theirs first. Then all
    other candidates follow, the nearest sketches first; a pair that is already
    joined needs no look.
    """
    m, n = len(sets), np.array([len(s) for s in sets])
    apart = sum(np.bitwise_count(sketch[:, None, i] ^ sketch[None, :, i]).astype(np.int16) for i in range(sketch.shape[1]))
    near = (apart <= most) & (100 * np.minimum(n[:, None], n) >= percent * np.maximum(n[:, None], n))
    np.fill_diagonal(near, False)
    label, links = np.arange(m), []

    def look(i: int, j: int) -> None:
        if label[i] != label[j] and similar(sets[i], sets[j], percent):
            label[label == label[j]] = label[i]
            links.append((i, j))

    first = np.argsort(-near.sum(1), kind="stable")[:centres]
    for i in first:
        for j in np.flatnonzero(near[i]):
            look(int(i), int(j))
    near[first] = near[:, first] = False
    row, other = np.nonzero(np.triu(near))
    open_ = label[row] != label[other]
    row, other = row[open_], other[open_]
    for i, j in zip(*(x[np.argsort(apart[row, other], kind="stable")].tolist() for x in (row, other))):
        look(i, j)
    return links


def _confirm(rows: DataFrame, keyed: Callable, how: Forest) -> DataFrame:
    """(u, v) links between similar documents; ``keyed`` gives (unit, node, text, sketch) of sorted batches, a unit at a time."""
    most, percent, width = how.most_apart(), how.percent, how.shingle

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, members in groupby(keyed(batches), key=itemgetter(0)):
            nodes, sets, bits = [], [], []
            for _, node, text, sketch in members:
                if node not in nodes[-1:]:
                    nodes.append(node)
                    sets.append(shingle_set(text, width))
                    bits.append(sketch)
            sketch = np.array(bits, np.int64).view(np.uint64)
            links = confirmed(sets, sketch, most, percent) if len(nodes) > 1 else []
            yield pa.RecordBatch.from_arrays([pa.array([nodes[x[k]] for x in links], pa.int64()) for k in (0, 1)], ["u", "v"])

    return rows.mapInArrow(run, "u long, v long")


def _members(table: pa.Table | pa.RecordBatch, units: list[int]) -> Iterator[tuple]:
    nodes, words = table.column("node").to_pylist(), zip(*(table.column(w).to_pylist() for w in WORDS))
    text = table.column("text")
    for i, (unit, node, sketch) in enumerate(zip(units, nodes, words)):
        yield unit, node, text[i].as_py(), sketch


def confirm_units(placed: DataFrame, how: Forest) -> DataFrame:
    """Links within the units of (unit, node, text, sketch) rows."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from _members(batch, batch.column("unit").to_pylist())

    together = placed.repartition(texts.shuffle_partitions(placed.sparkSession), "unit").sortWithinPartitions("unit", "node")
    return _confirm(together, keyed, how)


def confirm_orders(rows: DataFrame, how: Forest) -> DataFrame:
    """Links within the units of a forest whose rows have their texts."""
    region = how.region

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for k, (table, units) in enumerate(_units(batches, region)):
            yield from _members(table, [(k, u) for u in units.tolist()])

    return _confirm(in_order(rows), keyed, how)


def links(docs: DataFrame, signed: DataFrame, how: Forest) -> DataFrame:
    """(u, v): links between nodes that join up all documents that the forest brings together and whose whole sets are similar.

    Candidates are first joined up by sketches alone. A group of up to
    ``region`` sets goes whole to one task, its texts once. Larger groups go
    through the orders again, now with their texts, and every member also meets
    the group's hub.
    """
    rep = F.min(F.struct("doc_id", "text_hash")).alias("rep")
    sets = signed.filter("n > 0").groupBy("node").agg(rep, *(F.first(c).alias(c) for c in ("n", "heads", "paths", *WORDS)))
    sets = scratch.stage(sets, "sets")
    loose = scratch.stage(connected_components(loose_pairs(forest_rows(sets), how)), "loose")
    size = loose.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    grouped = texts.spread_join(loose, size, "label", "size", loose.count())
    wanted = sets.select("node", "rep", *WORDS).join(grouped, "node")
    hashed = docs.select(F.col("doc_id").alias("doc"), "text", F.xxhash64("text").alias("hash"))
    same = hashed["doc"].eqNullSafe(wanted["rep.doc_id"]) & (hashed["hash"] == wanted["rep.text_hash"])
    texted = hashed.join(wanted, same).select("node", "label", "size", F.col("text").cast("binary").alias("text"), *WORDS)
    texted = scratch.stage(texted.dropDuplicates(["node"]), "candidates")
    columns = ["unit", "node", "text", *WORDS]
    placed = texted.filter(F.col("size") <= how.region).withColumn("unit", F.col("label")).select(columns)
    large = texted.filter(F.col("size") > how.region)
    if large.isEmpty():
        return confirm_units(placed, how)
    parts = F.ceil(F.col("size") / how.region).cast("int").alias("parts")
    hub = large.select("*", parts).join(hubs(large), ["label", "node"])
    units = F.xxhash64("label", F.col("part")).alias("unit")
    hub = hub.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).select(units, *columns[1:])
    dealt = large.select("*", parts).withColumn("part", F.expr("cast(pmod(xxhash64(node), parts) as int)")).select(units, *columns[1:])
    rows = forest_rows(sets).select("tree", "head", "path", "node").join(large.select(columns[1:]), "node")
    return confirm_units(placed.unionByName(dealt).unionByName(hub), how).unionByName(confirm_orders(rows, how))


def near_duplicates(docs: DataFrame, how: Forest = Forest()) -> DataFrame:
    """Shingles and component of every document.

    Two documents are linked if 100 * |common shingles| >= ``percent`` * |all
    their shingles|; shingles are runs of ``shingle`` words with A to Z as small
    letters, each counted once, fewer words the whole sequence. Returns doc_id,
    n_shingles, component_id (the smallest doc_id that links reach) and kept
    (doc_id is component_id), one row per input row.

    A null, empty or wordless text has no shingles, is linked to nothing and is
    its own component; so rows that repeat its doc_id are all kept, as are other
    rows that repeat a kept doc_id and its text. A null doc_id is never the
    smallest: a component without any other has a null component_id and its rows
    are kept. Other columns are left out.

    Candidates come from sorted orders of the signature: a linked pair shares the
    first value of an order with probability 0.85 or more, and with 16 orders
    misses all of them once in 10^13. Where more than ``region`` documents share
    a value and neighbours agree on more, the odds fall to one in 10^9 at two
    values and one in 10^5 at four; hubs make up for the pairs of an original and
    its variants. Nodes are 64 bit hashes of sets.
    """
    signed = scratch.stage(signatures(docs, how), "signatures")
    reached = connected_components(links(docs, signed, how))
    of = signed.select("doc_id", "node", "n").join(reached.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
    grouped = scratch.stage(of.select("doc_id", "n", F.coalesce("label", "node").alias("label")), "labelled")
    worded = grouped.filter("n > 0")
    smallest = worded.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("members"))
    joined = texts.spread_join(worded, smallest, "label", "members", worded.count())
    alone = grouped.filter("n = 0").withColumn("component_id", F.col("doc_id"))
    out = joined.drop("members").unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
