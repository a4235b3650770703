"""Near duplicates by SimHash fingerprints, searched in BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm import texts
from tillwise.llm.components import connected_components
from tillwise.sources import scratch

BITS = 64
#: Distances 0 to 64 of a node's children, as digits of a key.
SPAN = BITS + 1
#: (query, node) pairs looked at together in one task.
FRONTIER = 1 << 21


def fingerprint(text: bytes | None, shingle: int) -> int:
    """A bit is set if it is set in over half the shingles' hashes; zero without a word."""
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in texts.shingle_hashes(text or b"", shingle, 42):
        n += len(hashes)
        for at in range(0, len(hashes), 1 << 16):
            part = hashes[at : at + (1 << 16)].astype("<u8")
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp, text_hash) of every document; fp is the fingerprint as a signed long."""

    def rows(columns: dict[str, list]) -> Iterator[tuple]:
        for doc_id, text, text_hash in zip(columns["doc_id"], columns["text"], columns["text_hash"]):
            yield doc_id, fingerprint(text, shingle), text_hash

    whole = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("text_hash"))
    return texts.map_rows(whole, rows, "doc_id long, fp long, text_hash long")


def shard_masks(distinct: int, radius: int, shard_size: int = 64) -> list[int]:
    """Masks that between them keep any two fingerprints within the radius together.

    Cut into b blocks, two fingerprints that differ in r bits agree in b - r
    blocks at least, so one mask for each choice of b - r blocks misses no pair.
    More blocks give more masks and smaller shards; b is the least that makes
    evenly spread shards of at most ``shard_size``. It changes no result.
    """
    for blocks in range(radius + 1, radius + 4):
        same = blocks - radius
        if distinct <= shard_size * 2.0 ** (BITS * same / blocks):
            break
    cuts = [round(BITS * i / blocks) for i in range(blocks + 1)]
    block = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    masks = [sum(chosen) for chosen in combinations(block, same)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def grow_trees(fp: np.ndarray, root_of: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One BK-tree per root over the members: sorted (parent, distance) keys and the child under each.

    Nodes are positions in ``fp``. All trees grow a level at a time: a node
    takes one child per distance to it, everything else at that distance moves
    below that child.
    """
    pending = members[members != root_of[members]]
    at = root_of[pending]
    keys, children = [], []
    while len(pending):
        key = at.astype(np.int64) * SPAN + np.bitwise_count(fp[pending] ^ fp[at])
        found, first, back = np.unique(key, return_index=True, return_inverse=True)
        child = pending[first]
        keys.append(found)
        children.append(child)
        below = child[back]
        rest = below != pending
        pending, at = pending[rest], below[rest]
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key, child = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(key)
    return key[order], child[order]


def search_trees(
    fp: np.ndarray, keys: np.ndarray, children: np.ndarray, queries: np.ndarray, roots: np.ndarray, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, node) links, following only edges whose distance is within the radius of the query's."""
    q, node = queries, roots
    while len(q):
        apart = np.bitwise_count(fp[q] ^ fp[node]).astype(np.int64)
        hit = (apart <= radius) & (q != node)
        yield q[hit], node[hit]
        low = np.searchsorted(keys, node * SPAN + np.maximum(apart - radius, 0), "left")
        high = np.searchsorted(keys, node * SPAN + np.minimum(apart + radius, BITS), "right")
        n = high - low
        edge = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        q, node = np.repeat(q, n), children[edge]


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking a to b: the smallest position of each component."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        parent = np.arange(len(label))
        np.minimum.at(parent, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while not np.array_equal(jumped := parent[parent], parent):
            parent = jumped
        label = parent[label]


def link_shards(fp: np.ndarray, shard: np.ndarray, in_tree: np.ndarray, asks: np.ndarray, radius: int):
    """A spanning forest of the links inside each shard, as pairs of positions.

    ``shard`` is sorted; ``in_tree`` and ``asks`` say which rows stand in the
    shard's tree and which are looked up in it. Only the forest leaves the task:
    links inside a group of near copies would be all its pairs.
    """
    label = np.arange(len(fp))
    members = np.flatnonzero(in_tree)
    own, first = np.unique(shard[members], return_index=True)
    place = np.searchsorted(own, shard)
    place[place == len(own)] = 0
    rooted = own[place] == shard if len(own) else np.zeros(len(fp), bool)
    root_of = members[first][place] if len(own) else np.zeros(len(fp), np.int64)
    keys, children = grow_trees(fp, root_of, members)
    queries = np.flatnonzero(asks & rooted)
    if len(queries):
        size = np.bincount(place[members], minlength=len(own))[place[queries]]
        piece = np.cumsum(size) // FRONTIER
        for part in np.split(queries, np.flatnonzero(np.diff(piece)) + 1):
            for a, b in search_trees(fp, keys, children, part, root_of[part], radius):
                label = merge(label, a, b)
    linked = np.flatnonzero(label != np.arange(len(fp)))
    return linked, label[linked]


def _shard_keys(fp: Column, masks: list[int]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(i).alias("mask"), fp.bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)]))


def fingerprint_links(distinct: DataFrame, radius: int, tree_size: int = 4096) -> DataFrame:
    """(u, v) links that join up all fingerprints within ``radius`` of each other.

    ``distinct`` has one row per fp. A shard is what agrees under one mask. A
    shard beyond ``tree_size`` is dealt into trees of about that size, and each
    tree is asked by the shard's other trees in tasks of their own, so no task
    grows with the shard.
    """
    spark = distinct.sparkSession
    masks = shard_masks(distinct.count(), radius)
    keyed = distinct.select("fp", _shard_keys(F.col("fp"), masks).alias("s")).select("fp", "s.mask", "s.key")
    large = keyed.groupBy("mask", "key").count().filter(F.col("count") > tree_size)
    trees = F.ceil(F.coalesce("count", F.lit(1)) / tree_size).cast("int")
    dealt = keyed.join(large, ["mask", "key"], "left").select("fp", "mask", "key", trees.alias("trees"))
    dealt = dealt.withColumn("tree", F.expr("cast(pmod(xxhash64(fp), trees) as int)"))
    pairs = dealt.withColumn("other", F.explode(F.expr("sequence(0, trees - 1)"))).select(
        "fp", "mask", "key", F.least("tree", "other").alias("tree"), F.greatest("tree", "other").alias("asker"),
        (F.col("tree") <= F.col("other")).alias("in_tree"), (F.col("tree") >= F.col("other")).alias("asks"),
    )
    order = ["mask", "key", "tree", "asker"]
    placed = pairs.repartition(texts.shuffle_partitions(spark), *order).sortWithinPartitions(*order, "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            table = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names}
            shard = np.stack([table[c].astype(np.int64) for c in order])
            held.append(np.concatenate([shard, table["fp"][None], table["in_tree"][None], table["asks"][None]]).astype(np.int64))
            block = np.concatenate(held, axis=1)
            starts = np.flatnonzero((block[:4, 1:] != block[:4, :-1]).any(0)) + 1
            if len(starts) == 0:
                held = [block]
                continue
            yield linked(block[:, : starts[-1]], starts[:-1])
            held = [block[:, starts[-1] :]]
        if held:
            block = np.concatenate(held, axis=1)
            yield linked(block, np.flatnonzero((block[:4, 1:] != block[:4, :-1]).any(0)) + 1)

    def linked(block: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        shard = np.zeros(block.shape[1], np.int64)
        shard[starts] = 1
        shard = np.cumsum(shard)
        size = np.bincount(shard)[shard]
        alone = size == 1
        block, shard = block[:, ~alone], shard[~alone]
        fp = block[4]
        a, b = link_shards(fp.view(np.uint64), shard, block[5] > 0, block[6] > 0, radius)
        return pa.RecordBatch.from_arrays([pa.array(fp[a], pa.int64()), pa.array(fp[b], pa.int64())], ["u", "v"])

    return placed.mapInArrow(run, "u long, v long")


def _components(marked: DataFrame, radius: int) -> DataFrame:
    """(fp, label) for every fingerprint; the label is one fingerprint of the component."""
    distinct = scratch.stage(marked.select("fp").distinct(), "fingerprints")
    links = fingerprint_links(distinct, radius)
    reached = connected_components(links)
    return distinct.join(reached.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("label", "fp").alias("label")
    )


def near_duplicates(docs: DataFrame, shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """Fingerprint and component of every document.

    Returns (doc_id, fingerprint, component_id): 16 hex digits, and the smallest
    doc_id that links of at most ``max_distance`` differing bits reach. One row
    per input row, repeated rows included. A null or wordless text has
    fingerprint zero and is linked like any other; a null doc_id is kept and is
    never the smallest (a component without any other has a null component_id).
    Other columns are left out.
    """
    marked = scratch.stage(fingerprints(docs, shingle), "simhash")
    labelled = scratch.stage(_components(marked, max_distance), "simhash-labels")
    first = marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows"))
    named = scratch.stage(labelled.join(first, "fp"), "simhash-firsts")
    smallest = named.groupBy("label").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("members"))
    of = texts.spread_join(named, smallest, "label", "members", named.count()).select("fp", "component_id", "rows")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return texts.spread_join(marked, of, "fp", "rows", marked.count()).select("doc_id", hexed, "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """The documents without near duplicates: of each component the smallest doc_id stays.

    Null doc_ids come last; rows that share doc_id go by a hash of their text,
    and rows that repeat both are one document. All columns are kept.
    """
    marked = scratch.stage(fingerprints(docs, shingle), "simhash")
    labelled = scratch.stage(_components(marked, max_distance), "simhash-labels")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    best = marked.groupBy("fp").agg(F.min(order).alias("best"))
    chosen = labelled.join(best, "fp").groupBy("label").agg(F.min("best").alias("best"))
    kept = chosen.select(F.col("best.doc_id").alias("kept_id"), F.col("best.text_hash").alias("kept_hash"))
    names = [f"c{i}" for i in range(len(docs.columns))]
    doc_id, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    hashed = docs.toDF(*names).withColumn("text_hash", F.xxhash64(text))
    same = F.col(doc_id).eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash"))
    one = hashed.join(kept, same, "left_semi").dropDuplicates([doc_id, "text_hash"])
    return one.select(*names).toDF(*docs.columns)
