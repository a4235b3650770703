"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.sources import scratch


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def connected_components(links: DataFrame) -> DataFrame:
    """Smallest node each linked node can reach.

    ``links`` has long columns u and v, in any direction; repeated rows and self
    links do no harm, and no links give no rows. Returns (node, label) for every
    node that has a link to another.

    Every round turns each node's larger neighbours, then its smaller ones,
    towards its smallest neighbour. The smallest neighbour comes from a partial
    aggregate and goes back by a join: nothing is collected per node, but the
    links of a node with very many pass through one task of the join, unless
    Spark's handling of skewed joins splits it. Rounds are written to the shared
    folder, each in place of the one before; their number grows with the
    logarithm of the longest path.
    """
    pairs = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = scratch.stage(pairs.filter("u <> v").distinct(), "links")
    before = None
    while (now := _signature(edges)) != before:
        before = now
        both = edges.union(edges.select("v", "u"))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        spent, edges = edges, scratch.stage(small.union(smallest.select("u", "m")).distinct(), "links")
        scratch.discard(spent)
    pointed = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("label"))
    return pointed.union(roots)
