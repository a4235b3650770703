"""Centroid clustering of integer vectors, filtered by leading principal coordinates."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tillwise.sources import scratch

#: Components beyond this have no distance that a long holds.
LARGEST = 1 << 26
#: Rows looked at together; with the centroids it bounds a task's memory.
ROWS = 4096
#: Share of the vectors' squared norms by which rounding may lift a bound.
SLACK = 1e-9


@dataclass(frozen=True)
class Clustering:
    """Settings: components of a kept vector, units of a whole component, clusters, rounds, seed.

    ``held`` is the share of the variance that the stored leading coordinates hold.
    """

    dims: int = 64
    scale: int = 64
    clusters: int = 16
    rounds: int = 3
    seed: str = "1"
    held: float = 0.9


def whole_components(vectors: pa.Array, how: Clustering) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are kept, and floor(scale * x) of their components.

    Kept are those with exactly ``dims`` components, none null, NaN or infinite.
    """
    lengths = np.nan_to_num(vectors.value_lengths().to_numpy(zero_copy_only=False), nan=-1).astype(np.int64)
    sized = lengths == how.dims
    flat = vectors.filter(pa.array(sized)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    table = flat.reshape(-1, how.dims)
    finite = np.isfinite(table).all(1)
    kept = np.flatnonzero(sized)[finite]
    scaled = np.floor(how.scale * table[finite])
    if len(scaled) and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST} after scaling: its distances do not fit a long")
    return kept, scaled.astype(np.int64)


def _batches(batches: Iterator[pa.RecordBatch], how: Clustering) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            kept, whole = whole_components(part.column(1), how)
            yield part.column(0).take(pa.array(kept, pa.int64())), whole


def moments(vectors: DataFrame, how: Clustering) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, sums and sums of products of all kept vectors; tasks add up first, ``dims`` rows come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, np.zeros(how.dims), np.zeros((how.dims, how.dims))
        for _, whole in _batches(batches, how):
            n += len(whole)
            table = whole.astype(np.float64)
            total += table.sum(0)
            products += table.T @ table
        if n:
            axes = np.arange(how.dims)
            columns = [np.full(how.dims, n), axes, total, *products.T]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["n", "axis", "total", *(f"p{i}" for i in axes)])

    with_each = [f"p{i}" for i in range(how.dims)]
    schema = "n long, axis long, total double, " + ", ".join(f"{p} double" for p in with_each)
    added = vectors.mapInArrow(run, schema).groupBy("axis").agg(*(F.sum(c).alias(c) for c in ("n", "total", *with_each)))
    rows = sorted(added.collect(), key=lambda r: r.axis)
    if not rows:
        return 0, np.zeros(how.dims), np.zeros((how.dims, how.dims))
    return rows[0].n, np.array([r.total for r in rows]), np.array([[r[p] for p in with_each] for r in rows])


@dataclass(frozen=True)
class Axes:
    """Orthonormal axes as columns, those along which the vectors vary most in front, and how many coordinates are stored."""

    turn: np.ndarray
    leading: int


def principal_axes(n: int, total: np.ndarray, products: np.ndarray, held: float) -> Axes:
    """Axes of the vectors' covariance; the fewest leading ones that hold the share ``held`` of the variance."""
    mean = total / max(n, 1)
    variance, axes = np.linalg.eigh(products / max(n, 1) - np.outer(mean, mean))
    upto = np.cumsum(np.maximum(variance[::-1], 0))
    return Axes(axes[:, ::-1], int(np.searchsorted(upto, held * upto[-1])) + 1)


def rotate(whole: np.ndarray, axes: Axes) -> tuple[np.ndarray, np.ndarray]:
    """The leading coordinates along the axes, and the norm of the rest."""
    turned = whole @ axes.turn
    return turned[:, : axes.leading], np.sqrt((turned[:, axes.leading :] ** 2).sum(1))


def nearest(
    whole: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray, c_lead: np.ndarray, c_rest: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of every vector, its squared distance, and how many distances were worked out.

    The squared distance of the leading coordinates plus the squared difference
    of the residual norms is never above the squared distance. The centroid with
    the least bound is measured first; of the others only those whose bound does
    not exceed that distance.
    """
    apart = ((lead**2).sum(1)[:, None] - 2 * lead @ c_lead.T) + (c_lead**2).sum(1)
    bound = apart + (rest[:, None] - c_rest) ** 2
    norms = (lead**2).sum(1) + rest**2
    bound -= SLACK * (norms[:, None] + (c_lead**2).sum(1) + c_rest**2 + 1)
    rows = np.arange(len(whole))
    cluster = bound.argmin(1)
    distance = ((whole - centroids[cluster]) ** 2).sum(1)
    row, other = np.nonzero(bound <= distance[:, None])
    fresh = other != cluster[row]
    row, other = row[fresh], other[fresh]
    exact = np.full(bound.shape, np.iinfo(np.int64).max)
    exact[rows, cluster] = distance
    exact[row, other] = ((whole[row] - centroids[other]) ** 2).sum(1)
    cluster = exact.argmin(1)
    return cluster, exact[rows, cluster], len(rows) + len(row)


def _lists(table: np.ndarray) -> pa.Array:
    rows, width = table.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (rows + 1) * width, width), pa.int32()), pa.array(table.ravel()))


def _rotated(vectors: DataFrame, axes: Axes, how: Clustering) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, whole in _batches(batches, how):
            lead, rest = rotate(whole, axes)
            yield pa.RecordBatch.from_arrays([ids, _lists(whole), _lists(lead), pa.array(rest)], ["id", "whole", "lead", "rest"])

    return vectors.mapInArrow(run, "id long, whole array<long>, lead array<double>, rest double")


def _table(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, axes: Axes, how: Clustering) -> Iterator[tuple]:
    c_lead, c_rest = rotate(centroids, axes)
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            whole, lead = _table(part, "whole", how.dims), _table(part, "lead", c_lead.shape[1])
            yield part, whole, *nearest(whole, lead, part.column("rest").to_numpy(), centroids, c_lead, c_rest)


def _moved(rotated: DataFrame, centroids: np.ndarray, axes: Axes, how: Clustering) -> np.ndarray:
    """Centroids after one round: exact sums per cluster and component, rounded down; empty clusters stay."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, np.int64), np.zeros((k, how.dims), np.int64)
        for _, whole, cluster, _, _ in _assigned(batches, centroids, axes, how):
            count += np.bincount(cluster, minlength=k)
            np.add.at(total, cluster, whole)
        some = np.flatnonzero(count)
        columns = [pa.array(some), pa.array(count[some]), *(pa.array(total[some, i]) for i in range(how.dims))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", *(f"s{i}" for i in range(how.dims))])

    sums = [f"s{i}" for i in range(how.dims)]
    schema = "cluster long, n long, " + ", ".join(f"{s} long" for s in sums)
    added = rotated.mapInArrow(run, schema).groupBy("cluster").agg(*(F.sum(c).alias(c) for c in ("n", *sums)))
    moved = centroids.copy()
    for row in added.collect():
        moved[row.cluster] = [row[s] // row.n for s in sums]
    return moved


def first_centroids(rotated: DataFrame, how: Clustering) -> np.ndarray:
    """The kept vectors with the smallest hashes of seed and id; equal ids go by their components."""
    seeded = F.sha2(F.concat(F.lit(f"{how.seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = rotated.select("whole").orderBy(seeded, "whole").limit(how.clusters).collect()
    return np.array([r.whole for r in rows], np.int64).reshape(-1, how.dims)


def cluster(vectors: DataFrame, how: Clustering = Clustering(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Cluster, squared distance and sums of squared distances of every kept vector.

    Returns vec_id, cluster, distance, cluster_inertia, inertia and
    centroid_sha256 (of the cluster's last centroid, components joined by
    commas), one row per kept vector. Vectors of another length, null ones and
    those with a null, NaN or infinite component are left out; a null id counts
    as empty text where ids are hashed. Rows that repeat are vectors of their
    own; with fewer vectors than clusters there are as many clusters as vectors,
    and without any no rows. Other columns are left out. A component that has no
    exact distance in a long is an error.

    Axes come from the moments of all kept vectors. Rotated coordinates and
    residual norms are written once and read by every round; a round brings back
    one row per cluster. The axes only decide which distances are worked out:
    results are integers and the same with any axes.
    """
    spark = vectors.sparkSession
    plain = vectors.select(F.col(id_col).cast(LongType()), F.col(vector_col).cast("array<double>"))
    axes = principal_axes(*moments(plain, how), how.held)
    rotated = scratch.stage(_rotated(plain, axes, how), "rotated")
    centroids = first_centroids(rotated, how)
    if not len(centroids):
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    for _ in range(how.rounds):
        centroids = _moved(rotated, centroids, axes, how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, cluster, distance, _ in _assigned(batches, centroids, axes, how):
            columns = [part.column("id"), pa.array(cluster, pa.int32()), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    assigned = scratch.stage(rotated.mapInArrow(run, "vec_id long, cluster int, distance long"), "assigned")
    within = {r.cluster: r.inertia for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(c, within[c], sum(within.values()), digests[c]) for c in within]
    totals = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(totals), "cluster").select("vec_id", *(c for c in assigned.columns[1:]), *totals.columns[1:])


def share_measured(vectors: DataFrame, how: Clustering = Clustering()) -> float:
    """Share of all distances to the last centroids that the bound does not spare."""
    plain = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    axes = principal_axes(*moments(plain, how), how.held)
    rotated = scratch.stage(_rotated(plain, axes, how), "rotated")
    centroids = first_centroids(rotated, how)
    for _ in range(how.rounds):
        centroids = _moved(rotated, centroids, axes, how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, _, _, measured in _assigned(batches, centroids, axes, how):
            yield pa.RecordBatch.from_arrays([pa.array([measured]), pa.array([part.num_rows * len(centroids)])], ["some", "every"])

    return rotated.mapInArrow(run, "some long, every long").agg(F.sum("some") / F.sum("every")).first()[0]
