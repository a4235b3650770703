import hashlib
import math
import random

import comparing
import duckdb
import numpy as np
import pytest

from tillwise.llm import centroids, registry, sql
from tillwise.llm.centroids import Clustering

SF_DIR = "/root/testdata/sf0.001"
SMALL = Clustering(dims=3, scale=8, clusters=4, rounds=2)
SCHEMA = "vec_id long, embedding array<float>, distance string, id string, whole string"


def brute(rows, how):
    """Every vector against every centroid in plain Python integers."""
    kept = [
        (i, [math.floor(how.scale * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == how.dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{how.seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in first[: how.clusters]]

    def best(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(how.rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(best(v)[1], []).append(v)
        for k, members in groups.items():
            centres[k] = [sum(xs) // len(members) for xs in zip(*members)]
    rows = [(i, *best(v)) for i, v in kept]
    return sorted(
        (
            str(i), k, d, sum(x[1] for x in rows if x[2] == k), sum(x[1] for x in rows),
            hashlib.sha256(",".join(map(str, centres[k])).encode()).hexdigest(),
        )
        for i, d, k in rows
    )


def run(spark, rows, how):
    table = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)
    got = centroids.cluster(table, how).collect()
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got)


@pytest.mark.parametrize("held", [0.0, 0.7, 1.0])
def test_same_as_measuring_all(spark, held):
    rng = random.Random(3)
    rows = [(i, [float(np.float32(rng.gauss(4 * (i % 5), 1))) for _ in range(3)]) for i in range(300)]
    how = Clustering(dims=3, scale=8, clusters=7, rounds=3, held=held)
    assert run(spark, rows, how) == brute(rows, how)


def test_ties_repeats_and_what_is_left_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 3), 1.0, -1.0]) for i in range(12)] + [(None, [5.0, 5.0, 5.0]), (None, [0.0, 0.0, 0.0])] + [(3, [0.0, 1.0, -1.0])] * 3
    left_out = [(90, None), (91, []), (92, [1.0, 2.0]), (93, [1.0, None, 2.0]), (94, [nan, 1.0, 1.0]), (95, [1.0, -inf, 1.0]), (96, [0.0] * 4)]
    for kept in (rows, rows[:2], []):
        assert run(spark, kept + left_out, SMALL) == brute(kept, SMALL)
    assert run(spark, [], SMALL) == []


def test_too_large_for_a_long(spark):
    with pytest.raises(Exception, match="fit a long"):
        run(spark, [(1, [1e30, 0.0, 0.0])], SMALL)


def test_bound_is_never_above_the_distance():
    rng = np.random.default_rng(5)
    whole = rng.integers(-500, 500, (400, 64)) * rng.integers(0, 2, 64)
    n, total, products = len(whole), whole.sum(0).astype(float), (whole.T @ whole).astype(float)
    axes = centroids.principal_axes(n, total, products, 0.5)
    assert np.allclose(axes.turn.T @ axes.turn, np.eye(64)) and 0 < axes.leading < 32
    centres = whole[:16]
    cluster, distance, measured = centroids.nearest(
        whole, *centroids.rotate(whole, axes), centres, *centroids.rotate(centres, axes)
    )
    every = ((whole[:, None] - centres) ** 2).sum(2)
    assert (cluster == every.argmin(1)).all() and (distance == every.min(1)).all() and measured <= every.size


def test_filter_spares_distances_of_vectors_in_few_directions(spark):
    rng = np.random.default_rng(1)
    flat = rng.normal(0, 1, (600, 3)) @ rng.normal(0, 1, (3, 64))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(flat)], "vec_id long, embedding array<float>")
    assert centroids.share_measured(table) < 0.3


def test_same_as_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_DIR}/embeddings.parquet'")
    mine = registry.op13_centroids(spark, SF_DIR).toPandas()
    assert comparing.differences(mine, duck.execute(sql.CENTROIDS).df()) == []
