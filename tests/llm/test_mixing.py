import heapq
import random

import comparing
import duckdb
import pytest
from pyspark.sql import functions as F

from tillwise.llm import mixing, sql

SF_DIR = "/root/testdata/sf0.001"
SMALL = mixing.Mix(block_words=3, least_blocks=1, shard_words=20)


def highest_quotients(weights, seats):
    """Seat by seat to the highest weight / (2 won + 1), the first of equal ones."""
    won = [0] * len(weights)
    heap = [(-w, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    for _ in range(seats):
        _, i = heapq.heappop(heap)
        won[i] += 1
        heapq.heappush(heap, (-weights[i] / (2 * won[i] + 1), i))
    return won


@pytest.mark.parametrize("seed", range(4))
def test_apportion_gives_seats_to_highest_quotients(spark, seed):
    rng = random.Random(seed)
    groups = {g: ([float(rng.choice([0, 1, 1, 3, 50, rng.randint(1, 400)])) for _ in range(rng.randint(1, 30))], rng.randint(0, 300)) for g in range(8)}
    groups = {g: (w, s if sum(w) else 0) for g, (w, s) in groups.items()}
    rows = [(g, i, w, s) for g, (ws, s) in groups.items() for i, w in enumerate(ws)]
    parts = spark.createDataFrame(rows, "g int, i int, w double, s long")
    got = {(r.g, r.i): r.won for r in mixing.apportion(parts, ["g"], ["i"], "w", "s", "won").collect()}
    for g, (ws, s) in groups.items():
        assert [got[g, i] for i in range(len(ws))] == highest_quotients(ws, s)


def test_targets_stop_at_three_times_the_size(spark):
    rows = [("b", 10), ("a", 1000), (None, 50), ("c", 0), ("B", 500)]
    sizes = spark.createDataFrame(rows, "source string, source_size long")
    got = {r.source: (r.weight, r.target) for r in mixing.source_targets(sizes).collect()}
    assert {s: w for s, (w, _) in got.items()} == {"B": 5, "a": 2, "b": 1, "c": 5, None: 2}
    assert got["b"][1] == 30 and got["c"][1] == 0 and got[None][1] == 150
    assert sum(t for _, t in got.values()) == pytest.approx(1560)
    assert got["B"][1] / 5 == pytest.approx(got["a"][1] / 2)


@pytest.mark.parametrize("mix", [SMALL, mixing.Mix()])
def test_takes_near_the_targets(make, mix):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 40), None, f"s{min(rng.randint(0, 5), rng.randint(0, 5))}") for i in range(200)]
    got = mixing.plan(make(rows), mix).join(make(rows).select("doc_id", "source"), "doc_id").toPandas()
    assert (got.taken <= 3 * got["size"]).all() and len(got) == 200
    by = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((by.taken - by.target).abs() <= 2 * mix.block_words).all()


def test_same_as_sql_and_again(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    mine = mixing.plan(docs).select("doc_id", "size", "source_size", "target", "taken").toPandas()
    again = mixing.plan(docs.repartition(7)).select("doc_id", "taken").toPandas()
    assert comparing.differences(mine, connection.execute(sql.MIXING).df()) == []
    assert dict(zip(mine.doc_id, mine.taken)) == dict(zip(again.doc_id, again.taken))


def test_texts_hold_the_words_taken(make):
    rows = [(i, f" w{i} x\ty{i}\nz  q{i} " * (i % 7), None, "ab"[i % 2]) for i in range(60)]
    docs = make(rows + rows[:5], extra=True)
    taken = mixing.plan(docs, SMALL).groupBy("doc_id").agg(F.sum("taken").alias("n")).filter("n > 0")
    out = mixing.take(docs, SMALL)
    assert out.columns == docs.columns
    words = out.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text"))).alias("n"))
    assert sorted(words.collect()) == sorted(taken.collect())
    texts = dict(r[:2] for r in rows)
    assert all(set(r.text.split()) <= set(texts[r.doc_id].split()) for r in out.collect())


def test_messy_rows(messy, none):
    got = mixing.plan(messy, SMALL).collect()
    assert len(got) == 12 and all(r.taken <= 3 * r.size for r in got)
    assert {r.doc_id: r.size for r in got}[1] == 0 and {r.doc_id: r.size for r in got}[7] == 60_000
    assert mixing.take(messy, SMALL).columns == messy.columns and mixing.take(messy, SMALL).count() > 0
    assert mixing.plan(none).count() == 0 and mixing.take(none).count() == 0
