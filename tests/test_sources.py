import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tillwise.config import Settings
from tillwise.sources import retail, scratch, tables
from tillwise.sources.marketdata import Market

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_jdbc_options():
    cut = tables.JdbcPartitions("transacted_at", "2024-01-01", "2024-04-01", 16)
    assert tables.jdbc_options("public.items") == {"dbtable": "public.items"}
    assert tables.jdbc_options("public.items", cut) == {
        "dbtable": "public.items", "partitionColumn": "transacted_at", "lowerBound": "2024-01-01", "upperBound": "2024-04-01", "numPartitions": "16",
    }


def test_settings_from_the_environment():
    plain, own = Settings.from_env({}), Settings.from_env({"DATA_DIR": "/d", "TABLE_THREAD_DEAL": "deals_2024", "DB_SCHEMA_PUBLIC": "shop"})
    assert plain == Settings(store_ref="data/Ref_StoreNameCode.csv")
    assert (own.store_ref, own.tables["deals"], own.schema) == ("/d/Ref_StoreNameCode.csv", "deals_2024", "shop")


def test_sources_have_the_declared_columns(spark, tmp_path):
    market = Market(spark, "/root/testdata/sf0.001")
    settings = Settings(data_dir=str(tmp_path), store_ref=str(tmp_path / "stores.csv"))
    names = {"transactions": "transaction_items", "deals": "thread_deal", "products": "thread_product"}
    for name in retail.SCHEMAS:
        table = market[names.get(name, name)]
        if name == "store_ref":
            tables.write_table(table, settings.store_ref, "csv")
        else:
            table.withColumn("more", F.lit(1)).write.parquet(f"{tmp_path}/{settings.tables[name]}.parquet")
        read = retail.read_source(spark, name, settings)
        assert read.count() == table.count()
        assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in read.schema) == retail.SCHEMAS[name]


def test_wrong_sources_are_refused(spark):
    shops = spark.createDataFrame([(1, "a")], "id int, name string")
    with pytest.raises(ValueError, match=r"shops needs id string \(is int\), title string \(is missing\)"):
        retail.conform(shops, "shops")


def test_staged_tables_of_a_run_go(spark):
    with scratch.one_run(spark):
        table = scratch.stage(spark.range(5), "five")
        folder = table.inputFiles()[0]
        assert table.count() == 5 and "/run-" in folder
    assert not os.path.exists(os.path.dirname(folder.removeprefix("file://")))
    assert "/run-" not in scratch.new_path(spark, "later")


def test_tasks_find_the_package_from_anywhere(tmp_path):
    """A session started in another folder, without the package on the workers' path."""
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__ as entry
print("ROWS", entry.queries()["select_pairs"](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 1" in done.stdout, done.stderr[-2000:]


@pytest.mark.parametrize("kind", ["long", "timestamp", "date", "double"])
def test_slices_are_disjoint_whole_and_even(spark, kind):
    """Nine of ten keys lie in a thousandth of the range, a tenth of the rows has one key, some have none."""
    key = F.when(F.col("id") % 10 == 0, F.lit(5_000_000)).otherwise(F.when(F.col("id") % 10 == 1, F.col("id") * 10_000).otherwise(F.col("id")))
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 97 != 0, key).alias("key"))
    if kind in ("timestamp", "date"):
        stamp = F.timestamp_seconds(F.col("key") * 600)
        rows = rows.withColumn("key", stamp if kind == "timestamp" else stamp.cast("date"))
    else:
        rows = rows.withColumn("key", F.col("key").cast(kind))
    cuts = tables.even_cuts(rows.select("key"), "key", 16)
    parts = tables.slice_predicates("key", cuts, quote=kind in ("timestamp", "date"))
    held = rows.select(*(F.coalesce(F.expr(p), F.lit(False)).cast("int").alias(f"p{i}") for i, p in enumerate(parts)))
    in_parts = held.select(sum(F.col(c) for c in held.columns).alias("n")).groupBy("n").count().collect()
    assert [(r.n, r["count"]) for r in in_parts] == [(1, 20_000)]
    sizes = held.agg(*(F.sum(c) for c in held.columns)).first()
    assert len(parts) >= 12 and max(sizes) < 20_000 / 16 * 3.2
    assert tables.slice_predicates("key", []) == ["1 = 1"] and tables.even_cuts(rows.filter("false"), "key", 4) == []


def test_discarded_tables_are_gone(spark):
    kept, spent = (scratch.stage(spark.range(3), "numbers") for _ in range(2))
    path = spent._staged_at.removeprefix("file:")
    assert os.path.isdir(path)
    scratch.discard(spent)
    scratch.discard(spark.range(1))
    assert not os.path.exists(path) and kept.count() == 3


def test_sold_pairs_give_the_views_rows(spark, tmp_path):
    """Spark's own texts of two views give the rows of the checked ones, for repeated and missing keys too."""
    from collections import Counter

    from tillwise.sources.marketdata import SPARK, view_sql

    lines = [(o, n, p, s) for o, p, s in [(1, 2, 3), (1, 2, 3), (2, 3, 3), (3, 2, None), (4, None, 3), (5, None, None), (5, None, 4), (None, 3, 4), (6, -1, 2), (6, 1, 1)] for n in (1, 1, 2, None)]
    frames = {
        "lineitem": spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint"),
        "part": spark.createDataFrame([(p, "SMALL", f"Brand#{p}", p) for p in (1, 2, 2, 3)] + [(None, "SMALL", None, None)], "p_partkey bigint, p_type string, p_brand string, p_size int"),
    }
    for name, rows in frames.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    market = Market(spark, str(tmp_path))
    for name in ("relationships", "thread_product"):
        wanted = spark.sql(view_sql(SPARK)[name], **{t: f for t, f in frames.items() if f"{{{t}}}" in view_sql(SPARK)[name]})
        assert Counter(map(tuple, market[name].collect())) == Counter(map(tuple, wanted.collect()))
    edges = market["relationships"].filter("parent_type = 'shop' and child_id is not null")
    assert "Aggregate" not in edges._jdf.queryExecution().optimizedPlan().toString()
