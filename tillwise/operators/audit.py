"""Checks the pipeline makes on its tables."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.sources import scratch


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def group_check(sales: DataFrame) -> DataFrame:
    """Which titles ended up in which calculation group."""
    return sales.select("department", "space", "category", "calculation_group").distinct()


def duplicate_rows(df: DataFrame, copies_per_piece: int = 100_000) -> DataFrame:
    """Every row that has an exact copy, with all its copies.

    Rows are counted with partial counts, so many copies of one row never meet
    in one task; they are written out again from the count, in pieces that
    spread over tasks.
    """
    piece = F.lit(copies_per_piece)
    pieces = F.ceil(F.col("__n") / piece)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1)
    cut = counted.select(
        *df.columns, "__n", F.explode(F.sequence(F.lit(1).cast("bigint"), pieces)).alias("__piece")
    ).repartition(tasks, *df.columns, "__piece")
    size = F.least(piece, F.col("__n") - (F.col("__piece") - 1) * piece).cast("int")
    return cut.withColumn("__copy", F.explode(F.sequence(F.lit(1), size))).select(*df.columns)


def null_audit(df: DataFrame) -> DataFrame:
    """NULLs per column, in one pass."""
    counts = df.agg(
        *[F.sum(F.col(f"`{c}`").isNull().cast("bigint")).alias(c) for c in df.columns]
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_rows")) for c in df.columns]
    )
    return counts.select(F.inline(pairs)).select(
        "column_name",
        F.coalesce("null_rows", F.lit(0)).alias("null_rows"),
        (F.coalesce("null_rows", F.lit(0)) > 0).alias("has_null"),
    )


def coverage_stats(sales: DataFrame) -> DataFrame:
    """Date range and the numbers of stores, groups and products.

    The table is first reduced to one row per store, group and product, so the
    distinct counts never expand the raw rows.
    """
    items = sales.groupBy("store", "calculation_group", "product").agg(
        F.min("date").alias("lo"), F.max("date").alias("hi"), F.count(F.lit(1)).alias("n")
    )
    return items.agg(
        F.min("lo").alias("min_date"),
        F.max("hi").alias("max_date"),
        F.count_distinct("store").alias("stores"),
        F.count_distinct("calculation_group").alias("groups"),
        F.count_distinct("product").alias("products"),
        F.sum("n").alias("rows"),
    )


#: Ranges a column is cut into when a rank is looked for.
RANGES = 4096


def exact_ranks(table: DataFrame, ranks: Mapping[str, Sequence[int]]) -> dict[tuple[str, int], float]:
    """The value at 0-based ranks of each column, NULLs left out.

    Selection by narrowing: the values between two limits are counted in even
    ranges, with the least and greatest value of each, and the range that holds
    the rank gives the next limits, until they are equal. A pass handles all
    ranks of all columns and brings back at most ``RANGES`` rows per rank, so no
    task holds the values of a column, however many differ.
    """
    found: dict[tuple[str, int], float] = {}
    limits = {c: [(None, None, 0, list(r))] for c, r in ranks.items() if r}
    while limits:
        cells = []
        for c, spans in limits.items():
            x = F.col(c).cast("double")
            for k, (low, high, _, _) in enumerate(spans):
                if low is None:
                    inside, at = x.isNotNull(), F.lit(0)
                else:
                    share = (x / 2 - low / 2) / (high / 2 - low / 2)
                    inside, at = x.between(low, high), F.least(F.floor(share * RANGES), F.lit(RANGES - 1)).cast("int")
                cells.append(F.when(inside, F.struct(F.lit(c).alias("c"), F.lit(k).alias("k"), at.alias("at"), x.alias("x"))))
        counted = table.select(F.explode(F.array_compact(F.array(*cells))).alias("cell")).groupBy("cell.c", "cell.k", "cell.at").agg(
            F.count(F.lit(1)).alias("n"), F.min("cell.x").alias("low"), F.max("cell.x").alias("high")
        )
        ranges: dict[tuple[str, int], list] = {}
        for r in counted.collect():
            ranges.setdefault((r.c, r.k), []).append((r.at, r.n, r.low, r.high))
        following: dict[str, list] = {}
        for c, spans in limits.items():
            for k, (_, _, before, wanted) in enumerate(spans):
                for _, n, low, high in sorted(ranges.get((c, k), [])):
                    here = [r for r in wanted if before <= r < before + n]
                    if here and low == high:
                        found |= {(c, r): low for r in here}
                    elif here:
                        following.setdefault(c, []).append((low, high, before, here))
                    before += n
        limits = following
    return found


def quantile_bounds(df: DataFrame, columns: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """Quartiles, 99th percentile and the three-IQR bounds of each column.

    Exact, by selection of the ranks next to each quantile (see exact_ranks) and
    linear interpolation between them; the columns are staged, as each pass reads
    them. ``accuracy`` uses the mergeable approximate percentile instead. A column
    without values has no row.
    """
    spark, points = df.sparkSession, [0.25, 0.75, 0.99]
    if accuracy is None:
        table = scratch.stage(df.select(*columns), "columns")
        odd = [F.count_if(F.isnan(F.col(c).cast("double")) | (F.abs(F.col(c).cast("double")) == float("inf"))) for c in columns]
        counts = table.agg(*(F.count(c).alias(c) for c in columns), sum(odd[1:], odd[0]).alias("__odd")).first().asDict()
        if counts.pop("__odd"):
            raise ValueError("quantiles need finite values")
        places = {c: [p * (n - 1) for p in points] for c, n in counts.items() if n}
        ranks = {c: sorted({r for at in p for r in (math.floor(at), math.ceil(at))}) for c, p in places.items()}
        value = exact_ranks(table, ranks)
        rows = []
        for c, p in places.items():
            ends = [(value[c, math.floor(at)], value[c, math.ceil(at)], at - math.floor(at)) for at in p]
            rows.append((c, [low + (high - low) * share if high != low else low for low, high, share in ends]))
        q = spark.createDataFrame(rows, "column_name string, q array<double>")
    else:
        long = df.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in columns]))
        ).filter(F.col("x").isNotNull())
        q = long.groupBy("column_name").agg(F.percentile_approx("x", points, accuracy).alias("q"))
    q1, q3, q99 = (F.col("q")[i] for i in range(3))
    return q.select(
        "column_name",
        q1.alias("q1"),
        q3.alias("q3"),
        q99.alias("q99"),
        (q3 - q1).alias("iqr"),
        (q1 - 3 * (q3 - q1)).alias("lower_bound"),
        (q3 + 3 * (q3 - q1)).alias("upper_bound"),
    )


def top_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in a full ordering: a sample to look at."""
    return df.orderBy(*order).limit(n)
