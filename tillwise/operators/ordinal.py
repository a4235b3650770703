"""Row numbers over a whole table without sorting it in one task.

Rows are sorted in ranges of their key; a row's number is its place in its range
after the rows of the ranges before. The numbers depend on the data only: a task
that is run again gives the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.sources.scratch import stage


def number_rows(df: DataFrame, levels: Sequence[Sequence[str]], name: str = "row_id") -> DataFrame:
    """Add a 1-based row number in ascending order of all ``levels``, NULLs last.

    Rows are dealt into ranges of the whole key and sorted there, so equal keys
    share a partition however many there are. A row's number is its place in its
    partition plus the sizes of the partitions before; only these sizes, one per
    partition, are gathered. The rows are staged, as ranges are found by looking
    at them first, and once more with their places.
    """
    spark = df.sparkSession
    order = [F.col(c).asc_nulls_last() for level in levels for c in level]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(df, "rows").repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    # partition in the upper 31 bits, place in the partition in the lower 33
    placed = stage(ranged.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__at", 33).cast("int")
    sizes = dict(placed.groupBy(part.alias("part")).count().collect())
    ahead = [0, *accumulate(sizes.get(p, 0) for p in range(max(sizes, default=0)))]
    before = F.get(F.lit(ahead), part)
    return placed.withColumn(name, before + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("__at")


def assign_pages(df: DataFrame, levels: Sequence[Sequence[str]], page_size: int) -> DataFrame:
    """Number rows over their full key and cut them into pages, 0-based."""
    return number_rows(df, levels, "row_number").withColumn(
        "page_number", F.floor((F.col("row_number") - 1) / F.lit(page_size)).cast("bigint")
    )


def fetch_page(paged: DataFrame, page: int) -> DataFrame:
    """The rows of one page, as LIMIT with OFFSET would return them."""
    return paged.filter(F.col("page_number") == page)
