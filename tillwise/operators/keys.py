"""Column names the operators share, and joins on nullable keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HIERARCHY = ["store", "department", "space", "category", "product"]
ITEM = ["store", "calculation_group", "product"]
STORE_PRODUCT = ["store", "product"]


def present(keys: Sequence[str]) -> Column:
    """True where every key has a value (groups with a NULL key do not count)."""
    test = F.lit(True)
    for key in keys:
        test = test & F.col(key).isNotNull()
    return test


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Equi-join in which NULL matches NULL; ``right`` keeps its other columns only."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"__right_{k}" for k in keys])


def place(df: DataFrame, keys: Sequence[str], times: int = 1) -> DataFrame:
    """Bring equal keys together, in a fixed number of partitions.

    For tables whose rows multiply right afterwards: without a number Spark
    merges partitions by the size they have before that. ``times`` as many
    partitions keep tasks small where several large tables are sorted in one.
    """
    return df.repartition(times * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
