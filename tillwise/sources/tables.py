"""Table readers and writers: parquet, csv, jdbc, and folders of sheets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.text import sanitize_key


@dataclass(frozen=True)
class JdbcPartitions:
    """How a database extract is cut into parallel reads.

    One job reads all pieces at once and each piece is a range of ``column``,
    so no page re-runs the query and no row can move between pages.
    """

    column: str
    lower: str
    upper: str
    count: int


def jdbc_options(table: str, partitions: JdbcPartitions | None = None) -> dict[str, str]:
    """Reader options of one database table, cut into ranges if asked for."""
    options = {"dbtable": table}
    if partitions is not None:
        options |= {
            "partitionColumn": partitions.column,
            "lowerBound": partitions.lower,
            "upperBound": partitions.upper,
            "numPartitions": str(partitions.count),
        }
    return options


def even_cuts(keys: DataFrame, column: str, count: int) -> list:
    """Values that cut a column into ``count`` parts of about as many rows each, fewer where one value has more.

    ``keys`` needs that column only, so a database sends nothing else for it.
    Every part ends behind a value that is there: a mergeable percentile of the
    column, which many equal keys cannot skew.
    """
    kind = keys.schema[column].dataType
    whole = isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType))
    number = F.unix_micros(F.col(column).cast("timestamp")) if whole else F.col(column)
    shares = [i / count for i in range(1, count)]
    found = keys.select(number.alias("x")).agg(F.percentile_approx("x", shares, 100 * count).alias("cuts"))
    cuts = F.array_sort(F.array_distinct("cuts"))
    if whole:
        cuts = F.transform(cuts, lambda x: F.timestamp_micros(x).cast(kind))
    row = found.select(F.transform(cuts, lambda x: x.cast("string")).alias("cuts")).first() if shares else None
    return list(row["cuts"] or []) if row else []


def slice_predicates(column: str, cuts: Sequence, quote: bool = True) -> list[str]:
    """SQL conditions of disjoint parts that between them hold every row; the first part has the NULLs."""

    def literal(cut) -> str:
        return "'" + str(cut).replace("'", "''") + "'" if quote else str(cut)

    if not cuts:
        return ["1 = 1"]
    ends = [literal(c) for c in cuts]
    inner = [f"{column} > {low} AND {column} <= {high}" for low, high in zip(ends, ends[1:])]
    return [f"{column} <= {ends[0]} OR {column} IS NULL", *inner, f"{column} > {ends[-1]}"]


def read_table(
    spark: SparkSession,
    location: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    partitions: JdbcPartitions | None = None,
    options: Mapping[str, str] | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Read one table. ``location`` is a path, or a table name for ``jdbc``.

    A database table is read in equal steps of a column (``partitions``) or, if
    its values are unevenly spread, in the parts that ``predicates`` name.
    """
    if fmt == "jdbc" and predicates is not None:
        properties = {k: v for k, v in (options or {}).items() if k != "url"}
        return spark.read.jdbc(options["url"], location, predicates=list(predicates), properties=properties)
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(**(options or {}), **jdbc_options(location, partitions)).load()
    reader = spark.read.options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        if schema is None:
            raise ValueError("csv needs a schema: inferring one reads the data twice")
        return reader.option("header", True).csv(location)
    return reader.format(fmt).load(location)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss")
    writer.format(fmt).save(path)


def write_workbook(sheets: Mapping[str, DataFrame], path: str, fmt: str = "csv") -> None:
    """A report of several sheets: one table per sheet below ``path``."""
    for name, sheet in sheets.items():
        write_table(sheet, f"{path}/{name}", fmt)


def read_sheet(spark: SparkSession, path: str, sheet: str, schema, fmt: str = "csv") -> DataFrame:
    return read_table(spark, f"{path}/{sheet}", fmt, schema)


RESULT_KEYS = ["store_codes", "calculation_group", "product_key"]


def write_partitioned_result(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """One folder per store code, calculation group and file-safe product name.

    Rows are brought together by those keys first, so a folder gets few files;
    the rebalance lets Spark split a key that is too large for one task.
    """
    keyed = df.withColumn("product_key", sanitize_key(F.col("product")))
    keyed = keyed.hint("rebalance", *RESULT_KEYS)
    writer = keyed.write.partitionBy(*RESULT_KEYS)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def read_partitioned_result(spark: SparkSession, path: str, schema, fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, fmt, schema)
