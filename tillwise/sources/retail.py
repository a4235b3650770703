"""A retailer's source tables: where they are, and what they must look like."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillwise.config import Settings
from tillwise.sources.tables import JdbcPartitions, read_table

#: Columns and types that the steps read; a source may have more columns.
SCHEMAS = {
    "transactions": "shop_title string, department_title string, space_title string, category_title string, product_id string, "
    "product_title string, transacted_at timestamp_ntz, price_sell decimal(12,2), price_margin decimal(12,2), quantity double",
    "deals": "id string, price decimal(12,2), title string, minimum_qty double, event_start timestamp_ntz, event_end timestamp_ntz",
    "relationships": "parent_type string, parent_id string, child_type string, child_id string",
    "shops": "id string, title string",
    "products": "id string, shop_id string, title string, unit_price_cost decimal(12,4), price_cost decimal(12,4), "
    "removed boolean, is_stocked boolean",
    "shop_group": "group_id string, shop_id string",
    "store_ref": "store_name string, store_codes string",
}


def _kind(declared: T.DataType) -> type:
    """Types that a declared one may be read from: any number for a number, any time for a time."""
    for kind in (T.NumericType, (T.TimestampType, T.TimestampNTZType)):
        if isinstance(declared, kind):
            return kind
    return type(declared)


def conform(df: DataFrame, name: str) -> DataFrame:
    """The declared columns of a source, as the declared types; raises if one is missing or of another kind."""
    wanted = T.StructType.fromDDL(SCHEMAS[name])
    there = {field.name: field.dataType for field in df.schema}
    wrong = [
        f"{f.name} {f.dataType.simpleString()} (is {there[f.name].simpleString() if f.name in there else 'missing'})"
        for f in wanted
        if f.name not in there or not isinstance(there[f.name], _kind(f.dataType))
    ]
    if wrong:
        raise ValueError(f"{name} needs " + ", ".join(wrong))
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in wanted])


def read_source(
    spark: SparkSession,
    name: str,
    settings: Settings,
    database: Mapping[str, str] | None = None,
    partitions: JdbcPartitions | None = None,
) -> DataFrame:
    """One source table: from the database whose JDBC options are given, else from the data folder."""
    table = settings.tables[name]
    if database is not None:
        df = read_table(spark, f"{settings.schema}.{table}", "jdbc", partitions=partitions, options=database)
    elif name == "store_ref":
        df = read_table(spark, settings.store_ref, "csv", SCHEMAS[name])
    else:
        df = read_table(spark, f"{settings.data_dir}/{table}.parquet")
    return conform(df, name)
