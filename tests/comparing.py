"""Run a query on Spark and its SQL on DuckDB and compare all values."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "labels")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if hasattr(value, "item"):
        return _plain(value.item())
    if hasattr(value, "date") and not isinstance(value, str):
        return value.date().isoformat()
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(_plain(v) for v in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> list[str]:
    """What differs, in words; empty when the results are the same."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return [f"columns {sorted(spark_frame.columns)} against {sorted(sql_frame.columns)}"]
    if len(spark_frame) != len(sql_frame):
        return [f"{len(spark_frame)} rows against {len(sql_frame)}"]
    left, right = _rows(spark_frame), _rows(sql_frame)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    out = [f"{len(wrong)} of {len(left)} rows differ: {wrong[0][0]} against {wrong[0][1]}"] if wrong else []
    for column in spark_frame.columns:
        a, b = spark_frame[column].dropna(), sql_frame[column].dropna()
        if len(a) and len(b) and type(_plain(a.iloc[0])) is not type(_plain(b.iloc[0])):
            out.append(f"type of {column}: {type(_plain(a.iloc[0]))} against {type(_plain(b.iloc[0]))}")
    return out
