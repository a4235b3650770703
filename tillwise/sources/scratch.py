"""Where intermediate tables live, and how a step is cut off from its lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


_run: ContextVar[str | None] = ContextVar("run", default=None)


def _named(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``."""
    named = _named(spark)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return named.rstrip("/")


def set_local_dir(spark: SparkSession) -> None:
    """Give a single-process session without the setting a folder of its own.

    For tests, timings and trials: there the driver is the only executor. A
    cluster has to name its folder.
    """
    if not _named(spark) and spark.sparkContext.master.startswith("local["):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillwise-"))


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{_run.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def one_run(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside go to a folder of their own, which is removed at the end.

    What has to outlive the run must be written elsewhere before it ends.
    """
    folder = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    before = _run.set(folder)
    try:
        yield
    finally:
        _run.reset(before)
        _remove(spark, folder)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a step's output as a table and read it back.

    The pipeline hands tables from step to step, and several consumers read
    each of them: a written table is computed once, outlives lost executors and
    gives the planner its true size.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._staged_at = path
    return table


def discard(table: DataFrame) -> None:
    """Remove a table that ``stage`` gave, once nothing that is still to run reads it."""
    path = getattr(table, "_staged_at", None)
    if path is not None:
        _remove(table.sparkSession, path)
