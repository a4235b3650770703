"""The package on the executors: tasks find the functions they run by name."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the session's executors this package, once per application.

    Not needed where it is installed on the machines, or handed over with
    ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="tillwise-"), "tillwise.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as packed:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
