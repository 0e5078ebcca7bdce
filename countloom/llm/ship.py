"""Makes this package importable in Python workers, wherever they run."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package to Spark's own file distribution, once per application.

    Worker functions live in modules, so what a worker caches lasts from task to
    task.  The archive is small, and Spark copies it to every executor.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    top, package = os.path.dirname(os.path.dirname(here)), os.path.basename(os.path.dirname(here))
    archive = os.path.join(tempfile.mkdtemp(prefix="spark-"), f"{package}_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(os.path.join(top, package)):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, top))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
