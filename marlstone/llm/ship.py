"""Make this package importable in the Python workers of executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's modules to the executors, once per application.

    Workers need them where the package is not installed on every node; Spark's own file server
    carries the archive.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parent.parent
    archive = os.path.join(tempfile.mkdtemp(prefix="marlstone-"), "marlstone.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(top.rglob("*.py")):
            out.write(module, module.relative_to(top.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
