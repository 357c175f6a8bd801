"""Send this package to the Python workers of the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to the application once, so that functions run in tasks can be imported there."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "pedalflow_package.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    packed.write(full, os.path.relpath(full, root))
    context.addPyFile(path)  # Spark's own file server hands it to every executor
    _sent.add(context.applicationId)
