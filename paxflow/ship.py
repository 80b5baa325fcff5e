"""Sends the package to the executors, which need it for Arrow functions."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the session as one zip; once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    target = os.path.join(tempfile.mkdtemp(prefix="paxflow-zip-"), "paxflow-sources.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
    context.addPyFile(target)
    _shipped.add(context.applicationId)
