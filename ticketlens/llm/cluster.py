"""What the operators need from the cluster: their code on the executors, and shared folders."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

import ticketlens

_SHIPPED: set[str] = set()


def unused_prefix(df: DataFrame) -> str:
    """A prefix that no column of ``df`` starts with, for columns an operator needs on the way."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def ship_code(spark: SparkSession) -> None:
    """Let the executors' Python workers import this package: Spark distributes a zip of it once
    per application, so nothing has to be installed on the nodes."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(ticketlens.__file__))
    target = os.path.join(tempfile.mkdtemp(), "ticketlens.zip")  # driver only; Spark ships it
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)
