"""Sends the package to the executors, so that Python tasks can import it wherever they run."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import tallyloom


def ship(spark: SparkSession) -> None:
    """Adds the package to the session's Python files once; the driver serves the archive to executors."""
    context = spark.sparkContext
    if getattr(context, "_tallyloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(tallyloom.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tallyloom-"), "tallyloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._tallyloom_shipped = True
