"""Sending this package to the executors."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in the Python workers, once per application.

    Not needed where it is installed on the cluster or passed with ``--py-files``.
    """
    context = spark.sparkContext
    if getattr(context, "_popscope_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="popscope-")) / "popscope"
    context.addPyFile(shutil.make_archive(str(archive), "zip", root.parent, root.name))
    context._popscope_shipped = True
