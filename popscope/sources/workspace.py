"""Folders that every executor can reach."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the cluster's ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/popscope/{name}-{uuid4().hex}"
