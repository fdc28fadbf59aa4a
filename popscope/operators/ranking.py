"""The first n rows of every group, also when one group is most of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def first_per_group(
    rows: DataFrame, group: Sequence[str], order: Sequence[Column | str], n: int, rank: str
) -> DataFrame:
    """Add ``rank`` (1, 2, ...) inside each group and keep ranks up to ``n``.

    Each task keeps n rows per group before anything is shuffled. With very many
    tasks that still sends n rows per task to the one reducer of a large group, so
    a first round ranks within (group, salt) and the second sees n rows per salt.
    The salt comes from the task, which keeps the first round's pre-selection
    whole, and any assignment of salts gives the same n rows.
    """
    salt = "_popscope_salt"
    salted = rows.withColumn(salt, F.spark_partition_id() % SALTS)
    inner = Window.partitionBy(*group, salt).orderBy(*order)
    outer = Window.partitionBy(*group).orderBy(*order)
    return (
        salted.withColumn(rank, F.row_number().over(inner))
        .where(F.col(rank) <= n)
        .drop(salt, rank)
        .withColumn(rank, F.row_number().over(outer))
        .where(F.col(rank) <= n)
    )
