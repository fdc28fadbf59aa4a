"""Grouping and ordering keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def decade(column: Column) -> Column:
    return column - column % 10


def decade_label(column: Column, suffix: str = "") -> Column:
    return F.concat(decade(column).cast("string"), F.lit(suffix))


def random_key(id_columns: Sequence[str], seed: int, tag: str = "") -> Column:
    """A random ordering key, in hex: a hash of seed, tag and id.

    The same rows come out whatever the partitioning, and two tags give independent orders.
    """
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in id_columns]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *([F.lit(tag)] if tag else []), *parts))
