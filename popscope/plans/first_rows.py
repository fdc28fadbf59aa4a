"""The first n rows of a table by id, for any n."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from popscope.spec import checked_count

NARROW_TOP = 20_000  # ids that may meet in one task; more are cut into ranges first
RANGES = 1_000


def first_rows(rows: DataFrame, id_column: str, n: int, narrow_top: int = NARROW_TOP, ranges: int = RANGES) -> DataFrame:
    """The n rows with the lowest ids; all of them when there are fewer.

    The n-th id is found over the ids alone; the rows below it stay in their tasks. Of the rows
    with that id, and of rows without id, which come last, as many as are missing are taken.
    """
    n, id = checked_count(n, "limit"), F.col(id_column)
    edge, below = _nth(rows.select(id_column).where(id.isNotNull()), id_column, n, narrow_top, ranges)
    if edge is None:  # fewer than n rows have an id
        return rows.where(id.isNotNull()).unionByName(rows.where(id.isNull()).limit(n - below))
    return rows.where(id < F.lit(edge)).unionByName(rows.where(id == F.lit(edge)).limit(n - below))


def _nth(ids: DataFrame, name: str, n: int, narrow_top: int, ranges: int):
    """The n-th id and the number of rows below it; None and the number of all rows if they are fewer."""
    id, before = F.col(name), 0
    while n - before > narrow_top:
        counted = (
            ids.repartitionByRange(ranges, id)
            .groupBy(F.spark_partition_id().alias("range"))
            .agg(F.count(F.lit(1)).alias("rows"), F.min(id).alias("first"), F.max(id).alias("last"))
        )
        upto = Window.orderBy("range")  # one row per range
        edge = counted.withColumn("total", F.sum("rows").over(upto)).where(F.col("total") >= n - before).orderBy("range").first()
        if edge is None:
            return None, before + ids.count()
        before += edge["total"] - edge["rows"]
        if edge["first"] == edge["last"]:
            return edge["first"], before
        ids = ids.where(id.between(F.lit(edge["first"]), F.lit(edge["last"])))
    found = ids.orderBy(id).limit(n - before).agg(F.max(id).alias("edge"), F.count(F.lit(1)).alias("rows")).first()
    if found["rows"] < n - before:
        return None, before + found["rows"]
    return found["edge"], before + ids.where(id < F.lit(found["edge"])).count()
