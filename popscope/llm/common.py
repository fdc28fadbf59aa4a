"""What several of these operators need: tables, a shared folder, global row numbers."""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from popscope.sources.workspace import shared_folder

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
    "conversations": "conv_id long, turn long, role string, text string",
    "benchmark": "item_id long, text string",
}
WORD = r"[^\x20\x09-\x0D]+"  # a word: anything between ASCII white space
BROADCAST_ROWS = 200_000  # narrow tables up to this many rows are broadcast, after a count


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder that all tasks can reach.

    Under ``spark.checkpoint.dir``; only where that is unset and all tasks run in this
    process, under a folder of our own.
    """
    try:
        return shared_folder(spark, name)
    except ValueError:
        if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
            raise
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="popscope-"))
        return shared_folder(spark, name)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the shared folder and read back: computed once, and lost with no executor."""
    path = scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def small(rows: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` with a broadcast hint if they are few; ``rows`` should be stored."""
    return F.broadcast(rows) if rows.limit(limit + 1).count() <= limit else rows


def word_count(text: Column) -> Column:
    """Words of the whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def positions(rows: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """``rows`` with ``position``, their number from 0 in the order of ``keys``.

    A range shuffle sorts; each partition numbers its own rows, and the counts of the
    partitions before are added. Equal rows are told apart by a running number, so a
    run of equal keys is cut too. Which of several equal rows comes first is open.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    order = [*keys, F.col("_tie")]
    spread = tied.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie")
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stored(spread.withColumns({"_part": F.spark_partition_id(), "_at": at}), name)
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, however many rows the table has.
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.select(*rows.columns, (F.col("_before") + F.col("_at")).alias("position"))


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow``, giving back Python's and Arrow's free memory when its task ends.

    Python workers are reused between tasks; without this an idle worker keeps its largest
    arrays and Arrow's pool keeps its buffers while the next stage runs beside it.
    """

    @wraps(run)
    def freeing(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()

    return freeing
