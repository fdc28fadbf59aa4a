"""Building the vector index as a stream over arriving Parquet files."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from popscope.functions.encoders import Encoder
from popscope.plans.index_build import encoded_rows, hashed_passages
from popscope.sources.vector_index import IndexStore, read_if_present, stored_schema
from popscope.spec import PopulationSpec

FILES_PER_TRIGGER = 100


def start_index_stream(
    spark: SparkSession,
    source: str,
    schema: StructType,
    spec: PopulationSpec,
    encoder: Encoder,
    root: str,
    files_per_trigger: int = FILES_PER_TRIGGER,
    file_filter: str = "*.parquet",
) -> StreamingQuery:
    """Encode every file of ``source`` (a folder, or a pattern of folders and files) that is not done yet, then stop.

    Each trigger takes some files and commits their vectors; the checkpoint beside
    them lets a stopped stream go on after the last commit. Files are told apart by
    path, so new rows must come in new files.
    """
    rows = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("pathGlobFilter", file_filter)
        .parquet(source)
    )
    vectors = encoded_rows(hashed_passages(rows, spec, encoder), encoder)
    return (
        vectors.writeStream.format("parquet")
        .option("path", f"{root}/stream")
        .option("checkpointLocation", f"{root}/stream-checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def publish_stream(spark: SparkSession, spec: PopulationSpec, schema: StructType, root: str) -> None:
    """Add what the stream has written since to the index, as a new generation.

    Of an id the newest row counts. Only ids and times are compared with the index; the
    vectors that are read are those that go into it.
    """
    store = IndexStore(spark, root)
    rows = read_if_present(spark, f"{root}/stream", stored_schema(schema[spec.id]))
    if rows is None:
        return
    published = store.stored()
    if published is not None:
        known = published.select(F.col("id").alias("of"), F.col("built_at").alias("known_at"))
        latest = rows.groupBy("id").agg(F.max("built_at").alias("built_at"))
        latest = latest.join(known, (F.col("id") == F.col("of")) & (F.col("known_at") >= F.col("built_at")), "left_anti")
        rows = rows.join(latest, ["id", "built_at"], "left_semi")
    store.publish(rows)
