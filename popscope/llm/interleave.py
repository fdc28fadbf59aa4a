"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within each source and numbered; row r of n stands at
(r + 1/2) / n. Sorted by that fraction, every stretch of the order holds the sources in
their proportions, so equal cuts give shards of one mixture, with counts at most one apart.

Null texts have size 1 and checksum 0. A null source is a source of its own. Repeated rows
are separate rows; which copy gets which place is open, and the result is the same. An
empty table gives no rows. Columns other than id, source and text play no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscope.llm.common import positions, small, stored

SEED = 20_240


def interleave(
    docs: DataFrame, shards: int = 8, seed: int = SEED, id: str = "doc_id", source: str = "source", text: str = "text"
) -> DataFrame:
    """One row per document: id, source, size (UTF-8 bytes + 1), text_crc32, shard, slot."""
    if shards < 1:
        raise ValueError(f"shards must be at least 1, got {shards}")
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id).alias("doc_id"),
        F.col(source).alias("source"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"),
    ).withColumn("shuffle_key", F.xxhash64(F.lit(seed), "doc_id"))
    tail = [F.col(c) for c in ("shuffle_key", "doc_id", "text_crc32", "size")]
    ranked = positions(rows, [F.asc_nulls_last("source"), *tail], "ranked")
    groups = stored(
        ranked.groupBy("source").agg(F.min("position").alias("first"), F.count(F.lit(1)).alias("n")), "sources"
    )
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    near = small(groups).withColumnRenamed("source", "of")
    placed = ranked.join(near, F.col("source").eqNullSafe(F.col("of")))
    fraction = (2 * (F.col("position") - F.col("first")) + 1) / (2 * F.col("n"))
    placed = placed.select(*rows.columns, fraction.alias("fraction"))
    ordered = positions(placed, [F.col("fraction"), F.asc_nulls_last("source"), *tail], "interleaved")
    # The first position p of a shard s is the least with p * shards >= s * total.
    whole = F.expr(f"(position * {shards}L) div {max(total, 1)}L")
    start = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}L) div {shards}L")
    return (
        ordered.withColumn("shard", whole)
        .withColumn("slot", F.col("position") - start)
        .select("doc_id", "source", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "slot")
    )
