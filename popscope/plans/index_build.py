"""Building the vector index as a batch job."""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from popscope.functions.encoders import Encoder
from popscope.operators.encode import encode_text, passages
from popscope.plans.first_rows import first_rows
from popscope.sources.vector_index import IndexStore, read_if_present, stored_schema
from popscope.spec import PopulationSpec


@dataclass(frozen=True)
class BuildReport:
    path: str
    encoded: int  # vectors made by this run
    rows: int  # vectors in the index now
    seconds: float


def hashed_passages(population: DataFrame, spec: PopulationSpec, encoder: Encoder) -> DataFrame:
    """``id``, ``text_hash`` and ``text`` of every passage; the hash also tells encoders apart."""
    maker = F.lit(f"{encoder.name}\n{encoder.dim}\n{encoder.passage_prefix}\n")
    return passages(population, spec).select("id", F.md5(F.concat(maker, "text")).alias("text_hash"), "text")


def encoded_rows(rows: DataFrame, encoder: Encoder, tasks: int | None = None) -> DataFrame:
    vectors = encode_text(rows, encoder, encoder.passage_prefix, tasks, packed=True)
    return vectors.withColumn("built_at", F.current_timestamp())


def build_index(
    population: DataFrame,
    spec: PopulationSpec,
    encoder: Encoder,
    root: str,
    limit: int | None = None,
    force: bool = False,
    rounds: int = 1,
    tasks: int | None = None,
    files: int | None = None,
) -> BuildReport:
    """Encode what the index lacks and publish the result as a new generation.

    A passage is skipped when its id is already there with the same text, published
    or pending from a run that did not finish; a changed text is encoded again and
    replaces the old vector, and so is one that another encoder made. Ids that left the population
    leave the index. If nothing is to be done, nothing is published. ``limit`` takes the first
    rows by id. ``force`` encodes everything anew, and readers keep the old index until the
    new one is complete.

    A run that dies loses the round it was in. With more than one round the passages
    are first written out by round, so that no round reads the population again.
    """
    if rounds < 1:
        raise ValueError(f"rounds must be at least 1, got {rounds}")
    started = time.monotonic()
    if population.isEmpty():
        raise ValueError("the population has no rows to index")
    now = hashed_passages(population, spec, encoder).select("id", "text_hash")
    if limit is not None:
        population = first_rows(population, spec.id, limit)
    store = IndexStore(population.sparkSession, root)
    schema, generation = stored_schema(population.schema[spec.id]), store.generation()
    pending_path = store.pending_path(generation + 1)
    published = None if force else store.stored()
    pending = None if force else read_if_present(store.spark, pending_path, schema)

    done = [part.select("id", "text_hash") for part in (published, pending) if part is not None]
    todo = _not_done(hashed_passages(population, spec, encoder), done, f"{root}/missing-{generation + 1}")
    encoded = 0
    for part in _rounds(todo, rounds, f"{root}/todo-{generation + 1}") if todo is not None else ():
        counted = Observation()
        vectors = encoded_rows(part, encoder, tasks).observe(counted, F.count(F.lit(1)).alias("n"))
        mode = "overwrite" if force and not encoded else "append"
        vectors.write.mode(mode).parquet(pending_path)
        encoded += counted.get["n"]
    added = read_if_present(store.spark, pending_path, schema) if encoded or pending is not None else None
    if added is None:
        added = store.spark.createDataFrame([], schema)
    elif pending is not None:  # of texts that may have changed since
        added = added.join(now, ["id", "text_hash"], "left_semi")
    store.publish(added, now.select("id"), files, anew=force)
    return BuildReport(root, encoded, store.stored().count(), time.monotonic() - started)


def _not_done(texts: DataFrame, done: list[DataFrame], path: str) -> DataFrame | None:
    """The passages whose id and text are not in ``done``; None if there are none.

    Only ids and hashes are compared. What is missing is written out, so that its size
    is known when it meets the texts: if it is small, they need no shuffle.
    """
    if not done:
        return texts
    missing = texts.select("id", "text_hash")
    for part in done:
        missing = missing.join(part, ["id", "text_hash"], "left_anti")
    missing.write.mode("overwrite").parquet(path)
    written = texts.sparkSession.read.schema(missing.schema).parquet(path)
    return None if written.isEmpty() else texts.join(written, ["id", "text_hash"], "left_semi")


def _rounds(todo: DataFrame, rounds: int, path: str) -> Iterator[DataFrame]:
    if rounds == 1:
        yield todo
        return
    number = F.pmod(F.xxhash64("id"), F.lit(rounds)).cast("int")
    split = todo.withColumn("round", number).hint("rebalance", "round")
    split.write.mode("overwrite").partitionBy("round").parquet(path)
    written = todo.sparkSession.read.schema(f"{_ddl(todo)}, round int").parquet(path)
    for i in range(rounds):
        yield written.where(F.col("round") == i).drop("round")


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema)
