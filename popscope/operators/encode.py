"""Passages and queries as vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, FloatType, StructField, StructType

from popscope.functions import blocks
from popscope.functions.encoders import Encoder
from popscope.functions.text import passage_text, with_prefix
from popscope.spec import PopulationSpec

EMPTY_QUERY = "query must be a non-empty string"
VECTOR = ArrayType(FloatType(), containsNull=False)


def passages(population: DataFrame, spec: PopulationSpec) -> DataFrame:
    """``id`` and the passage ``text`` of every row; only these columns are read."""
    return population.select(F.col(spec.id).alias("id"), passage_text(spec.passage).alias("text"))


def encode_text(
    rows: DataFrame, encoder: Encoder, prefix: str, tasks: int | None = None, packed: bool = False
) -> DataFrame:
    """Replace the column ``text`` by ``vec``; other columns pass through.

    ``packed`` gives vectors as bytes, the form in which an index stores them.

    ``tasks`` spreads the rows over that many tasks first, which pays when encoding
    a row costs far more than moving it.
    """
    kept = [field for field in rows.schema.fields if field.name != "text"]
    rows = rows.select(*[f.name for f in kept], with_prefix(prefix, F.col("text")).alias("text"))
    if tasks:
        rows = rows.repartition(tasks, kept[0].name)
    names, size, dim = [f.name for f in kept], encoder.batch_size, encoder.dim

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            vectors = np.empty((batch.num_rows, dim), dtype=np.float32)
            for start in range(0, batch.num_rows, size):
                vectors[start : start + size] = encoder.encode(texts.slice(start, size).to_pylist())
            vec = blocks.pack(vectors) if packed else blocks.lists(vectors)
            others = batch.columns[:-1]
            yield pa.RecordBatch.from_arrays([*others, vec], names=[*names, "vec"])

    schema = StructType([*kept, StructField("vec", BinaryType() if packed else VECTOR)])
    return rows.mapInArrow(encode, schema)


def encode_passages(
    population: DataFrame, spec: PopulationSpec, encoder: Encoder, tasks: int | None = None
) -> DataFrame:
    """``id`` and ``vec`` of every row's passage."""
    return encode_text(passages(population, spec), encoder, encoder.passage_prefix, tasks)


def encode_queries(queries: DataFrame, encoder: Encoder) -> DataFrame:
    """``query_id`` and ``vec`` of a table of query texts (``query_id``, ``text``)."""
    empty = F.col("text").isNull() | (F.col("text") == "")
    text = F.when(empty, F.raise_error(F.lit(EMPTY_QUERY))).otherwise(F.col("text"))
    return encode_text(queries.select("query_id", text.alias("text")), encoder, encoder.query_prefix)


def encode_query(query: str, encoder: Encoder) -> list[float]:
    """The vector of one query text given by the caller."""
    if not isinstance(query, str) or not query:
        raise ValueError(EMPTY_QUERY)
    return np.asarray(encoder.encode([encoder.query_prefix + query]), dtype=np.float32)[0].tolist()


def unpack(index: DataFrame, dim: int) -> DataFrame:
    """``id`` and ``vec`` of a packed index with the vectors as arrays."""

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rows in blocks.slices(batches, dim):
            yield pa.RecordBatch.from_arrays([ids, blocks.lists(rows)], names=["id", "vec"])

    schema = StructType([index.schema["id"], StructField("vec", VECTOR)])
    return index.select("id", "vec").mapInArrow(arrays, schema)


def pack(index: DataFrame, dim: int) -> DataFrame:
    """``id`` and ``vec`` of an index of arrays with the vectors as packed floats."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rows in blocks.slices(batches, dim):
            yield pa.RecordBatch.from_arrays([ids, blocks.pack(rows)], names=["id", "vec"])

    schema = StructType([index.schema["id"], StructField("vec", BinaryType())])
    return index.select("id", "vec").mapInArrow(packed, schema)
