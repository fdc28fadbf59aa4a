"""From raw documents to training shards: five stages, each written before the next reads it.

A stage takes (spark, docs, sf_dir) and returns documents with the columns of its input; the
last returns each document's place in the shards. ``run`` applies them to the documents table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from popscope import ship_package
from popscope.llm.common import stored, table
from popscope.llm.decontaminate import without_items
from popscope.llm.interleave import interleave
from popscope.llm.langid import in_a_language
from popscope.llm.mixing import mixed_documents
from popscope.llm.near_dup import without_near_duplicates

SHARDS = 8


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without any letter, which are of no language."""
    ship_package(spark)
    return in_a_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    ship_package(spark)
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark table."""
    ship_package(spark)
    return without_items(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Gives every document as often as the mix takes it."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, text_crc32, shard and slot of every document of the mix."""
    return interleave(docs, SHARDS)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]
ORACLE_SQL = None  # learning, linking and edit distance are beyond SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
