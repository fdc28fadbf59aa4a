"""The population table: a directory of Parquet files read as one table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from popscope.functions.text import row_json


class DatasetMissingError(Exception):
    """The directory does not exist or holds no Parquet file."""

    def __init__(self, path: str):
        super().__init__(f"no Parquet dataset at {path}; put the *.parquet files there first")


def parquet_files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``length`` of every Parquet file; file contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    return files.option("recursiveFileLookup", "true").load(path).select("path", "length")


def open_population(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """The table at ``path``, or ``DatasetMissingError``.

    With a ``schema`` no file has to be opened to find the columns.
    """
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    try:
        rows = (reader.schema(schema) if schema else reader).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise DatasetMissingError(path) from error
        raise
    if not len(rows._jdf.inputFiles()):  # the names stay in the JVM
        raise DatasetMissingError(path)
    return rows


def table_inventory(population: DataFrame) -> DataFrame:
    """One row: ``rows``, ``files`` and ``bytes`` of a table straight from files."""
    place = population.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    files = place.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("size"))
    total = lambda name: F.coalesce(F.sum(name), F.lit(0))
    return files.agg(total("rows").alias("rows"), F.count("file").alias("files"), total("size").alias("bytes"))


def dataset_inventory(spark: SparkSession, path: str) -> DataFrame:
    """One row: ``files`` and ``bytes``."""
    try:
        files = parquet_files(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise DatasetMissingError(path) from error
        raise
    return files.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )


def rows_as_json(rows: DataFrame) -> DataFrame:
    """One JSON document per row, in the column ``json``."""
    return rows.select(row_json(rows.columns).alias("json"))


def write_json(rows: DataFrame, path: str) -> None:
    """The rows as JSON lines, with NULL fields kept."""
    rows.write.option("ignoreNullFields", "false").json(path)
