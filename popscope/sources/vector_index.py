"""The vector index on disk.

    <root>/pending-<g>/     vectors encoded for generation g, appended run by run
    <root>/generation-<g>/  what generation g added: one vector per id, in id order
    <root>/replaced-<g>/    ids whose older vectors generation g replaced or removed
    <root>/published/       one small row per complete generation, naming the base it stands on

A generation is its base and what the generations after it added, without the ids they
replaced. So a small change writes little. ``compact`` makes a new base once the
changes add up to a share of it.

Readers see the newest published generation only. A build that dies leaves its
finished files in ``pending``, from where the next build goes on; a generation
that was not published is written again.

Vectors are stored packed: four bytes per number, little-endian float32. Reading
and sending them to the scoring code is a plain copy then, which for wide vectors
makes a search several times faster than arrays do; ``unpack`` gives arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType, TimestampType

from popscope.functions.vectors import checked_width
from popscope.sources.population import parquet_files


class IndexMissingError(Exception):
    """There is no index, or it is empty."""

    def __init__(self, root: str):
        super().__init__(f"no vector index at {root}; build it with build_index")


def stored_schema(id_field: StructField) -> StructType:
    return StructType(
        [
            StructField("id", id_field.dataType),
            StructField("text_hash", StringType()),
            StructField("vec", BinaryType()),
            StructField("built_at", TimestampType()),
        ]
    )


def read_if_present(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame | None:
    try:
        rows = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return rows


COMPACT = 0.1  # changed rows per row of the base from which a new base is written
MOST_DELTAS = 16  # generations on one base
BROADCAST_IDS = 500_000  # replaced ids up to this number are broadcast, after a count


@dataclass(frozen=True)
class IndexStore:
    spark: SparkSession
    root: str

    def newest(self) -> tuple[int, int]:
        """The newest published generation and its base; 0 and 0 when there is none."""
        log = read_if_present(self.spark, f"{self.root}/published", "generation long, base long")
        if log is None:
            return 0, 0
        # A generation published without a base is one by itself.
        last = log.agg(F.max(F.struct("generation", F.coalesce("base", "generation")))).first()[0]
        return tuple(last) if last else (0, 0)

    def generation(self) -> int:
        return self.newest()[0]

    def generation_path(self, generation: int) -> str:
        return f"{self.root}/generation-{generation}"

    def replaced_path(self, generation: int) -> str:
        return f"{self.root}/replaced-{generation}"

    def pending_path(self, generation: int) -> str:
        return f"{self.root}/pending-{generation}"

    def stored(self) -> DataFrame | None:
        """All columns of the newest generation; None before the first."""
        generation, base = self.newest()
        if not generation:
            return None
        rows = self.spark.read.parquet(self.generation_path(base))
        if generation == base:
            return rows
        rows, replaced = rows.withColumn("since", F.lit(base)), None
        for g in range(base + 1, generation + 1):
            rows = rows.unionByName(self.spark.read.schema(rows.drop("since").schema).parquet(self.generation_path(g)).withColumn("since", F.lit(g)))
            ids = self._replaced(g).select(F.col("id").alias("of"), F.lit(g).alias("until"))
            replaced = ids if replaced is None else replaced.unionByName(ids)
        few = replaced.count() <= BROADCAST_IDS
        replaced = replaced.groupBy("of").agg(F.max("until").alias("until"))
        replaced = F.broadcast(replaced) if few else replaced
        outdated = (F.col("id") == F.col("of")) & (F.col("since") < F.col("until"))
        return rows.join(replaced, outdated, "left_anti").drop("since")

    def _replaced(self, generation: int) -> DataFrame:
        return self.spark.read.parquet(self.replaced_path(generation))

    def publish(self, added: DataFrame, present: DataFrame | None = None, files: int | None = None, anew: bool = False) -> bool:
        """A generation with ``added``, of each id the newest row; False if it would change nothing.

        With ``present`` (``id``), ids that are not in it leave the index. ``anew`` leaves out all older vectors.
        One shuffle of what is added: ranges of the id also bring equal ids together for the window.
        """
        old = None if anew else self.stored()
        generation, base = self.newest()
        new = generation + 1
        ids = None if old is None else old.select("id")
        gone = ids is not None and present is not None and not ids.join(present, "id", "left_anti").isEmpty()
        if ids is not None and not gone and added.isEmpty():
            return False
        newest = Window.partitionBy("id").orderBy(F.desc("built_at"), F.desc("text_hash"))
        ranged = added.repartitionByRange(*([files] if files else []), F.col("id"))
        ranged = ranged.withColumn("newest", F.row_number().over(newest)).where("newest = 1").drop("newest")
        ranged.write.mode("overwrite").parquet(self.generation_path(new))
        if ids is None:
            self._log(new, new)
            return True
        replaced = ids.join(self.spark.read.parquet(self.generation_path(new)).select("id"), "id", "left_semi")
        if gone:
            replaced = replaced.unionByName(ids.join(present, "id", "left_anti"))
        replaced.write.mode("overwrite").parquet(self.replaced_path(new))
        self._log(new, base)
        self.compact(files)
        return True

    def compact(self, files: int | None = None, share: float = COMPACT) -> bool:
        """A new base, if the changes since the last one are more than ``share`` of it."""
        generation, base = self.newest()
        changed = sum(
            self.spark.read.parquet(path).count()
            for g in range(base + 1, generation + 1)
            for path in (self.generation_path(g), self.replaced_path(g))
        )
        held = self.spark.read.parquet(self.generation_path(base)).count() if generation else 0
        if changed <= share * held and generation - base <= MOST_DELTAS:
            return False
        ranged = self.stored().repartitionByRange(*([files] if files else []), F.col("id")).sortWithinPartitions("id")
        ranged.write.mode("overwrite").parquet(self.generation_path(generation + 1))
        self._log(generation + 1, generation + 1)
        return True

    def _log(self, generation: int, base: int) -> None:
        row = self.spark.range(1).select(F.lit(generation).cast("long").alias("generation"), F.lit(base).cast("long").alias("base"))
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/published")


def open_index(spark: SparkSession, root: str, dim: int | None = None) -> DataFrame:
    """``id`` and packed ``vec`` of the published index.

    A missing or empty index raises ``IndexMissingError``. With ``dim``, a vector of
    another width fails the query that reads it, whichever row it is in.
    """
    rows = IndexStore(spark, root).stored()
    if rows is None:
        raise IndexMissingError(root)
    rows = rows.select("id", "vec")
    if rows.isEmpty():
        raise IndexMissingError(root)
    return rows if dim is None else rows.select("id", checked_width(F.col("vec"), dim).alias("vec"))


def index_info(spark: SparkSession, root: str) -> DataFrame:
    """One row: ``path``, ``exists``, ``rows``, ``bytes``; the last two NULL without an index."""
    store = IndexStore(spark, root)
    generation, base = store.newest()
    found = F.lit(root).alias("path"), F.lit(bool(generation)).alias("exists")
    if not generation:
        nothing = F.lit(None).cast("long")
        return spark.range(1).select(*found, nothing.alias("rows"), nothing.alias("bytes"))
    both = store.stored().agg(F.count(F.lit(1)).alias("rows"))
    for g in range(base, generation + 1):
        size = parquet_files(spark, store.generation_path(g)).agg(F.sum("length").alias("bytes"))
        both = both.unionByName(size, allowMissingColumns=True)
    return both.agg(F.max("rows").alias("rows"), F.sum("bytes").alias("bytes")).select(
        *found, "rows", "bytes"
    )
