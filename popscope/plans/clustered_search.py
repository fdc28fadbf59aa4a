"""Exact top-k over vectors stored in clusters: bounds skip whole clusters, the answer stays exact.

Build: centres come from k-means on a bounded sample (``SAMPLE`` rows, the lowest hashes of
their ids; a documented bound, every row is still indexed). Each row goes to its nearest centre
and the index is written partitioned by cluster, with a side table of every cluster's centre,
radius (largest distance of a member to the centre) and row count.

Search: for a query q, no member v of cluster (c, r) scores above ``q.c + |q| r`` (Cauchy-Schwarz
on ``q.(v - c)``). Clusters are read in order of that bound: first the fewest that hold k rows,
giving a k-th best score s; then only the clusters whose bound reaches s, by partition filters
on the written files. Rows of all other clusters score below s and cannot enter the answer.
Equal scores are ordered by id, as in ``vector_topk``; a bound equal to s is read.

For ``metric="cosine"`` the clusters are built over unit vectors and the bound is ``q.c + r``
for a unit q. Rows with a null or NaN vector are left out, as in ``vector_scores``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from popscope.functions import blocks
from popscope.operators.search import _checked_k, _checked_vector, _is_cosine, vector_topk

CLUSTERS = 64
SAMPLE = 20_000  # rows of the k-means sample; all rows are assigned
ROUNDS = 10  # k-means rounds on the sample
SLACK = 1e-9  # relative room for rounding in the bounds


@dataclass(frozen=True)
class ClusteredIndex:
    folder: str
    metric: str
    centres: np.ndarray  # (cluster, dim)
    radius: np.ndarray  # per cluster
    rows: np.ndarray  # per cluster

    def read(self, spark: SparkSession, clusters: Sequence[int]) -> DataFrame:
        """The index rows (id, vec) of the given clusters; the filter prunes partitions."""
        files = spark.read.parquet(self.folder)
        return files.where(F.col("cluster").isin([int(c) for c in clusters])).select("id", "vec")


def build_clusters(index: DataFrame, folder: str, clusters: int = CLUSTERS, metric: str = "dot", sample: int = SAMPLE, rounds: int = ROUNDS) -> ClusteredIndex:
    """Writes ``index`` (id, vec) to ``folder`` by cluster and returns the clusters' figures."""
    cosine = _is_cosine(metric)
    drawn = index.where(F.col("vec").isNotNull()).orderBy(F.xxhash64("id"), "id").limit(sample).select("vec").collect()
    if not drawn:
        raise ValueError("the index has no vectors")
    points = np.asarray([row["vec"] for row in drawn], np.float64)
    points = points[~np.isnan(points).any(axis=1)]
    if cosine:
        points = blocks.unit(points)
        points = points[~np.isnan(points).any(axis=1)]
    centres = _kmeans(points, min(clusters, len(points)), rounds)
    dim = centres.shape[1]
    shipped = index.sparkSession.sparkContext.broadcast(centres)
    schema = StructType([index.schema["id"], index.schema["vec"], StructField("cluster", IntegerType()), StructField("dist", DoubleType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shipped.value
        for batch in batches:
            if batch.column(1).null_count:
                batch = batch.filter(batch.column(1).is_valid())
            for start in range(0, batch.num_rows, blocks.SLICE_ROWS):
                part = batch.slice(start, blocks.SLICE_ROWS)
                rows = blocks.matrix(part.column(1), dim)
                rows = blocks.unit(rows) if cosine else rows
                ok = ~np.isnan(rows).any(axis=1)
                part, rows = part.filter(pa.array(ok)), rows[ok]
                near = np.argmin((rows * rows).sum(1)[:, None] - 2 * rows @ c.T + (c * c).sum(1)[None, :], axis=1)
                dist = np.linalg.norm(rows - c[near], axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(near.astype(np.int32)), pa.array(dist)], names=schema.names)

    placed = index.select("id", "vec").mapInArrow(assign, schema)
    placed.write.partitionBy("cluster").parquet(folder)
    figures = index.sparkSession.read.parquet(folder).groupBy("cluster").agg(F.max("dist").alias("radius"), F.count(F.lit(1)).alias("rows")).collect()
    radius, counts = np.full(len(centres), -np.inf), np.zeros(len(centres), np.int64)
    for row in figures:  # one row per cluster
        radius[row["cluster"]], counts[row["cluster"]] = row["radius"], row["rows"]
    return ClusteredIndex(folder, metric, centres, radius, counts)


def _kmeans(points: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Lloyd's rounds from k points spread over the sample; an empty cluster keeps its centre."""
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = np.argmin((points * points).sum(1)[:, None] - 2 * points @ centres.T + (centres * centres).sum(1)[None, :], axis=1)
        for c in range(k):
            members = points[near == c]
            if len(members):
                centres[c] = members.mean(axis=0)
    return centres


def pruned_topk(spark: SparkSession, clustered: ClusteredIndex, vector: Sequence[float], k: int) -> tuple[DataFrame, float]:
    """(the k best rows (id, score), share of the index's rows that were read)."""
    k, query = _checked_k(k), np.asarray(_checked_vector(vector))
    if clustered.metric == "cosine":
        query = blocks.unit(query[None, :])[0]
    live = np.flatnonzero(clustered.rows > 0)
    bound = clustered.centres[live] @ query + np.linalg.norm(query) * clustered.radius[live]
    bound += SLACK * (np.abs(bound) + 1.0)
    order = live[np.argsort(-bound, kind="stable")]
    bounds = dict(zip(live.tolist(), bound.tolist()))
    held = np.cumsum(clustered.rows[order])
    first = order[: int(np.searchsorted(held, k)) + 1].tolist()
    found = vector_topk(clustered.read(spark, first), vector, k, clustered.metric).collect()  # k rows at most
    last = found[-1]["score"] if len(found) == k else -np.inf
    rest = [int(c) for c in order[len(first) :] if bounds[int(c)] >= last]
    total = int(clustered.rows.sum())
    read = int(clustered.rows[first].sum() + clustered.rows[rest].sum())
    schema = StructType([spark.read.parquet(clustered.folder).schema["id"], StructField("score", DoubleType())])
    hits = spark.createDataFrame(found, schema)
    if rest:
        more = vector_topk(clustered.read(spark, rest), vector, k, clustered.metric)
        hits = hits.unionByName(more).orderBy(F.desc("score"), "id").limit(k)
    return hits, read / max(total, 1)
