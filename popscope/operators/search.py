"""Exact nearest vectors, and the population rows behind them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegralType, StructField, StructType

from popscope.functions import blocks
from popscope.functions.encoders import Encoder
from popscope.operators.encode import encode_query
from popscope.operators.filtering import matching
from popscope.operators.ranking import first_per_group
from popscope.plans.late_rows import FILE, PLACE, read_picked, with_place
from popscope.plans.lowest import TOP_N
from popscope.spec import PopulationSpec, checked_count

OVER_FETCH = 10
# Numbers of query vectors that travel to the tasks at once, as one block; and hits
# that are broadcast. More queries are more blocks, more hits are left to Spark.
BLOCK_NUMBERS = 1_000_000
BROADCAST_HITS = 10_000
# Buckets of 32,768 ids (4 KB each) of a filter's bitmap that may be broadcast; beyond it the
# scores of all rows are joined with the allowed ids.
MOST_BUCKETS = 16_384
BUCKET_BITS = 8 * 4096
GROW = 4  # factor by which an unfiltered search widens its top-k while ids dangle


def vector_scores(index: DataFrame, vector: Sequence[float], metric: str = "dot") -> DataFrame:
    """``id`` and ``score`` of all index rows (``id``, ``vec``), in no order.

    Rows whose score is NaN or NULL are left out; a row of another width fails the job.
    """
    query, cosine = np.asarray(_checked_vector(vector)), _is_cosine(metric)
    if cosine:
        query = blocks.unit(query[None, :])[0]
    schema = StructType([index.schema["id"], StructField("score", DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rows in blocks.slices(batches, len(query)):
            values = blocks.dots(blocks.unit(rows) if cosine else rows, query)
            found = pa.RecordBatch.from_arrays([ids, pa.array(values)], names=["id", "score"])
            yield found.filter(pa.array(~np.isnan(values)))

    return index.select("id", "vec").mapInArrow(score, schema)


def vector_topk(index: DataFrame, vector: Sequence[float], k: int, metric: str = "dot") -> DataFrame:
    """The k index rows with the highest score; equal scores by id.

    Every task passes on its own k best rows only.
    """
    k, vector, cosine = _checked_k(k), _checked_vector(vector), _is_cosine(metric)
    schema = StructType([index.schema["id"], StructField("score", DoubleType())])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query = pa.table({"query_id": [0], "vec": [vector]})
        for found in blocks.best_pairs(query, batches, len(vector), k, cosine):
            yield found.select(["id", "score"])

    found = index.select("id", "vec").mapInArrow(best, schema)
    return found.orderBy(F.desc("score"), "id").limit(k)


def vector_topk_batch(index: DataFrame, queries: DataFrame, k: int, metric: str = "dot", block_numbers: int = BLOCK_NUMBERS) -> DataFrame:
    """The k best index rows of every query (``query_id``, ``vec``).

    Gives ``query_id``, ``id``, ``score`` and ``rank``. The queries travel to the tasks that scan
    the index, in blocks of bounded size; the index is never shuffled. Each block is a pass over the
    index, and a task returns only its own k best rows per query.
    """
    k, cosine = _checked_k(k), _is_cosine(metric)
    index = index.select("id", "vec")
    schema = StructType([queries.schema["query_id"], index.schema["id"], StructField("score", DoubleType())])
    found = None
    for block, dim in _query_blocks(queries.select("query_id", "vec").where(F.col("vec").isNotNull()), block_numbers):
        part = index.mapInArrow(_against(block, dim, k, cosine), schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = index.sparkSession.createDataFrame([], schema)
    return first_per_group(found, ["query_id"], [F.desc("score"), F.asc("id")], k, "rank")


def _against(block: pa.Table, dim: int, k: int, cosine: bool):
    def run(batches):
        yield from blocks.best_pairs(block, batches, dim, k, cosine)

    return run


def _query_blocks(queries: DataFrame, numbers: int) -> Iterator[tuple[pa.Table, int]]:
    """The query vectors, which the driver takes partition by partition, in blocks of ``numbers`` at most."""
    kinds, held, dim = to_arrow_schema(queries.schema), [], None
    for row in queries.toLocalIterator():
        dim = dim or _width(row["vec"])
        held.append({"query_id": row["query_id"], "vec": row["vec"]})
        if len(held) * dim >= numbers:
            yield pa.Table.from_pylist(held, kinds), dim
            held = []
    if held:
        yield pa.Table.from_pylist(held, kinds), dim


def expanding_topk(index: DataFrame, vector: Sequence[float], n: int, allowed: DataFrame, metric: str = "dot", grow: int = GROW) -> tuple[DataFrame, int]:
    """(hits, k): the k best index rows, k the first of n, grow n, grow^2 n, ... whose hits hold n allowed ids.

    Each round is one scan of the index in which every task keeps its own k best rows; only if
    ids of the round dangle (are not among ``allowed``) does the next round look further. The
    rows of a round are checkpointed, so the count and the later join see the same rows. Ends
    when n allowed ids are found or the index has fewer than k rows: the n best allowed rows are
    then among the hits, for every row outside them scores lower (or equal with a larger id).
    """
    k = n
    while True:
        hits = vector_topk(index, vector, k, metric).checkpoint()
        found = hits.count()
        small = found <= BROADCAST_HITS
        present = allowed.join(F.broadcast(hits) if small else hits, "id", "left_semi").count()
        if present >= n or found < k:
            return hits, k
        k *= grow


def allowed_bits(allowed: DataFrame, most: int = MOST_BUCKETS) -> dict[int, np.ndarray] | None:
    """Bitmaps of the ``id`` column by bucket (Spark's ``bitmap_construct_agg``); None if over ``most`` buckets.

    Exact: a bit per id, no false hits. Built by a grouped aggregate with partial bitmaps before
    the shuffle; only the bucket count decides whether it travels, not the number of rows.
    """
    ids = allowed.where(F.col("id").isNotNull())
    buckets = ids.groupBy(F.bitmap_bucket_number("id").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))
    buckets = buckets.checkpoint()
    if buckets.limit(most + 1).count() > most:
        return None
    return {int(r["bucket"]): np.frombuffer(r["bits"], np.uint8) for r in buckets.toLocalIterator()}


def in_bits(ids: np.ndarray, bits: dict[int, np.ndarray]) -> np.ndarray:
    """Which ids have their bit set; the bucket and place are Spark's (Java division, truncating)."""
    ids = ids.astype(np.int64)
    positive = ids > 0
    bucket = np.where(positive, (ids - 1) // BUCKET_BITS + 1, -((-ids) // BUCKET_BITS))
    place = np.where(positive, (ids - 1) % BUCKET_BITS, (-ids) % BUCKET_BITS)
    out = np.zeros(len(ids), bool)
    for b in np.unique(bucket):
        held = bits.get(int(b))
        if held is None:
            continue
        at = bucket == b
        out[at] = (held[place[at] >> 3] >> (place[at] & 7).astype(np.uint8)) & 1 == 1
    return out


def allowed_topk(index: DataFrame, vector: Sequence[float], k: int, bits: dict[int, np.ndarray], metric: str = "dot") -> DataFrame:
    """Every task's own k best index rows among the ids of ``bits``; equal scores by id."""
    query, cosine = np.asarray(_checked_vector(vector)), _is_cosine(metric)
    if cosine:
        query = blocks.unit(query[None, :])[0]
    shipped = index.sparkSession.sparkContext.broadcast(bits)
    schema = StructType([index.schema["id"], StructField("score", DoubleType())])
    arrow = to_arrow_schema(schema)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_ids, held_scores = np.zeros(0, np.int64), np.zeros(0)
        for ids, rows in blocks.slices(batches, len(query)):
            values = blocks.dots(blocks.unit(rows) if cosine else rows, query)
            numbers = ids.to_numpy(zero_copy_only=False)
            keep = ~np.isnan(values) & ids.is_valid().to_numpy(zero_copy_only=False)
            keep[keep] = in_bits(numbers[keep], shipped.value)
            held_ids, held_scores = np.concatenate([held_ids, numbers[keep]]), np.concatenate([held_scores, values[keep]])
            if len(held_ids) > 4 * k:
                held_ids, held_scores = _first(held_ids, held_scores, k)
        held_ids, held_scores = _first(held_ids, held_scores, k)
        yield pa.RecordBatch.from_arrays([pa.array(held_ids).cast(arrow.field("id").type), pa.array(held_scores, pa.float64())], schema=arrow)

    return index.select("id", "vec").mapInArrow(best, schema)


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def hydrate(population: DataFrame, spec: PopulationSpec, hits: DataFrame, bounded: bool = False) -> DataFrame:
    """Population rows of the hits with the hits' other columns added.

    Hits whose id is not in the population vanish. ``bounded`` says that the hits
    come out of a limit of at most ``BROADCAST_HITS``, so that they may be sent to every task.
    """
    hits = hits.withColumnRenamed("id", spec.id)
    return population.join(F.broadcast(hits) if bounded else hits, spec.id)


def search(
    population: DataFrame,
    spec: PopulationSpec,
    index: DataFrame,
    n: int,
    query: str | None = None,
    encoder: Encoder | None = None,
    vector: Sequence[float] | None = None,
    filters: Mapping | None = None,
    over_fetch: int = OVER_FETCH,
    mode: str = "pre",
    metric: str = "dot",
) -> DataFrame:
    """The n population rows nearest to a query text or vector, with ``score``.

    ``mode="pre"`` filters first and always finds n rows if that many match; without filters it
    widens a top-k until n of its ids are in the population (``expanding_topk``). ``mode="post"``
    ranks first: the n * over_fetch best are fetched and filtered, which may leave
    fewer than n. On a table straight from files, ids are found over narrow columns, and up to
    ``lowest.TOP_N`` whole rows are then read from their files.
    """
    n = checked_count(n)
    if (query is None) == (vector is None):
        raise ValueError("give either query or vector")
    if mode not in ("pre", "post"):
        raise ValueError(f"mode must be 'post' or 'pre', got {mode!r}")
    over_fetch = _checked_k(over_fetch, "over_fetch")
    if vector is None:
        if encoder is None:
            raise ValueError("a query text needs an encoder")
        vector = encode_query(query, encoder)
    placed = with_place(population) if n <= TOP_N else None
    rows = matching(population if placed is None else placed, spec, filters)
    if placed is not None:
        rows = rows.select(spec.id, FILE, PLACE)
    if mode == "post":
        k = n * (1 if filters is None else over_fetch)
        hits = vector_topk(index, vector, k, metric)
    elif filters is None:
        hits, k = expanding_topk(index, vector, n, rows.select(F.col(spec.id).alias("id")), metric)
    else:
        k, allowed = n, rows.select(F.col(spec.id).alias("id"))
        bits = allowed_bits(allowed) if isinstance(index.schema["id"].dataType, IntegralType) else None
        if bits is not None:
            # Each task tests its ids against the bits and sends on only its own n best.
            hits = allowed_topk(index, vector, n, bits, metric).orderBy(F.desc("score"), "id").limit(n)
        else:
            # Only ids and scores meet the filtered ids, never vectors.
            scored = vector_scores(index, vector, metric).join(allowed, "id", "left_semi")
            hits = scored.orderBy(F.desc("score"), "id").limit(n)
    found = hydrate(rows, spec, hits, bounded=k <= BROADCAST_HITS)
    found = found.orderBy(F.desc("score"), spec.id).limit(n)
    return found.select(*population.columns, "score") if placed is None else read_picked(population, found.select(FILE, PLACE, "score"))


def search_late(population: DataFrame, spec: PopulationSpec, index: DataFrame, n: int, **options) -> DataFrame:
    """``search``, which reads late by itself; kept for callers of the older name."""
    return search(population, spec, index, n, **options)


def _is_cosine(metric: str) -> bool:
    if metric not in ("dot", "cosine"):
        raise ValueError(f"metric must be 'dot' or 'cosine', got {metric!r}")
    return metric == "cosine"


def _checked_vector(vector: Sequence[float]) -> list[float]:
    vector = [float(x) for x in vector]
    if not vector:
        raise ValueError("the query vector must be a non-empty list of numbers")
    return vector


def _width(vector: list | bytes) -> int:
    return len(vector) // 4 if isinstance(vector, bytes) else len(vector)


def _checked_k(k: int, name: str = "k") -> int:
    if isinstance(k, bool) or not isinstance(k, int) or k < 1:
        raise ValueError(f"{name} must be a positive integer, got {k!r}")
    return k
