"""Scoring of Arrow batches of vectors inside a task.

A score is summed element by element in double precision, so it does not depend on
the batch its row came in, and equal vectors tie exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PAIRS = 8192  # pairs scored exactly at a time
SLICE_ROWS = 1024  # rows scored at a time, so that a slice stays in the CPU cache


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list or packed column as a matrix; NULL elements become NaN."""
    packed = not pa.types.is_list(vectors.type) and not pa.types.is_large_list(vectors.type)
    lengths = pc.unique(pc.binary_length(vectors) if packed else pc.list_value_length(vectors))
    wrong = [n for n in lengths.to_pylist() if n != (dim * 4 if packed else dim)]
    if wrong:
        found = wrong[0] / 4 if packed else wrong[0]
        raise ValueError(f"vector width mismatch: expected {dim}, found {found:g}; rebuild the index")
    if not packed:
        return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), dim)
    if not len(vectors):
        return np.empty((0, dim), dtype=np.float32)
    wide = pa.types.is_large_binary(vectors.type)
    starts = np.frombuffer(vectors.buffers()[1], dtype=np.int64 if wide else np.int32)
    first = int(starts[vectors.offset])
    values = np.frombuffer(vectors.buffers()[2], dtype="<f4", count=len(vectors) * dim, offset=first)
    return values.reshape(len(vectors), dim)


def pack(vectors: np.ndarray) -> pa.Array:
    """Matrix rows as packed little-endian float32 values."""
    values = np.ascontiguousarray(vectors, dtype="<f4")
    ends = np.arange(len(values) + 1, dtype=np.int32) * (values.shape[1] * 4)
    return pa.Array.from_buffers(
        pa.binary(), len(values), [None, pa.py_buffer(ends), pa.py_buffer(values.ravel())]
    )


def lists(vectors: np.ndarray) -> pa.Array:
    """Matrix rows as lists of float32."""
    ends = np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(vectors.astype(np.float32).ravel()))


def slices(batches, dim: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and vectors of (id, vec) batches, a slice at a time, without NULL vectors."""
    for batch in batches:
        if batch.column(1).null_count:
            batch = batch.filter(batch.column(1).is_valid())
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            yield part.column(0), matrix(part.column(1), dim)


def dots(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Dot product of each row with one query, or with the query of the same row."""
    columns = np.ascontiguousarray(rows.T, dtype=np.float64)
    total = np.zeros(len(rows))
    with np.errstate(invalid="ignore", over="ignore"):
        for column, weight in zip(columns, query.T.astype(np.float64)):
            total += column * weight
    return total


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length one; NaN for a row of length zero."""
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        return rows / np.sqrt(dots(rows, rows))[:, None]


def best_pairs(queries: pa.Table, batches, dim: int, k: int, cosine: bool) -> Iterator[pa.RecordBatch]:
    """The k best rows of the batches for each query (``query_id``, ``vec``).

    A single-precision matrix product finds candidates. Every row within its error
    bound of the k-th value is scored again exactly, so that the result is exact.
    """
    if not queries.num_rows:
        return
    query_ids = queries.column(0).combine_chunks()
    wanted = matrix(queries.column(1).combine_chunks(), dim).astype(np.float64)
    if cosine:
        wanted = unit(wanted)
    wanted32 = wanted.astype(np.float32)
    sizes = np.abs(np.where(np.isfinite(wanted), wanted, 0)).sum(axis=1)
    reach = 4 * dim * np.finfo(np.float32).eps * sizes
    floor = np.full(len(wanted), -np.inf)  # k-th best score so far, per query
    kept = None
    for ids, rows in slices(batches, dim):
        if cosine:
            rows = unit(rows)
        with np.errstate(invalid="ignore", over="ignore"):
            rough = wanted32 @ rows.T.astype(np.float32, copy=False)
        slack = reach * _largest(rows)
        bar = floor
        if len(rows) > k:
            sure = np.where(np.isfinite(rough), rough, -np.inf)
            kth = np.partition(sure, len(rows) - k, axis=1)[:, len(rows) - k]
            bar = np.maximum(floor, kth - slack)
        # Written so that a product that overflowed counts as a candidate.
        query_at, row_at = np.nonzero(~(rough < (bar - slack)[:, None]))
        if not len(row_at):
            continue
        values = np.empty(len(row_at))
        for start in range(0, len(row_at), PAIRS):  # each pair takes two copies of a vector
            part = slice(start, start + PAIRS)
            values[part] = dots(rows[row_at[part]], wanted[query_at[part]])
        found = pa.table({"query": query_at, "id": ids.take(pa.array(row_at)), "score": values})
        found = found.filter(pa.array(~np.isnan(values)))
        kept = _best_per_query(found if kept is None else pa.concat_tables([kept, found]), k)
        at, score = kept.column("query").to_numpy(), kept.column("score").to_numpy()
        lowest = np.full(len(wanted), np.inf)
        np.minimum.at(lowest, at, score)
        floor = np.where(np.bincount(at, minlength=len(wanted)) >= k, lowest, -np.inf)
    if kept is not None and kept.num_rows:
        picked = query_ids.take(kept.column("query").combine_chunks())
        found = pa.table([picked, kept.column("id"), kept.column("score")], names=["query_id", "id", "score"])
        yield from found.combine_chunks().to_batches()


def _best_per_query(table: pa.Table, k: int) -> pa.Table:
    order = [("query", "ascending"), ("score", "descending"), ("id", "ascending")]
    table = table.sort_by(order)
    at = table.column("query").to_numpy()
    rank = np.arange(len(at)) - np.searchsorted(at, at)
    return table.filter(pa.array(rank < k))


def _largest(rows: np.ndarray) -> float:
    """The largest absolute value, leaving out NaN and infinity."""
    largest = max(rows.max(), -rows.min())
    return largest if np.isfinite(largest) else np.abs(rows[np.isfinite(rows)]).max(initial=0)
