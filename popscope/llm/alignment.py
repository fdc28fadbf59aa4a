"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

A is a byte-level BPE (the ranks of its vocabulary, run by tiktoken) on ``" " + text``; B a sentencepiece BPE run on ``text`` (it adds the
space itself). Both must spell out exactly the bytes of ``" " + text``; a text where either
does not (or null, or empty) has no tokens and all counts 0.

Per text, the ends of A's and B's tokens are two sorted arrays. Their merge is cut by
**merge path**: for diagonals ``d = 0, PIECE, 2 PIECE, ...`` of the merge grid a binary search
finds the split (i, j) with i + j = d, so every piece merges at most ``PIECE`` ends and the
pieces are independent. A piece emits one link per distinct end it holds: the A and the B
token that cover the byte run ending there (two tilings of the same bytes: every run between
consecutive ends lies in one token of each, and these are exactly the overlapping pairs). A
common end split between two pieces is stitched by dropping it from the second. Groups are the
runs between ends common to both.

Spark's part: tokens are taken once per text and written; the corpus-wide count of every
(A id, B id) link is a grouped count with partial counts before the shuffle (a hot pair such as
two spaces is combined map-side); each B id's highest count is a second, small aggregate. The
counted pairs are broadcast when a count shows they are few, else joined by a shuffle (AQE
splits a hot pair); per text the links are summed in the task that holds them.

Edge cases: null doc_id is kept as a row; repeated rows are aligned each and their links count
each time; empty tables give no rows; extra columns are ignored; texts of any length are
tokenized whole.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscope.llm.common import released, small, stored

TOKENIZERS = "/opt/tokenizers"
# A's vocabulary as merge ranks (ids equal to those of A_FILE; tests compare both on the corpus).
A_FILE, A_RANKS, B_FILE = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
PIECE = 4096  # ends merged by one piece of the merge path
BYTES_PER_BATCH = 1 << 20  # text bytes tokenized, and their rows sent on, at once


@lru_cache(maxsize=2)
def tokenizers(folder: str):
    """(encode A, A id -> bytes, encode B, B id -> bytes); None where an id has no bytes.

    A runs as byte-level BPE over the vocabulary's ranks, without special tokens (their strings
    are plain text); B is the sentencepiece model.
    """
    import public_tokenizers
    import sentencepiece
    import tiktoken

    with open(f"{folder}/{A_RANKS}", "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    a = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    a_bytes = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        a_bytes[rank] = token
    b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{B_FILE}")
    b_bytes = [None] * b.get_piece_size()
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        if b.is_byte(i):
            b_bytes[i] = bytes([int(piece[3:5], 16)])
        elif not (b.is_control(i) or b.is_unknown(i)):
            b_bytes[i] = piece.replace("\u2581", " ").encode("utf-8")

    def encode_a(texts):
        return [a.encode_ordinary(" " + t) for t in texts]

    def encode_b(texts):
        return b.encode(list(texts), num_threads=1)

    return encode_a, a_bytes, encode_b, b_bytes


@lru_cache(maxsize=4)
def _lengths(table: tuple) -> np.ndarray:
    return np.asarray([len(x) if x is not None else 0 for x in table], np.int64)


def ends(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray | None:
    """Byte offsets where the tokens end; None if a token has no bytes."""
    if not len(ids) or ids.min() < 0 or ids.max() >= len(lengths):
        return None
    at = lengths[ids]
    return None if at.min() <= 0 else np.cumsum(at)


def split(a: np.ndarray, b: np.ndarray, d: int) -> tuple[int, int]:
    """Merge path: (i, j), i + j = d, such that a[:i] and b[:j] are the first d ends (A first on ties)."""
    lo, hi = max(0, d - len(b)), min(d, len(a))
    while lo < hi:
        i = (lo + hi) // 2
        if a[i] <= b[d - i - 1]:
            lo = i + 1
        else:
            hi = i
    return lo, d - lo


def links(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """(A index, B index) of every link, in byte order, merged piece by piece."""
    out_a, out_b, last = [], [], -1
    total = len(a) + len(b)
    cuts = [split(a, b, d) for d in range(0, total, piece)] + [(len(a), len(b))]
    for (i0, j0), (i1, j1) in zip(cuts, cuts[1:]):
        held = np.union1d(a[i0:i1], b[j0:j1])
        held = held[held > last]  # a common end whose halves fell into two pieces
        if not len(held):
            continue
        # The covering token of a run ends at or after the run's end: at most one place beyond the piece.
        out_a.append(i0 + np.searchsorted(a[i0 : i1 + 1], held, "left"))
        out_b.append(j0 + np.searchsorted(b[j0 : j1 + 1], held, "left"))
        last = held[-1]
    if not out_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_a), np.concatenate(out_b)


@lru_cache(maxsize=4)
def _marked(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every id's text followed by ``,``, ``|`` or ``;``."""
    return tuple(np.array([f"{i}{mark}" for i in range(size)], dtype=object) for mark in ",|;")


def groups(a_ids: np.ndarray, a: np.ndarray, b_ids: np.ndarray, b: np.ndarray) -> tuple[int, str]:
    """Number of groups and their text ``a1,a2|b1;a3|b2,b3``.

    Every id is written with the mark that follows it: ``,`` inside a side, ``|`` after a
    group's last A id, ``;`` after its last B id (none after the very last). An A token's place
    is its index plus the B tokens of all earlier groups; a B token's, its index plus the A
    tokens up to its own group's end.
    """
    common = np.intersect1d(a, b, assume_unique=True)
    last_a, last_b = np.isin(a, common), np.isin(b, common)
    cut_a, cut_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
    group_a = np.searchsorted(cut_a, np.arange(len(a)), "right")
    group_b = np.searchsorted(cut_b, np.arange(len(b)), "right")
    comma, bar, semi = _marked(1 << max(16, int(max(a_ids.max(), b_ids.max())).bit_length()))  # one table for all texts
    out = np.empty(len(a) + len(b), dtype=object)
    out[np.arange(len(a)) + np.concatenate([[0], cut_b])[group_a]] = np.where(last_a, bar[a_ids], comma[a_ids])
    out[np.arange(len(b)) + cut_a[group_b]] = np.where(last_b, semi[b_ids], comma[b_ids])
    return len(common), "".join(out.tolist())[:-1]


def aligned_texts(docs: DataFrame, folder: str = TOKENIZERS, piece: int = PIECE) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, link_a and link_b (ids per link)."""
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, link_a array<int>, link_b array<int>"

    @released
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_a, a_bytes, encode_b, b_bytes = tokenizers(folder)
        a_len, b_len = _lengths(tuple(a_bytes)), _lengths(tuple(b_bytes))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, stop in _spans(texts):
                chunk = [t if t else "" for t in texts[start:stop]]
                live = [k for k, t in enumerate(chunk) if t]
                a_all = dict(zip(live, encode_a([chunk[k] for k in live])))
                b_all = dict(zip(live, encode_b([chunk[k] for k in live])))
                rows = [_aligned(text, a_all.get(k), b_all.get(k), a_bytes, b_bytes, a_len, b_len, piece) for k, text in enumerate(chunk)]
                yield _batch(batch.column(0).slice(start, stop - start), rows)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(align, schema)


def _batch(ids: pa.Array, rows: list) -> pa.RecordBatch:
    """Rows of (counts..., digest, link A ids, link B ids) as Arrow columns; the links as flat lists."""
    counts = np.asarray([r[:4] for r in rows], np.int64).reshape(-1, 4)
    offsets = pa.array(np.concatenate([[0], np.cumsum([len(r[5]) for r in rows])]).astype(np.int32))
    flat_a = np.concatenate([r[5] for r in rows] + [np.zeros(0, np.int32)]).astype(np.int32)
    flat_b = np.concatenate([r[6] for r in rows] + [np.zeros(0, np.int32)]).astype(np.int32)
    arrays = [ids, *(pa.array(counts[:, i]) for i in range(4)), pa.array([r[4] for r in rows], pa.string()),
              pa.ListArray.from_arrays(offsets, pa.array(flat_a)), pa.ListArray.from_arrays(offsets, pa.array(flat_b))]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "link_a", "link_b"])


def _spans(texts: list) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t) if isinstance(t, str) else 0
        if size >= BYTES_PER_BATCH:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _aligned(text, a_ids, b_ids, a_bytes, b_bytes, a_len, b_len, piece):
    nothing = (0, 0, 0, 0, "", np.zeros(0, np.int32), np.zeros(0, np.int32))
    if not text:
        return nothing
    target = (" " + text).encode("utf-8")
    a_arr, b_arr = np.asarray(a_ids, np.int64), np.asarray(b_ids, np.int64)
    a, b = ends(a_arr, a_len), ends(b_arr, b_len)
    if a is None or b is None or a[-1] != len(target) or b[-1] != len(target):
        return nothing
    if b"".join(map(a_bytes.__getitem__, a_ids)) != target or b"".join(map(b_bytes.__getitem__, b_ids)) != target:
        return nothing
    at_a, at_b = links(a, b, piece)
    n_groups, text_of_groups = groups(a_arr, a, b_arr, b)
    digest = hashlib.sha256(text_of_groups.encode()).hexdigest()
    return (len(a_ids), len(b_ids), n_groups, len(at_a), digest, a_arr[at_a], b_arr[at_b])


def alignment(docs: DataFrame, folder: str = TOKENIZERS, piece: int = PIECE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    texts = stored(aligned_texts(docs, folder, piece).withColumn("_row", F.monotonically_increasing_id()), "aligned")
    pairs = texts.select("_row", F.explode(F.arrays_zip("link_a", "link_b")).alias("l")).select("_row", F.col("l.link_a").alias("a"), F.col("l.link_b").alias("b"))
    counted = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("b").agg(F.max("n").alias("most"))
    table = stored(counted.join(best, "b").select("a", "b", "n", (F.col("n") == F.col("most")).cast("long").alias("best")), "link_counts")
    sums = pairs.join(small(table), ["a", "b"]).groupBy("_row").agg(F.sum("best").alias("n_best"), F.sum("n").alias("count_sum"))
    out = texts.drop("link_a", "link_b").join(sums, "_row", "left")
    return out.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"), F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256",
    )
