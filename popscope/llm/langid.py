"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text in both directions, labels every byte with a language, and a document's
probabilities are the means over all its bytes. It is trained in numpy by backpropagation
through time, on a bounded sample: up to ``DOCS`` documents of each language, those with the
smallest hashes of their ids, ``PIECES`` pieces of each at hashed places, ``SAMPLE`` pieces at most.
Texts of any length are read whole, in segments of ``SEGMENT`` bytes that begin anew.

A text that is null or has no letter is ``und``, with score 0. So is every text where there is
nothing to learn from. Null languages are not learned; a null id is never learned from and never
held out. Repeated rows are rows of their own. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popscope.llm.common import released, small, stored
from popscope.llm.shingles import text_blocks

UNKNOWN = "und"
DOCS, PIECES, SAMPLE = 300, 3, 12_000  # of the training sample: documents per language, pieces per document, pieces in all
HIDDEN = 8
PIECE = 64  # bytes of a training piece
SEGMENT = 128  # bytes that the trained network reads in one go
TOGETHER = 512  # segments read side by side (state arrays of about 2 MB each)
PAD = 256
STEPS, BATCH, RATE = 400, 64, 0.02
LETTER = r"\p{L}"


@dataclass
class Network:
    """``table``: what a byte adds to the gates (direction, byte, gate, unit); ``loop``: what the state adds."""

    languages: list[str]
    table: np.ndarray
    loop: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def states(self, ids: np.ndarray, direction: int) -> np.ndarray:
        """State after every byte (time, segment, unit); a pad leaves the state as it is."""
        table = np.ascontiguousarray(self.table[direction].transpose(1, 0, 2))
        loop = self.loop[direction]
        time, size = ids.shape
        all_, h = np.empty((time, size, HIDDEN), np.float32), np.zeros((size, HIDDEN), np.float32)
        added, reset, update, new = (np.empty((size, HIDDEN), np.float32) for _ in range(4))
        for t in range(time) if direction == 0 else reversed(range(time)):
            for gate, into in ((0, reset), (1, update)):
                np.matmul(h, loop[gate], out=into)
                into += np.take(table[gate], ids[t], axis=0, out=added, mode="clip")
                np.tanh(into, out=into)
                into *= 0.5
                into += 0.5
            np.matmul(h, loop[2], out=new)
            new *= reset
            new += np.take(table[2], ids[t], axis=0, out=added, mode="clip")
            np.tanh(new, out=new)
            new -= h
            new *= update
            h += new
            all_[t] = h
        return all_

    def position_probabilities(self, ids: np.ndarray) -> np.ndarray:
        """Probability of each language at every byte (time, segment, language)."""
        scores = self.states(ids, 0) @ self.out[:HIDDEN] + self.states(ids, 1) @ self.out[HIDDEN:] + self.bias
        scores -= scores.max(axis=2, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=2, keepdims=True)
        return scores

    def document_probabilities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean over all bytes of every text of a block (text, language); 0 for empty texts."""
        lengths = np.diff(offsets)
        pieces = -(-lengths // SEGMENT)
        owner = np.repeat(np.arange(len(lengths)), pieces)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = offsets[owner] + place * SEGMENT
        left = np.minimum(offsets[owner + 1] - start, SEGMENT)
        total = np.zeros((len(lengths), len(self.languages)))
        step = np.arange(SEGMENT)[:, None]
        for a in range(0, len(owner), TOGETHER):
            at, n = start[a : a + TOGETHER], left[a : a + TOGETHER]
            inside = step[: n.max()] < n
            ids = np.where(inside, data[np.minimum(at + step[: n.max()], len(data) - 1)], PAD).astype(np.intp)
            likely = (self.position_probabilities(ids) * inside[:, :, None]).sum(axis=0)
            np.add.at(total, owner[a : a + TOGETHER], likely)
        return total / np.maximum(lengths, 1)[:, None]


def train(pieces: list[bytes], labels: list[str], seed: int = 1) -> Network | None:
    """A network of the pieces' languages; None without pieces."""
    languages = sorted(set(labels))
    if not languages:
        return None
    draw = np.random.default_rng(seed)
    table = draw.normal(0, 0.3, (2, 257, 3, HIDDEN))
    table[:, PAD] = 0.0
    table[:, PAD, 1] = -30.0  # the update gate shuts
    loop = draw.normal(0, HIDDEN**-0.5, (2, 3, HIDDEN, HIDDEN))
    out, bias = draw.normal(0, 0.3, (2 * HIDDEN, len(languages))), np.zeros(len(languages))
    weights = [table, loop, out, bias]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    ids = np.full((len(pieces), PIECE), PAD, np.intp)
    for row, piece in zip(ids, pieces):
        row[: len(piece)] = np.frombuffer(piece[:PIECE], np.uint8)
    wanted = np.array([languages.index(label) for label in labels])
    order = np.zeros(0, int)
    for step in range(1, STEPS + 1):
        if len(order) < BATCH:
            order = np.concatenate([order, draw.permutation(len(ids))])
        chosen, order = order[:BATCH], order[BATCH:]
        slopes = _slopes(weights, ids[chosen].T, wanted[chosen])
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for w, slope, m, v in zip(weights, slopes, first, second):
            m += 0.1 * (slope - m)
            v += 0.01 * (slope * slope - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    table[:, PAD] = 0.0
    table[:, PAD, 1] = -30.0
    return Network(languages, *(w.astype(np.float32) for w in weights))


def _slopes(weights: list[np.ndarray], ids: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross entropy over all bytes; both directions run side by side."""
    table, loop, out, bias = weights
    time, size = ids.shape
    both = np.stack([ids, ids[::-1]])  # direction, time, piece
    added = np.stack([table[d][both[d]] for d in range(2)])  # direction, time, piece, gate, unit
    shape = (time, 2, size, HIDDEN)
    old, reset, update, new, turned = (np.empty(shape) for _ in range(5))
    h = np.zeros(shape[1:])
    states = np.empty(shape)
    for t in range(time):
        old[t] = h
        reset[t] = 0.5 + 0.5 * np.tanh(h @ loop[:, 0] + added[:, t, :, 0])
        update[t] = 0.5 + 0.5 * np.tanh(h @ loop[:, 1] + added[:, t, :, 1])
        turned[t] = h @ loop[:, 2]
        new[t] = np.tanh(reset[t] * turned[t] + added[:, t, :, 2])
        h = h + update[t] * (new[t] - h)
        states[t] = h
    seen = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)
    scores = seen @ out + bias
    scores = np.exp(scores - scores.max(axis=2, keepdims=True))
    scores /= scores.sum(axis=2, keepdims=True)
    inside = (ids != PAD)[:, :, None]
    scores[:, np.arange(size), wanted] -= 1
    scores *= inside / max(1, inside.sum())
    flat = scores.reshape(-1, scores.shape[2])
    d_out, d_bias = seen.reshape(-1, 2 * HIDDEN).T @ flat, flat.sum(axis=0)
    d_seen = scores @ out.T
    d_states = np.stack([d_seen[:, :, :HIDDEN], d_seen[::-1, :, HIDDEN:]], axis=1)
    d_added, d_loop, d_h = np.empty((time, 2, size, 3, HIDDEN)), np.zeros_like(loop), np.zeros(shape[1:])
    backwards = loop.transpose(0, 1, 3, 2)
    for t in reversed(range(time)):
        d_h = d_h + d_states[t]
        d_new = d_h * update[t] * (1 - new[t] ** 2)
        d_update = d_h * (new[t] - old[t]) * 2 * update[t] * (1 - update[t])
        d_reset = d_new * turned[t] * 2 * reset[t] * (1 - reset[t])
        d_turned = d_new * reset[t]
        before = old[t].transpose(0, 2, 1)
        for gate, d in enumerate((d_reset, d_update, d_turned)):
            d_loop[:, gate] += before @ d
        d_h = d_h * (1 - update[t]) + d_reset @ backwards[:, 0] + d_update @ backwards[:, 1] + d_turned @ backwards[:, 2]
        for gate, d in enumerate((d_reset, d_update, d_new)):
            d_added[t, :, :, gate] = d
    d_table = np.zeros_like(table)
    for d in range(2):
        np.add.at(d_table[d], both[d].ravel(), d_added[:, d].reshape(-1, 3, HIDDEN))
    d_table[:, PAD] = 0
    return [d_table, d_loop, d_out, d_bias]


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """A network learned from the documents that are not held out and have a language."""
    narrow = docs.select(F.col(id).alias("doc_id"), F.col(lang).alias("lang"))
    narrow = narrow.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    hashed = narrow.distinct().withColumn("h", F.xxhash64("doc_id"))
    # Of a frequent language only small hashes can be among the first; the others need not meet.
    rows = stored(hashed.groupBy(F.col("lang").alias("of")).count(), "languages")
    bound = F.least(F.lit(1.0), F.lit(4.0 * DOCS) / F.col("count")) * float(1 << 63) * 2 - float(1 << 63)
    hashed = hashed.join(small(rows), F.col("lang") == F.col("of")).where(F.col("h") <= bound).select("doc_id", "lang", "h")
    ranked = hashed.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id")))
    chosen = ranked.where(F.col("k") <= DOCS).orderBy("k", "lang").limit(SAMPLE // PIECES)
    # At most SAMPLE / PIECES rows of an id and a language.
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("of"), F.col("lang").alias("said"), "h", "k"))
    bodies = docs.select(F.col(id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("body"))
    bodies = bodies.join(chosen, (F.col("doc_id") == F.col("of")) & (F.col("lang") == F.col("said"))).where(F.regexp_like("body", F.lit(LETTER)))
    place = lambda i: F.pmod(F.xxhash64("h", F.lit(i)), F.greatest(F.length("body") - PIECE, F.lit(1))).cast("int") + 1
    piece = F.explode(F.array(*(F.substring(F.col("body"), place(i), F.lit(PIECE)) for i in range(PIECES))))
    pieces = bodies.select("k", "lang", "doc_id", piece.alias("piece")).orderBy("k", "lang", "doc_id", "piece").limit(SAMPLE).collect()
    return train([row["piece"].encode() for row in pieces], [row["lang"] for row in pieces])


def _labels(network: Network | None, texts: pa.Array, has_letter: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of every text."""
    langs, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
    known = np.array([bool(x) for x in has_letter.to_pylist()], bool)
    if network is not None and known.any():
        rows = np.flatnonzero(known)
        for row, data, offsets in text_blocks(texts.filter(pa.array(known))):
            likely = network.document_probabilities(data, offsets)
            best = likely.argmax(axis=1)
            at = rows[row : row + len(best)]
            langs[at] = np.array(network.languages, object)[best]
            scores[at] = np.minimum(likely[np.arange(len(best)), best], 1.0)
    return langs, scores


def predict(docs: DataFrame, network: Network | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = _labels(network, batch.column(2), batch.column(3))
            arrays = [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id).alias("doc_id"), held_out(F.col(id)).alias("held_out"), F.col(text).alias("body"), F.regexp_like(text, F.lit(LETTER)).alias("letter"))
    kind = docs.schema[id].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify_languages(docs: DataFrame, **columns) -> DataFrame:
    """``fit`` and ``predict`` on one table."""
    return predict(docs, fit(docs, **columns), **{k: v for k, v in columns.items() if k != "lang"})


def in_a_language(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without those of no known language; all columns stay, and no row leaves its task.

    Where there is nothing to learn from, only null texts and texts without a letter go.
    """
    network, at = fit(docs), docs.columns.index(text)
    names = [f"_{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names).withColumn("letter", F.regexp_like(names[at], F.lit(LETTER)))

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if network is None:
                yield batch.select(names).filter(batch.column(len(names)))
                continue
            langs, _ = _labels(network, batch.column(at), batch.column(len(names)))
            yield batch.select(names).filter(pa.array(langs != UNKNOWN))

    schema = ", ".join(f"{name} {kind}" for name, kind in docs.toDF(*names).dtypes)
    return rows.mapInArrow(run, schema).toDF(*docs.columns)
