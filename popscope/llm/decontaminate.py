"""Benchmark decontamination under edit distance.

An item of n words is found in a text if a window of n words of it (the whole text, if it is
shorter) is at most n // 4 word edits away. Words are compared with A-Z in lower case.

Windows and items are embedded by random walks (CGK): the walk writes the word it stands on and
then goes on or stays by a random bit of step and word, so that texts few edits apart walk alike
again soon after each edit, and the edit distance becomes a Hamming distance. Of each walk a few
places are sampled as the key under which items are looked up; walk and places are drawn anew
``REPEATS`` times. Pairs that share a key are verified by their exact edit distance. The longer an
item and the more edits, the less walks agree, so no number of keys finds every pair: the
windows that share none are verified too, but for those that a neighbour's distance rules out.

Which windows are looked at: only those that can be near. k edits leave at least n + 1 - q - qk of an item's
q-word runs whole, and none is more than k places off. A window with fewer common runs is
further away, so passing it over loses nothing.

Items travel with the tasks, in blocks of a bounded number of words; each block is a pass over
the texts. Null and empty items are in no text; null and empty texts hold none. Repeated rows are
found one by one. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscope.llm.shingles import joined, mixed, text_blocks, word_hashes

ALLOWED = 4  # one edit per so many words of the item
SAMPLED = 2  # places of a walk that make a key
AGREE = 0.4  # share of places at which walks of a pair agree, for items of some 30 words at the largest distance
RECALL = 0.99  # share of such pairs that share a key; the others are found without
REPEATS = math.ceil(math.log(1 - RECALL) / math.log(1 - AGREE**SAMPLED))
BLOCK_WORDS = 2_000_000  # item words that travel with the tasks at once
WINDOWS = 2048  # windows looked up at once
WALKED = 1 << 18  # words of walks held at once
_BLOOM = 20  # bits of a run's hash that are looked up first


def words_of(texts: list[str | None]) -> list[np.ndarray]:
    """The word hashes of each text."""
    out = []
    for _, data, offsets in text_blocks(pa.array(texts, pa.string())):
        words, ends = word_hashes(data, offsets)
        out += [words[a:b] for a, b in zip(ends[:-1], ends[1:])]
    return out


def edit_distance(masks: dict[int, int], n: int, text: np.ndarray) -> int:
    """Levenshtein distance of ``text`` to the item of ``n`` words whose places ``masks`` tells by word.

    Bit-parallel: differences of neighbouring cells of a column are two bit vectors.
    """
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, distance = full, 0, n
    for word in text.tolist():
        same = masks.get(word, 0)
        vertical = same | down
        horizontal = (((same & up) + up) ^ up) | same
        rise = (down | ~(horizontal | up)) & full
        fall = up & horizontal
        distance += bool(rise & top) - bool(fall & top)
        rise, fall = (rise << 1 | 1) & full, (fall << 1) & full
        up, down = (fall | ~(vertical | rise)) & full, rise & vertical
    return distance


def walk_keys(windows: np.ndarray, n: int, repeats: int = REPEATS) -> np.ndarray:
    """Keys (windows x repeats) of windows of up to ``n`` word hashes, 0 where a window has ended."""
    steps = 2 * n
    draw = np.random.default_rng(n)
    places = draw.integers(0, steps, (repeats, SAMPLED))
    salts = mixed(np.arange(1, steps * repeats + 1, dtype=np.uint64).reshape(steps, repeats))
    keys, together = np.empty((len(windows), repeats), np.uint64), max(1, WALKED // (steps * repeats))
    for begin in range(0, len(windows), together):
        part = slice(begin, begin + together)
        keys[part] = _walked_keys(windows[part], n, places, salts)
    return keys


def _walked_keys(windows: np.ndarray, n: int, places: np.ndarray, salts: np.ndarray) -> np.ndarray:
    steps, repeats = salts.shape
    padded = np.concatenate([windows, np.zeros((len(windows), 1), np.uint64)], axis=1)
    rows, at = np.arange(len(windows))[:, None], np.zeros((len(windows), repeats), np.int64)
    walked = np.empty((steps, len(windows), repeats), np.uint64)
    for step in range(steps):
        word = padded[rows, at]
        walked[step] = word
        at = np.minimum(at + (mixed(word ^ salts[step]) & np.uint64(1)).astype(np.int64), n)
    key = np.broadcast_to(mixed(np.arange(1, repeats + 1, dtype=np.uint64)), (len(windows), repeats))
    for i in range(SAMPLED):
        key = mixed(key ^ walked[places[:, i], :, np.arange(repeats)].T)
    return key


class Items:
    """A block of benchmark items, prepared for lookup."""

    def __init__(self, ids: list, texts: list[str | None]):
        words = words_of(texts)
        kept = [i for i, w in enumerate(words) if len(w)]
        self.ids, self.words = [ids[i] for i in kept], [words[i] for i in kept]
        self.n = np.array([len(w) for w in self.words], np.int64)
        self.k = self.n // ALLOWED
        self.run = np.where(self.n >= 9, 3, np.where(self.n >= 3, 2, 1))
        self.need = self.n + 1 - self.run - self.run * self.k
        self.masks = []
        for w in self.words:
            masks = defaultdict(int)
            for i, word in enumerate(w.tolist()):
                masks[word] |= 1 << i
            self.masks.append(dict(masks))
        self.runs = {}
        for q in sorted(set(self.run.tolist())):
            of = np.flatnonzero(self.run == q)
            hashes = [joined(self.words[i], q) for i in of]
            key = np.concatenate(hashes)
            item = np.repeat(of, [len(h) for h in hashes])
            place = np.concatenate([np.arange(len(h)) for h in hashes])
            order = np.argsort(key, kind="stable")
            seen = np.zeros(1 << _BLOOM, bool)
            seen[key >> np.uint64(64 - _BLOOM)] = True
            self.runs[q] = key[order], item[order], place[order], seen
        self.keys = {}
        for n in sorted(set(self.n.tolist())):
            of = np.flatnonzero(self.n == n)
            key = walk_keys(np.stack([self.words[i] for i in of]), n)
            order = np.argsort(key.ravel(), kind="stable")
            self.keys[n] = key.ravel()[order], np.repeat(of, key.shape[1])[order]

    def windows(self, words: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """(text, item, start) of the windows of a block of texts that may be near an item, in order."""
        found = [np.zeros((0, 3), np.int64)]
        for q, (keys, items, places, seen) in self.runs.items():
            if len(words) < q:
                continue
            run = joined(words, q)
            at = np.flatnonzero(seen[run >> np.uint64(64 - _BLOOM)])
            low = np.searchsorted(keys, run[at], side="left")
            times = np.searchsorted(keys, run[at], side="right") - low
            at, low, times = at[times > 0], low[times > 0], times[times > 0]
            if not len(at):
                continue
            entry = np.repeat(low, times) + _counted(times)
            at = np.repeat(at, times)
            text = np.searchsorted(ends, at, side="right") - 1
            inside = at + q <= ends[text + 1]
            at, text, item, place = at[inside], text[inside], items[entry[inside]], places[entry[inside]]
            shift = at - place - ends[text]
            order = np.lexsort((shift, item, text))
            text, item, shift = text[order], item[order], shift[order]
            # As many common runs as needed within 2k shifts: from the i-th to the (i + need - 1)-th.
            last = np.arange(len(text)) + self.need[item] - 1
            there = last < len(text)
            i, j = np.flatnonzero(there), last[there]
            k = self.k[item[i]]
            near = (text[i] == text[j]) & (item[i] == item[j]) & (shift[j] - shift[i] <= 2 * k)
            i, j, k = i[near], j[near], k[near]
            most = np.maximum(ends[text[i] + 1] - ends[text[i]] - self.n[item[i]], 0)
            first, final = np.clip(shift[j] - k, 0, most), np.clip(shift[i] + k, 0, most)
            spread = final - first + 1
            start = np.repeat(first, spread) + _counted(spread)
            found.append(np.unique(np.stack([np.repeat(text[i], spread), np.repeat(item[i], spread), start], axis=1), axis=0))
        return np.unique(np.concatenate(found), axis=0)

    def near(self, windows: list[np.ndarray], n: int) -> Iterator[tuple[int, int, int]]:
        """(window, item, distance) of the pairs that share a key and are near enough."""
        keys, items = self.keys[n]
        for begin in range(0, len(windows), WINDOWS):
            part = windows[begin : begin + WINDOWS]
            matrix = np.zeros((len(part), n), np.uint64)
            for row, w in zip(matrix, part):
                row[: len(w)] = w
            asked = walk_keys(matrix, n)
            low = np.searchsorted(keys, asked.ravel(), side="left")
            times = np.searchsorted(keys, asked.ravel(), side="right") - low
            window = np.repeat(np.repeat(np.arange(len(part)), asked.shape[1]), times)
            item = items[np.repeat(low, times) + _counted(times)]
            for w, i in np.unique(np.stack([window, item], axis=1), axis=0).tolist():
                distance = edit_distance(self.masks[i], n, part[w])
                if distance <= self.k[i]:
                    yield begin + w, i, distance

    def nearest(self, i: int, words: np.ndarray, starts: np.ndarray, best: tuple[int, int] | None) -> tuple[int, int] | None:
        """The least distance of item ``i`` and the first start that has it, among ``starts`` and ``best``; None if none is near.

        One start further changes the distance by 2 at most, so starts that cannot come down to the best are left out.
        """
        n, near, at = int(self.n[i]), int(self.k[i]), 0
        while at < len(starts):
            start = int(starts[at])
            distance = edit_distance(self.masks[i], n, words[start : start + n])
            if distance <= near:
                best = min(best or (n, 0), (distance, start))
            off = distance - (best[0] if best else near)
            at = int(np.searchsorted(starts, start + max(1, (off + 1) // 2)))
        return best

    def found(self, column: pa.Array) -> dict[int, dict[int, tuple[int, int]]]:
        """By row of a text column and item: the least distance and the first start that has it."""
        waiting, pairs = defaultdict(list), []
        for row, data, offsets in text_blocks(column):
            words, ends = word_hashes(data, offsets)
            windows = self.windows(words, ends)
            text, item, start = windows.T
            for t, n, s in np.unique(np.stack([text, self.n[item], start], axis=1), axis=0).tolist():
                waiting[n].append((row + t, s, words[ends[t] + s : min(ends[t] + s + n, ends[t + 1])]))
            cuts = np.flatnonzero((np.diff(text) != 0) | (np.diff(item) != 0)) + 1
            for group in np.split(windows, cuts) if len(windows) else []:
                t, i = group[0, :2].tolist()
                pairs.append((row + t, i, words[ends[t] : ends[t + 1]], group[:, 2]))
        best = defaultdict(dict)
        for n, held in waiting.items():
            for w, i, distance in self.near([h[2] for h in held], n):
                row, start, _ = held[w]
                best[row][i] = min(best[row].get(i, (n, 0)), (distance, start))
        for row, i, words, starts in pairs:
            nearest = self.nearest(i, words, starts, best[row].get(i) if row in best else None)
            if nearest is not None:
                best[row][i] = nearest
        return best


def _counted(times: np.ndarray) -> np.ndarray:
    """0, 1, ... anew for every entry of ``times``."""
    total = np.cumsum(times)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - times, times)


def item_blocks(items: DataFrame, id: str = "item_id", text: str = "text") -> Iterator[Items]:
    """The query set, which the driver reads row by row, in blocks of bounded size."""
    ids, texts, size = [], [], 0
    for row in items.select(id, text).orderBy(id, text).toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len((row[1] or "").split())
        if size >= BLOCK_WORDS:
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Items(ids, texts)


def contaminated(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """One row per text and item found in it: doc_id, item_id, distance (word edits), start_word, item_words."""
    kinds = docs.schema[id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, start_word long, item_words int"
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("body"))
    out = rows.sparkSession.createDataFrame([], schema)
    item_type = to_arrow_type(items.schema[item_id].dataType)
    for block in item_blocks(items, item_id):
        out = out.unionByName(rows.mapInArrow(_reported(block, item_type), schema))
    return out


def _reported(items: Items, item_type: pa.DataType = pa.int64()):
    """Found (row, item) pairs; item ids are built with the item column's own type."""

    def run(batches):
        for batch in batches:
            rows = [
                (row, items.ids[i], distance, start, int(items.n[i]))
                for row, by_item in items.found(batch.column(1)).items()
                for i, (distance, start) in sorted(by_item.items())
            ]
            columns = list(zip(*rows)) or [()] * 5
            ids = batch.column(0).take(pa.array(columns[0], pa.int64()))
            rest = [pa.array(columns[1], item_type), *(pa.array(c, t) for c, t in zip(columns[2:], (pa.int32(), pa.int64(), pa.int32())))]
            yield pa.RecordBatch.from_arrays([ids, *rest], names=["doc_id", "item_id", "distance", "start_word", "item_words"])

    return run


def without_items(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds an item; all columns stay. No row leaves its task."""
    at = docs.columns.index(text)

    def dropping(block):
        def run(batches):
            for batch in batches:
                bad = list(block.found(batch.column(at)))
                keep = np.ones(batch.num_rows, bool)
                keep[bad] = False
                yield batch.filter(pa.array(keep))

        return run

    for block in item_blocks(items):
        docs = docs.mapInArrow(dropping(block), docs.schema)
    return docs
