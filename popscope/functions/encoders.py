"""Text encoders: a batch of strings in, one float vector per string out.

An encoder is any picklable object with ``name``, ``dim``, ``batch_size``,
``passage_prefix``, ``query_prefix`` and ``encode(texts)``, which returns a
float32 matrix with one unit-length row per text. It is shipped to the tasks, so a
model should be loaded on the first call in a worker and not in the constructor.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np


class Encoder(Protocol):
    name: str  # of the model and its version: vectors of different names are never mixed
    dim: int
    batch_size: int
    passage_prefix: str
    query_prefix: str

    def encode(self, texts: Sequence[str]) -> np.ndarray: ...


@dataclass(frozen=True)
class NgramEncoder:
    """Signed counts of hashed character trigrams, at unit length.

    It needs no model and is the same everywhere, but it matches wording and not
    meaning. Whole texts are encoded. A text without a trigram gives zeros.
    """

    name: str = "hashed trigrams 1"
    # Width, batch size and prefixes of the index format.
    dim: int = 384
    batch_size: int = 32
    passage_prefix: str = "passage: "
    query_prefix: str = "query: "

    def encode(self, texts: Sequence[str]) -> np.ndarray:
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        row = np.repeat(np.arange(len(texts)), lengths)
        inside = row[:-2] == row[2:]  # trigrams that lie within one text
        mixed = (points[:-2] * 7919 + points[1:-1] * 104729 + points[2:] * 1299709)[inside]
        bucket = mixed % 1000003 % self.dim
        sign = 1 - 2 * (mixed // 1000003 % 2)
        place = row[:-2][inside] * self.dim + bucket
        counts = np.bincount(place, weights=sign, minlength=len(texts) * self.dim).reshape(len(texts), self.dim)
        norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        return np.divide(counts, norms, out=counts, where=norms > 0).astype(np.float32)
