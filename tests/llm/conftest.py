from __future__ import annotations

import pytest

from popscope.llm.common import SCHEMAS

SPACE = "\t\n\x0b\x0c\r "


@pytest.fixture(scope="session")
def make(spark):
    """A table of the given name from rows."""

    def build(name, rows, parts=3):
        return spark.createDataFrame(rows, SCHEMAS[name]).repartition(parts)

    return build


ODD_DOCUMENTS = [
    (1, "a b c d e f g", "en", "s1", 13),
    (2, None, None, None, None),
    (3, "", "de", "s2", 0),
    (4, " \n\t", "de", "s2", 3),
    (5, "a b c d e f g", "en", "s1", 13),
    (5, "a b c d e f g", "en", "s1", 13),
    (6, "über der Straße läuft", "de", None, 20),
    (7, "word " * 30_000, "en", "s1", 150_000),
    (None, "no id here at all", "en", "s3", 17),
    (8, "x", "fr", "s3", 1),
    (9, "日本語のテキスト 🙂 emoji", "fr", "s3", 16),
]


@pytest.fixture(scope="session")
def odd(make):
    return make("documents", ODD_DOCUMENTS)


@pytest.fixture(scope="session")
def empty(make):
    return make("documents", [])


@pytest.fixture(scope="session")
def clashing(spark, odd):
    """Extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ["size", "u", "q", "bin", "p", "target", "shard", "position", "body", "part", "base", "row", "key", "score", "of", "draw", "component_id", "copies"]
    return odd.select("*", *(F.lit(1).alias(name) for name in names))


def words(text):
    out, current = [], ""
    for c in text or "":
        if c in SPACE:
            if current:
                out.append(current)
            current = ""
        else:
            current += c
    return [*out, current] if current else out


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, n=5):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0
