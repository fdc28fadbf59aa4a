import random

import pytest
from conftest import TESTDATA

from popscope.llm import near_dup
from popscope.llm.common import table
from popscope.llm.components import components
from popscope.llm.near_dup import near_duplicates, without_near_duplicates

from .conftest import ODD_DOCUMENTS, lower_ascii, shingles


def truth(rows):
    """Components by comparing every pair."""
    sets = [(d, shingles(lower_ascii(t or ""))) for d, t in rows]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return {d: find(d) for d, _ in sets}, {d: len(s) for d, s in sets}


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    component, count = truth(rows)
    found = near_duplicates(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.component_id, r.n_shingles, r.kept) == (component[r.doc_id], count[r.doc_id], component[r.doc_id] == r.doc_id), r


def test_given_table(spark):
    check(table(spark, TESTDATA, "documents"))


@pytest.mark.parametrize("pairs", [near_dup.ROUND_PAIRS, 10])
def test_families_of_edited_copies(spark, make, monkeypatch, pairs):
    """Chains of edits, near the threshold on both sides; also in many small rounds."""
    monkeypatch.setattr(near_dup, "ROUND_PAIRS", pairs)
    draw, rows = random.Random(4), []
    for family in range(4):
        text = [f"w{draw.randrange(500)}" for _ in range(draw.choice([4, 30, 60, 150]))]
        for _ in range(40):
            copy = list(text)
            for _ in range(draw.randint(0, max(1, len(text) // 25))):
                copy[draw.randrange(len(copy))] = f"n{draw.randrange(500)}"
            rows.append((len(rows) * 7 % 1000, " ".join(copy), None, None, None))
            if draw.random() < 0.4:
                text = copy
    check(make("documents", rows))


def test_odd_rows(spark, odd, clashing, empty):
    found = sorted(((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in near_duplicates(clashing).collect()))
    wanted = {"1": (3, 1, True), "2": (0, 2, True), "3": (0, 3, True), "4": (0, 4, True), "5": (3, 1, False), "6": (1, 6, True), "7": (1, 7, True),
              "8": (1, 8, True), "9": (1, 9, True), "None": (1, None, True)}
    assert found == sorted((str(d[0]), *wanted[str(d[0])]) for d in ODD_DOCUMENTS)
    left = without_near_duplicates(clashing)
    assert left.columns == clashing.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted({str(d[0]) for d in ODD_DOCUMENTS} - {"5"})
    assert near_duplicates(empty).collect() == [] and without_near_duplicates(empty).collect() == []


def test_repeated_rows_leave_one(make):
    rows = [(1, "a b c d e f", None, None, None)] * 3 + [(None, "x y", None, None, None)] * 2 + [(None, "a b c d e f", None, None, None)]
    left = without_near_duplicates(make("documents", rows)).collect()
    assert sorted((str(r.doc_id), r.text) for r in left) == [("1", "a b c d e f"), ("None", "x y")]


def test_signature_estimates_similarity():
    import numpy as np

    draw = np.random.default_rng(0)
    values = draw.integers(0, 1 << 63, 1500, dtype=np.uint64)
    agree = np.mean(near_dup.signature(values[:1000]) == near_dup.signature(values[250:1250]))
    assert abs(agree - 0.6) < 0.15
    least = near_dup.least_matches()
    assert all(least[n] < 0.75 * n for n in least) and least[128] > 60


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, 500), (2, 500), (3, 3), (700, 600), (600, 650)]
    draw = random.Random(1)
    edges = [e if draw.random() < 0.5 else e[::-1] for e in edges]
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, 1: 1, 2: 1, 500: 1, 600: 600, 650: 600, 700: 600}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_id_on_two_texts(make):
    from popscope.llm.near_dup import near_duplicates, without_near_duplicates

    b = " ".join(f"b{i}" for i in range(60))
    a = " ".join(f"a{i}" for i in range(60))
    rows = [(3, b, "en", "s", 1), (5, a, "en", "s", 1), (5, b + " extra", "en", "s", 1), (9, "short text", "en", "s", 1)]
    docs = make("documents", rows)
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect())
    assert got == [(3, 3, True), (5, 3, False), (5, 5, True), (9, 9, True)]
    left = sorted((r.doc_id, r.text) for r in without_near_duplicates(docs).collect())
    assert left == [(3, b), (5, a), (9, "short text")]
