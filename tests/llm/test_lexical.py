"""Reversed lexical search against a plain scoring of every (item, document) pair."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from popscope.llm import lexical
from popscope.llm.lexical import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(str.maketrans(lexical.UPPER, lexical.LOWER)))


def brute(docs, items, top=20):
    n_docs = sum(1 for _, t in docs if terms(t))
    n_terms = sum(len(terms(t)) for _, t in docs)
    df = Counter(w for _, t in docs for w in set(terms(t)))
    out = []
    for item, q in items:
        scores = []
        for doc, t in docs:
            tf, n = Counter(terms(t)), len(terms(t))
            if not n:
                continue
            m = 75 + (25 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 12 * m)) for w in terms(q) if tf[w])
            if s > 0:
                scores.append((-s, math.inf if doc is None else doc, doc, s))
        for rank, (_, _, doc, s) in enumerate(sorted(scores, key=lambda e: e[:2])[:top], 1):
            out.append((item, rank, doc, s))
    return sorted(out, key=lambda r: (r[0], r[1]))


def found(docs, items, top=20):
    return sorted((r.item_id, r.rank, r.doc_id, r.score) for r in ranked(docs, items, top).collect())


def test_odd_rows_against_brute_force(make, odd):
    from tests.llm.conftest import ODD_DOCUMENTS

    items = [(1, "A b c word"), (2, "Straße über"), (3, None), (4, "nothing matches zzz"), (5, "word word x")]
    got = found(odd, make("benchmark", items), top=3)
    docs = [(d, t) for d, t, *_ in ODD_DOCUMENTS]
    assert got == brute(docs, items, top=3)
    assert {r[0] for r in got} == {1, 2, 5}


def test_ties_repeats_and_blocks(make, monkeypatch):
    docs = [(i, "alpha beta gamma") for i in (9, 3, 5)] + [(3, "alpha beta gamma"), (None, "alpha beta gamma"), (7, "ALPHA delta")]
    table = make("documents", [(d, t, None, None, None) for d, t in docs])
    items = [(i, "alpha gamma") for i in range(6)]
    monkeypatch.setattr(lexical, "INDEX_ROWS", 3)  # several passes of items
    got = found(table, make("benchmark", items), top=4)
    assert got == brute(docs, items, top=4)
    assert [r[2] for r in got if r[0] == 0] == [3, 3, 5, 9]


def test_empty_and_clashing(make, empty, clashing):
    items = make("benchmark", [(1, "a b")])
    assert ranked(empty, items).count() == 0
    assert ranked(clashing, make("benchmark", [])).count() == 0
    assert ranked(clashing.withColumn("rank", F.lit(1)), items).columns == ["item_id", "rank", "doc_id", "score"]
