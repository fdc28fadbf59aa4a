"""Jaccard join of 4-word shingle sets against all pairs and plain components."""

import random
from pathlib import Path

import numpy as np

from popscope.llm.jaccard_join import jaccard_components, least_difference, parity_mask
from tests.llm.conftest import ODD_DOCUMENTS, words


def shingles(text):
    w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in words(text)]
    if not w:
        return set()
    if len(w) < 4:
        return {" ".join(w)}
    return {" ".join(w[i : i + 4]) for i in range(len(w) - 3)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                parent[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        if sets[i]:
            groups.setdefault(find(i), []).append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for d in groups.get(find(i), []) if d is not None]
        out.append((doc, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc))
    return sorted(out, key=repr)


def corpus(seed=5):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    rows, doc = [], 0
    for base in range(12):
        text = [rng.choice(vocab) for _ in range(rng.randint(10, 120))]
        for copy in range(rng.choice([1, 2, 3, 40])):
            edited = list(text)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                edited[rng.randrange(len(edited))] = rng.choice(vocab)
            rows.append((doc, " ".join(edited)))
            doc += 1
    # A chain: each step near the last, the ends far apart.
    chain = [rng.choice(vocab) for _ in range(200)]
    for _ in range(8):
        chain[rng.randrange(200)] = rng.choice(vocab)
        rows.append((doc, " ".join(chain)))
        doc += 1
    return rows


def found(make, rows):
    table = make("documents", [(d, t, None, None, None) for d, t in rows])
    return sorted((tuple(r) for r in jaccard_components(table).collect()), key=repr)


def test_against_all_pairs(make):
    rows = corpus()
    assert found(make, rows) == brute(rows)


def test_odd_rows(make):
    rows = [(d, t) for d, t, *_ in ODD_DOCUMENTS] + [(3, "a b c d e f g x"), (10, "a b c d e f g x")]
    got = found(make, rows)
    assert got == brute(rows)
    assert (2, 0, 2) in got and (None, 4, 1) not in got


def test_empty_and_clashing(empty, clashing):
    assert jaccard_components(empty).count() == 0
    assert jaccard_components(clashing).count() == clashing.count()


def test_sets_are_not_stored(spark, make):
    """Unlinked texts leave less on disk than their shingles' hashes take; only near pairs need full sets."""
    rng = random.Random(1)
    rows = [(i, " ".join(str(rng.random()) for _ in range(2000))) for i in range(30)]
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.rglob("*.parquet"))
    assert found(make, rows) == sorted(((i, 1997, i) for i in range(30)), key=repr)
    left = sum(p.stat().st_size for p in set(folder.rglob("*.parquet")) - before if p.is_file())
    assert left < 8 * 1997 * 30


def test_mask_bound():
    rng = np.random.default_rng(3)
    for n, m, both in ((1, 1, 0), (1, 1, 1), (40, 33, 30), (500, 900, 450), (2000, 1800, 1790)):
        x = rng.integers(0, 1 << 63, n + m - both, dtype=np.uint64)
        masks = [np.unpackbits(np.frombuffer(parity_mask(np.sort(s)), np.uint8)) for s in (x[:n], x[n - both :])]
        difference = n + m - 2 * both
        assert least_difference(*masks) <= difference and (least_difference(*masks) > 0) == (difference > 0)
