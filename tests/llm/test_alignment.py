"""Alignment of two tokenizers against plain all-pairs overlap on small texts."""

import hashlib
from collections import Counter

import numpy as np

from popscope.llm.alignment import A_FILE, TOKENIZERS, alignment, links, split, tokenizers

TEXTS = [
    (1, "Hello  world<|endoftext|> über  ok"),
    (2, None),
    (3, ""),
    (4, "a\tb\n\nc  "),
    (5, "日本語🙂 <s></s> [INST] done"),
    (5, "日本語🙂 <s></s> [INST] done"),
    (None, "no id here"),
    (6, "word " * 3000),
    (7, "the the the cat"),
]


def spans(ids, table):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(table[i])))
        at += len(table[i])
    return out


def json_a(texts):
    """A by the tokenizer file itself, special strings as plain text."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{TOKENIZERS}/{A_FILE}")
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([" " + x for x in texts], add_special_tokens=False)]


def brute(rows):
    _, a_bytes, encode_b, b_bytes = tokenizers(TOKENIZERS)
    encode_a = json_a
    per, counts = [], Counter()
    for doc, text in rows:
        if not text:
            per.append((doc, 0, 0, 0, [], ""))
            continue
        a_ids, b_ids = encode_a([text])[0], encode_b([text])[0]
        sa, sb = spans(a_ids, a_bytes), spans(b_ids, b_bytes)
        pairs = [(a_ids[i], b_ids[j]) for i, x in enumerate(sa) for j, y in enumerate(sb) if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({e for _, e in sa} & {e for _, e in sb})
        text_of = ";".join(
            ",".join(str(a_ids[i]) for i, x in enumerate(sa) if lo < x[1] <= hi) + "|" + ",".join(str(b_ids[j]) for j, y in enumerate(sb) if lo < y[1] <= hi)
            for lo, hi in zip([0, *cuts], cuts)
        )
        counts.update(pairs)
        per.append((doc, len(a_ids), len(b_ids), len(cuts), pairs, hashlib.sha256(text_of.encode()).hexdigest()))
    most = {}
    for (a, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    rows = [(doc, na, nb, ng, len(p), sum(counts[x] == most[x[1]] for x in p), sum(counts[x] for x in p), h) for doc, na, nb, ng, p, h in per]
    return sorted(rows, key=repr)


def test_against_all_pairs(make):
    docs = make("documents", [(d, t, None, None, None) for d, t in TEXTS])
    got = sorted((tuple(r) for r in alignment(docs, piece=7).collect()), key=repr)
    assert got == brute(TEXTS)
    assert [r for r in got if r[0] == 2][0][1:] == (0, 0, 0, 0, 0, 0, "")


def test_merge_path_pieces_agree():
    rng = np.random.default_rng(3)
    for _ in range(50):
        total = int(rng.integers(1, 200))
        a = np.union1d(rng.choice(np.arange(1, total), size=min(total - 1, int(rng.integers(0, total))), replace=False), [total])
        b = np.union1d(rng.choice(np.arange(1, total), size=min(total - 1, int(rng.integers(0, total))), replace=False), [total])
        whole = links(a, b, piece=10**9)
        for piece in (1, 2, 3, 17):
            got = links(a, b, piece)
            assert np.array_equal(got[0], whole[0]) and np.array_equal(got[1], whole[1])
        assert len(whole[0]) == len(np.union1d(a, b))
        for d in range(len(a) + len(b) + 1):
            i, j = split(a, b, d)
            merged = np.sort(np.concatenate([a[:i], b[:j]]))
            rest = np.concatenate([a[i:], b[j:]])
            assert not len(rest) or not len(merged) or merged[-1] <= rest.min()


def test_empty_and_clashing(empty, clashing):
    assert alignment(empty).count() == 0
    assert alignment(clashing).count() == clashing.count()


def test_ranks_give_the_ids_of_the_tokenizer_file():
    import duckdb
    from conftest import TESTDATA

    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{TESTDATA}/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    texts += [t for _, t in TEXTS if t]
    assert tokenizers(TOKENIZERS)[0](texts) == json_a(texts)
