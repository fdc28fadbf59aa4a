import hashlib

import numpy as np
from conftest import TESTDATA

from popscope.llm.common import table
from popscope.llm.fingerprint import edited_fingerprints, fingerprints

from .conftest import ODD_DOCUMENTS, jaccard, shingles


def edited(text, following):
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def test_against_sets(spark):
    docs = {r.doc_id: r.text for r in table(spark, TESTDATA, "documents").collect()}
    ids = sorted(docs)
    errors = []
    for row in edited_fingerprints(table(spark, TESTDATA, "documents")).collect():
        text, following = docs[row.doc_id], docs[ids[(ids.index(row.doc_id) + 1) % len(ids)]]
        other = edited(text, following)
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(other.encode()).hexdigest()
        errors.append(row.near_edited - jaccard(shingles(text), shingles(other)))
        errors.append(row.near_next - jaccard(shingles(text), shingles(following)))
    assert len(errors) == 2 * len(docs)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.06 and np.abs(errors).max() < 0.25


def test_equal_texts_and_odd_rows(odd, clashing):
    rows = fingerprints(odd).collect()
    by_id = {r.doc_id: r.fingerprint for r in rows}
    assert len(rows) == len(ODD_DOCUMENTS)
    assert by_id[1] == by_id[5] and len(by_id[1]) == 128 and by_id[2] == by_id[3] == by_id[4] == ""
    assert by_id[8] != by_id[6] and len(set(by_id[8])) > 4  # one shingle still fills the bins unevenly
    both = edited_fingerprints(clashing).collect()
    assert sorted(str(r.doc_id) for r in both) == sorted(str(r[0]) for r in ODD_DOCUMENTS)
    at = {r.doc_id: r for r in both}
    assert at[2].near_edited == 1.0 and at[2].near_next == 1.0 and at[1].near_next == 0.0
    # The null id comes last, and its next is the first.
    assert at[None].edited_sha256 == hashlib.sha256(edited("no id here at all", "a b c d e f g").encode()).hexdigest()
    assert at[9].edited_sha256 == hashlib.sha256(edited(ODD_DOCUMENTS[-1][1], "no id here at all").encode()).hexdigest()


def test_empty(empty):
    assert edited_fingerprints(empty).collect() == []


def test_no_python(spark):
    plan = edited_fingerprints(table(spark, TESTDATA, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
