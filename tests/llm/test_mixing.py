from collections import defaultdict

import pytest
from conftest import TESTDATA

from popscope.llm import mixing
from popscope.llm.common import table
from popscope.llm.mixing import mix, mixed_documents, source_targets

from .conftest import ODD_DOCUMENTS, words


def resharing(sizes, weights, total, cap):
    """Targets by cutting off and sharing out again until none is above."""
    target, open_, left = {}, dict(sizes), total * sum(sizes.values())
    while open_:
        weight = sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / weight >= cap * sizes[s]]
        if not over:
            return target | {s: left * weights[s] / weight for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
        left -= sum(target[s] for s in over)
        open_ = {s: n for s, n in open_.items() if s not in over}
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 5, "b": 900, "c": 20, "d": 0, "e": 77}, {"z": 0}, {"é": 3, "Z": 10, None: 4}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n long")
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    wanted = resharing(sizes, weights, 1.5, 2)
    found = {r.source: r.target for r in source_targets(rows).collect()}
    assert found == pytest.approx(wanted)


def test_takes_come_near_the_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BIN_ROWS", 4)  # many bins even here
    docs = table(spark, TESTDATA.replace("0.001", "0.01"), "documents")
    rows = mix(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    taken, target, most = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert r.size == len(words(texts[r.doc_id])) and r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert len(rows) == len(texts)
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] for s in target)
    again = mix(docs.repartition(7)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    copies = defaultdict(int)
    for r in mixed_documents(docs).collect():
        copies[r.doc_id] += 1
        assert r.text == texts[r.doc_id]
    assert {r.doc_id: r.copies for r in rows if r.copies} == copies


def test_odd_rows(odd, clashing, empty):
    rows = mix(clashing).collect()
    assert len(rows) == len(ODD_DOCUMENTS)
    assert all(r.taken <= 2 * r.size for r in rows) and sum(r.taken for r in rows) > 0
    assert mixed_documents(clashing).columns == clashing.columns
    assert mix(empty).collect() == [] and mixed_documents(empty).collect() == []
