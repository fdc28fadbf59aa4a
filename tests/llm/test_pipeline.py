from collections import Counter

from conftest import TESTDATA

import corpus_pipeline
from popscope.llm.common import table

from .conftest import words
from .test_decontaminate import plain_found
from .test_near_dup import truth


def test_against_plain_stages(spark):
    """Every stage on the output of the one before, against a plain form of it."""
    docs = table(spark, TESTDATA, "documents")
    items = [r.text for r in table(spark, TESTDATA, "benchmark").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_dedup", "decontamination", "mixing", "sharding"]
    out = {}
    for name, stage in stages.items():
        before = docs.collect()
        docs = stage(spark, docs, TESTDATA)
        out[name] = docs.collect()
        texts = {r.doc_id: r.text for r in before} if name != "sharding" else {}
        if name == "language_id":
            assert {r.doc_id for r in out[name]} == {d for d, t in texts.items() if any(c.isalpha() for c in t or "")}
        elif name == "near_dedup":
            component, _ = truth(list(texts.items()))
            assert sorted(r.doc_id for r in out[name]) == sorted(set(component.values()))
        elif name == "decontamination":
            held = {d for d, t in texts.items() if any(i[:20].lower() in t.lower() and plain_found(t, i) is not None for i in items)}
            left = {r.doc_id for r in out[name]}
            assert held and not held & left and len(texts) - len(left) <= len(held) + 3
        elif name == "mixing":
            size = sum(len(words(t)) for t in texts.values())
            assert abs(sum(len(words(r.text)) for r in out[name]) - 1.5 * size) < 0.05 * size
            assert max(Counter(r.doc_id for r in out[name]).values()) <= 2
        if name != "sharding":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            spark.createDataFrame(out[name], docs.schema).count()
    counts = Counter(r.shard for r in out["sharding"])
    assert sum(counts.values()) == len(out["mixing"]) and max(counts.values()) - min(counts.values()) <= 1


def test_run_on_odd_rows(spark, odd, clashing, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, TESTDATA)
        docs.collect()
