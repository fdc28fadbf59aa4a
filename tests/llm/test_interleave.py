import zlib
from collections import Counter

import pytest
from conftest import TESTDATA

from popscope.llm.common import positions, table
from popscope.llm.interleave import interleave

from .conftest import ODD_DOCUMENTS


def check(rows, shards):
    held = Counter(r.shard for r in rows)
    counts = [held[s] for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(held[s]))
    for source, n in Counter(r.source for r in rows).items():
        mine = Counter(r.shard for r in rows if r.source == source)
        assert all(abs(mine[s] - n / shards) <= 2 for s in range(shards)), source


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_every_shard_has_the_mixture(spark, shards):
    docs = table(spark, TESTDATA.replace("0.001", "0.01"), "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = interleave(docs, shards).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    check(rows, shards)
    again = interleave(docs.repartition(5), shards).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_hot_source_and_repeated_rows(make):
    rows = [(i % 7, "same", None, "hot" if i % 3 else f"s{i % 5}", 4) for i in range(300)]
    check(interleave(make("documents", rows), 8).collect(), 8)


def test_odd_rows(clashing, empty):
    rows = interleave(clashing, 4).collect()
    assert len(rows) == len(ODD_DOCUMENTS)
    check(rows, 4)
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (2, 3)} == {(1, 0)}
    assert interleave(empty).collect() == []


def test_positions(spark):
    from pyspark.sql import functions as F

    rows = spark.range(1000).select((F.col("id") * 37 % 101).alias("x"), "id").repartition(9)
    numbered = positions(rows, [F.col("x"), F.col("id")], "test").collect()
    assert [r.position for r in sorted(numbered, key=lambda r: (r.x, r.id))] == list(range(1000))
