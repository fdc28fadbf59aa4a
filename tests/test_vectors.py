from __future__ import annotations

import math
import subprocess
import sys

import numpy as np
import pytest
from conftest import ROOT
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from popscope import PopulationSpec, categorical, pack, search, unpack, vector_scores, vector_topk, vector_topk_batch
from popscope.functions import blocks
from popscope.functions.vectors import cosine, dot, l2_norm, l2_normalize

SPEC = PopulationSpec(id="id", columns=(categorical("k"),))


def exact(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += float(np.float32(x)) * float(y)
    return total


@pytest.fixture(scope="module")
def vectors():
    """300 vectors of width 24: a third are copies of one, some nearly equal."""
    rng = np.random.default_rng(3)
    values = rng.normal(size=(300, 24)).astype(np.float32)
    values[100:200] = values[100]
    values[250:260] = values[250] * np.linspace(1, 1 + 1e-6, 10, dtype=np.float32)[:, None]
    return [v.tolist() for v in values]


@pytest.fixture(scope="module")
def index(spark, vectors):
    rows = [(i, v) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "id long, vec array<float>").repartition(7).cache()


def expected(vectors, query, k):
    scored = [(-exact(v, query), i) for i, v in enumerate(vectors)]
    return [(i, -s) for s, i in sorted(scored)[:k]]


@pytest.mark.parametrize("k", [1, 5, 150, 1000])
def test_topk_is_exact_with_ties_by_id(index, vectors, k):
    for query in (vectors[100], vectors[250], vectors[0]):
        assert [tuple(r) for r in vector_topk(index, query, k).collect()] == expected(vectors, query, k)
        packed = pack(index, 24)
        assert [tuple(r) for r in vector_topk(packed, query, k).collect()] == expected(vectors, query, k)


def test_all_scores_and_jvm_scores_agree(index, vectors):
    query = vectors[7]
    wanted = {i: exact(v, query) for i, v in enumerate(vectors)}
    assert {r["id"]: r["score"] for r in vector_scores(index, query).collect()} == wanted
    literal = F.array(*[F.lit(x) for x in query])
    assert {r[0]: r[1] for r in index.select("id", dot(F.col("vec"), literal)).collect()} == wanted


def test_cosine(index, vectors):
    query = vectors[7]
    norm = math.sqrt(exact(query, query))
    wanted = {i: exact(v, query) / norm / math.sqrt(exact(v, v)) for i, v in enumerate(vectors)}
    found = {r["id"]: r["score"] for r in vector_scores(index, query, "cosine").collect()}
    assert found == pytest.approx(wanted, abs=1e-12)
    top = vector_topk(index, query, 300, "cosine").collect()
    assert [r["score"] for r in top] == pytest.approx(sorted(wanted.values(), reverse=True), abs=1e-12)
    literal = F.array(*[F.lit(x) for x in query])
    jvm = {r[0]: r[1] for r in index.select("id", cosine(F.col("vec"), literal)).collect()}
    assert jvm == pytest.approx(wanted, abs=1e-12)


@pytest.mark.parametrize("options", [{}, {"block_numbers": 1}, {"block_numbers": 240}])
@pytest.mark.parametrize("packed", [False, True])
def test_batch_is_exact(spark, index, vectors, options, packed):
    queries = spark.createDataFrame([(f"q{i}", v) for i, v in enumerate(vectors[95:125])] + [("none", None)],
                                    "query_id string, vec array<float>")
    rows = pack(index, 24) if packed else index
    found = vector_topk_batch(rows, queries, 4, **options)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["id"], r["score"]))
    assert got == {f"q{i}": expected(vectors, v, 4) for i, v in enumerate(vectors[95:125])}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "CoGroup" not in plan and "Generate" not in plan  # the index is not copied or dealt anew


def test_many_queries_in_bounded_memory():
    """A worker's share: the most queries of a block, k = 100, and rows that tie."""
    code = """
import resource, numpy as np, pyarrow as pa
from popscope.functions import blocks
rng = np.random.default_rng(0)
queries = pa.table({"query_id": np.arange(2604), "vec": blocks.lists(rng.normal(size=(2604, 384)))})
rows = rng.normal(size=(2000, 384)).astype(np.float32)
rows[500:900] = rows[500]
batch = pa.RecordBatch.from_arrays([pa.array(np.arange(2000)), blocks.pack(rows)], names=["id", "vec"])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
found = list(blocks.best_pairs(queries, [batch], 384, 100, False))
assert sum(b.num_rows for b in found) == 260400
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, timeout=300)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) < 500


def test_batch_with_queries_from_the_index(index, vectors):
    queries = index.where("id < 20").select(F.col("id").alias("query_id"), "vec")
    for options in ({}, {"block_numbers": 100}):
        found = vector_topk_batch(index, queries, 2, **options).collect()
        wanted = {(q, rank + 1, *hit) for q in range(20) for rank, hit in enumerate(expected(vectors, vectors[q], 2))}
        assert {(r["query_id"], r["rank"], r["id"], r["score"]) for r in found} == wanted


def test_batch_without_queries_or_index(spark, index):
    none = spark.createDataFrame([], "query_id long, vec array<float>")
    assert vector_topk_batch(index, none, 3).count() == 0
    some = spark.createDataFrame([(1, [1.0] * 24)], "query_id long, vec array<float>")
    empty = index.where("id < 0")
    assert vector_topk_batch(empty, some, 3).count() == 0
    assert vector_topk_batch(empty, some, 3, block_numbers=1).count() == 0
    assert vector_topk(empty, [1.0] * 24, 3).count() == 0


ODD = [
    (1, [1.0, 0.0]), (2, [float("nan"), 1.0]), (3, None), (4, [0.0, 0.0]), (5, [0.6, 0.8]),
    (6, [None, 1.0]), (7, [float("inf"), 0.0]), (8, [-float("inf"), 0.0]), (9, [3e38, 3e38]), (10, [1.0, 0.0]),
]


def test_odd_vectors(spark):
    index = spark.createDataFrame(ODD, "id int, vec array<float>").repartition(3)
    found = vector_topk(index, [1.0, 1.0], 20).collect()
    assert [r["id"] for r in found] == [7, 9, 5, 1, 10, 4, 8]
    assert [r["id"] for r in vector_topk(index, [1.0, 1.0], 3).collect()] == [7, 9, 5]
    assert sorted(r["id"] for r in vector_scores(index, [1.0, 1.0]).collect()) == [1, 4, 5, 7, 8, 9, 10]
    near = vector_topk(index, [1.0, 0.0], 20, "cosine").collect()
    assert [r["id"] for r in near] == [1, 10, 9, 5]
    queries = spark.createDataFrame([(1, [1.0, 1.0]), (2, [float("nan"), 1.0])], "query_id int, vec array<float>")
    batch = vector_topk_batch(index, queries, 3).orderBy("rank").collect()
    assert [(r["query_id"], r["id"]) for r in batch] == [(1, 7), (1, 9), (1, 5)]


def test_odd_rows_do_not_hide_others(spark):
    """Overflowing and NaN rows in the same slice as the k best ones."""
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 8)).astype(np.float32))]
    rows += [(1000 + i, [float("nan")] * 8) for i in range(50)] + [(2000 + i, [3e38, -3e38] * 4) for i in range(50)]
    index = spark.createDataFrame(rows, "id long, vec array<float>").coalesce(1)
    query = [1.0] * 8
    finite = sorted((-exact(v, query), i) for i, v in rows if i < 1000 or i >= 2000)
    assert [r["id"] for r in vector_topk(index, query, 12).collect()] == [i for _, i in finite[:12]]


def test_wrong_width_fails(spark):
    index = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "id int, vec array<float>")
    with pytest.raises(PythonException, match="width mismatch: expected 2, found 1"):
        vector_topk(index, [1.0, 1.0], 1).collect()
    with pytest.raises(PythonException, match="width mismatch: expected 3"):
        vector_scores(index, [1.0, 1.0, 1.0]).collect()


@pytest.mark.parametrize("call", [
    lambda i: vector_topk(i, [], 1), lambda i: vector_topk(i, [1.0], 0), lambda i: vector_topk(i, [1.0], 1.5),
    lambda i: vector_topk(i, [1.0], 1, "l2"), lambda i: vector_scores(i, []),
])
def test_refused_arguments(index, call):
    with pytest.raises(ValueError):
        call(index)


def test_normalize(spark):
    table = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None)], "id int, vec array<float>")
    found = {r[0]: r[1] for r in table.select("id", l2_normalize(F.col("vec"))).collect()}
    assert found[1] == pytest.approx([0.6, 0.8], abs=1e-7) and found[2] is None and found[3] is None
    assert table.select(l2_norm(F.col("vec"))).first()[0] == 5.0


def test_pack_and_unpack(index, vectors):
    again = unpack(pack(index, 24), 24)
    assert again.schema["vec"].dataType.simpleString() == "array<float>"
    assert {r["id"]: r["vec"] for r in again.collect()} == dict(enumerate(vectors))
    assert blocks.matrix(blocks.pack(np.empty((0, 3))), 3).shape == (0, 3)


# Search


@pytest.fixture(scope="module")
def population(spark):
    rows = [(i, "abc"[i % 3] if i % 10 else None, f"row {i}") for i in range(290)]
    return spark.createDataFrame(rows, "id long, k string, text string").repartition(4).cache()


def test_search_keeps_rank_order_and_drops_unknown_ids(population, index, vectors):
    found = search(population, SPEC, index, 20, vector=vectors[0]).collect()
    known = [(i, s) for i, s in expected(vectors, vectors[0], 300) if i < 290]
    assert [(r["id"], r["score"]) for r in found] == known[:20]
    post = search(population, SPEC, index, 20, vector=vectors[0], mode="post").collect()
    assert [(r["id"], r["score"]) for r in post] == [(i, s) for i, s in expected(vectors, vectors[0], 20) if i < 290]
    assert all(r["text"] == f"row {r['id']}" for r in found)


def test_post_filter_may_starve_and_pre_filter_does_not(population, index, vectors):
    filters = {"k": "a"}
    matching = [(i, s) for i, s in expected(vectors, vectors[0], 300) if i < 290 and i % 10 and i % 3 == 0]
    for over_fetch in (1, 2, 10):
        post = search(population, SPEC, index, 8, vector=vectors[0], filters=filters, over_fetch=over_fetch, mode="post").collect()
        within = {i for i, _ in expected(vectors, vectors[0], 8 * over_fetch)}
        assert [(r["id"], r["score"]) for r in post] == [m for m in matching if m[0] in within][:8]
    pre = search(population, SPEC, index, 8, vector=vectors[0], filters=filters).collect()
    assert [(r["id"], r["score"]) for r in pre] == matching[:8]
    starved = search(population, SPEC, index, 8, vector=vectors[0], filters=filters, over_fetch=1, mode="post").collect()
    assert len(starved) < 8 and starved == pre[: len(starved)]


def test_search_plan(population, index, vectors):
    for mode in ("post", "pre"):
        rows = search(population, SPEC, index, 5, vector=vectors[0], filters={"k": "a"}, mode=mode)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("options", [
    {}, {"query": "x"}, {"query": "x", "vector": [1.0]}, {"vector": [1.0], "mode": "both"},
    {"vector": [1.0], "filters": {"z": 1}}, {"vector": [1.0], "filters": {}, "over_fetch": 0},
])
def test_refused_search(population, index, options):
    with pytest.raises(ValueError):
        search(population, SPEC, index, 5, **options)
