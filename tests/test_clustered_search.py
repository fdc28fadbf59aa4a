"""Exact top-k over clustered vectors: the same rows as a full scan, fewer rows read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from popscope.operators.search import vector_topk
from popscope.plans.clustered_search import build_clusters, pruned_topk


@pytest.fixture(scope="module")
def index(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8)) * 6
    rows = [(i, [float(x) for x in centres[i % 12] + rng.normal(size=8)]) for i in range(3000)]
    rows += [(5000, None), (5001, [float("nan")] * 8), (5002, rows[7][1]), (5003, rows[7][1])]  # ties with row 7
    return spark.createDataFrame(rows, "id long, vec array<float>").repartition(4)


@pytest.mark.parametrize("metric", ["dot", "cosine"])
def test_same_rows_as_full_scan(spark, index, tmp_path, metric):
    clustered = build_clusters(index, str(tmp_path / metric), clusters=12, metric=metric, sample=500)
    for q in (index.where("id = 7").first()["vec"], [1.0] * 8, [-3.0, 0, 0, 0, 0, 0, 0, 2.0]):
        for k in (1, 5, 40):
            hits, share = pruned_topk(spark, clustered, q, k)
            full = vector_topk(index, q, k, metric)
            assert [tuple(r) for r in hits.collect()] == [tuple(r) for r in full.collect()]
            assert 0 < share <= 1
    _, share = pruned_topk(spark, clustered, index.where("id = 7").first()["vec"], 5)
    assert share < 0.5  # well separated clusters: most are skipped
    assert clustered.rows.sum() == 3002  # every row with a vector is indexed


def test_partition_filter_reaches_the_scan(spark, index, tmp_path):
    clustered = build_clusters(index, str(tmp_path / "plan"), clusters=4, sample=100)
    plan = clustered.read(spark, [1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "cluster" in plan
