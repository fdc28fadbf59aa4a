from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from popscope import Dimension, PopulationSpec, first_rows, panel, panel_late, sample, sample_late
from popscope.person import PERSON
from popscope.plans.lowest import lowest
from popscope.sources.population import open_population

SKEWED = PopulationSpec(id="id", strata={"group": Dimension("group")})


@pytest.fixture(scope="module")
def skewed(spark):
    """One stratum of 990 rows, nine others with 10 rows in all, and NULL."""
    group = F.when(F.col("id") < 990, "big").when(F.col("id") < 999, F.concat(F.lit("g"), F.col("id") % 9))
    return spark.range(1001).withColumn("group", group)


def ids(rows, name="uuid"):
    return [r[name] for r in rows.collect()]


def test_sample_size_and_rows(people):
    found = ids(sample(people, PERSON, 15, {"province": "서울"}, seed=1))
    assert len(set(found)) == 15
    few = sample(people, PERSON, 20, {"province": "서울", "age_range": (30, 33)}, seed=1)
    assert few.count() == people.where("province = '서울' AND age BETWEEN 30 AND 33").count() > 0
    assert sample(people, PERSON, 150, seed=1).count() == 150 and sample(people, PERSON, 500, seed=1).count() == 200
    assert sample(people, PERSON, 5).count() == 5
    assert sample(people, PERSON, 5, {"province": "none"}).count() == 0
    assert sample(people, PERSON, 5, seed=1).columns == people.columns


@pytest.mark.parametrize("n", [0, -1, 2.5, "3", True, None])
def test_refused_n(people, n):
    with pytest.raises(ValueError):
        sample(people, PERSON, n)
    with pytest.raises(ValueError):
        panel(people, PERSON, n, "sex")


def test_refused_stratum_and_seed(people):
    with pytest.raises(ValueError):
        panel(people, PERSON, 5, "district")
    with pytest.raises(ValueError):
        sample(people, PERSON, 5, seed="1")


def test_seed_is_repeatable_at_any_partitioning(people):
    for call in (lambda p: sample(p, PERSON, 10, seed=42), lambda p: panel(p, PERSON, 10, "age_decade", seed=42)):
        first = ids(call(people))
        assert all(ids(call(people.repartition(parts))) == first for parts in (1, 8, 64))
    assert ids(sample(people, PERSON, 10, seed=1)) != ids(sample(people, PERSON, 10, seed=2))


def test_unseeded_samples_differ(people):
    assert len({tuple(ids(sample(people, PERSON, 10))) for _ in range(4)}) > 1


def test_panel_covers_every_stratum(people):
    provinces = Counter(r["province"] for r in panel(people, PERSON, 7, "province", seed=3).collect())
    assert set(provinces) == {None, "", "서울", "부산", "대구", "인천", "광주"}
    assert set(provinces.values()) == {1}


def test_panel_uses_real_decades(people):
    found = panel(people, PERSON, 8, "age_decade", {"age_range": (20, 99)}, seed=42).collect()
    assert sorted(r["age"] // 10 for r in found) == [2, 3, 4, 5, 6, 7, 8, 9]


def test_panel_without_stratum_is_a_sample(people):
    assert ids(panel(people, PERSON, 6, seed=5)) == ids(sample(people, PERSON, 6, seed=5))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 20), seed=st.integers(-(10**9), 10**9))
def test_panel_sizes_are_even_until_exhausted(skewed, n, seed):
    found = Counter(r["group"] for r in panel(skewed, SKEWED, n, "group", seed=seed).collect())
    sizes = Counter(r["group"] for r in skewed.collect())
    assert sum(found.values()) == n
    most = max(found.values())
    assert all(found[g] >= min(most - 1, sizes[g]) for g in sizes)


def test_small_strata_have_a_fair_chance(skewed):
    """With one row asked for, the stratum with 99% of the rows must not win nearly always."""
    few = skewed.where("id >= 900 AND id < 999")  # 90 rows in one stratum, one row in each of nine
    wins = sum(panel(few, SKEWED, 1, "group", seed=s).first()["group"] == "big" for s in range(24))
    assert wins <= 10  # between 2 and 3 expected


def test_large_n_is_the_same_in_bounded_tasks(skewed, monkeypatch):
    small = {n: (sample(skewed, SKEWED, n, seed=4).collect(), panel(skewed, SKEWED, n, "group", seed=4).collect()) for n in (30, 700, 5000)}
    for module in ("popscope.plans.lowest", "popscope.operators.sampling"):
        monkeypatch.setattr(f"{module}.TOP_N", 5)
    monkeypatch.setattr(lowest, "__defaults__", (5,))
    for n, (rows, spread) in small.items():
        assert sample(skewed, SKEWED, n, seed=4).collect() == rows and len(rows) == min(n, 1001)
        assert panel(skewed, SKEWED, n, "group", seed=4).collect() == spread and len(spread) == min(n, 1001)


def test_null_and_repeated_ids(spark, tmp_path):
    rows = [(None if i % 10 == 0 else i % 30, i, "g") for i in range(300)]
    table = spark.createDataFrame(rows, "id long, x long, g string").repartition(4)
    table.write.parquet(str(tmp_path / "t"))
    stored = open_population(spark, str(tmp_path / "t"))
    shared = PopulationSpec(id="id", strata={"g": Dimension("g")})
    both = PopulationSpec(id=("id", "x"))
    for n in (12, 250):
        for rows in (sample(stored, shared, n, seed=3), sample(table, shared, n, seed=3), panel(stored, shared, n, "g", seed=3)):
            found = [r["x"] for r in rows.collect()]
            assert len(found) == len(set(found)) == n
    drawn = [sum(r["id"] is None for r in sample(stored, both, 30, seed=s).collect()) for s in range(12)]
    assert 0 < sum(drawn) < 12 * 8  # a tenth of the rows has no id
    assert sample(stored, both, 30, seed=3).collect() == sample(table, both, 30, seed=3).collect()


def test_panel_plan(skewed):
    plan = panel(skewed, SKEWED, 5, "group", seed=1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4 and "TakeOrderedAndProject" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    plan = sample(skewed, SKEWED, 5, seed=1)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_late_rows_open_only_the_files_they_need(spark, people, tmp_path):
    path = str(tmp_path / "people")
    people.repartition(12).write.parquet(path)
    stored = open_population(spark, path)
    wanted = sample(people, PERSON, 3, {"sex": "남자"}, seed=9).collect()
    late = sample_late(stored, PERSON, 3, {"sex": "남자"}, seed=9)
    assert late.collect() == wanted
    assert panel_late(stored, PERSON, 9, "province", seed=2).collect() == panel(people, PERSON, 9, "province", seed=2).collect()
    assert sample_late(stored, PERSON, 3, {"province": "none"}).collect() == []
    # The other files are not read any more, so it does not matter that they break.
    needed = {r["f"] for r in stored.where(F.col("uuid").isin([r["uuid"] for r in wanted]))
              .select(F.col("_metadata.file_name").alias("f")).collect()}
    late = sample_late(stored, PERSON, 3, {"sex": "남자"}, seed=9)
    broken = 0
    for file in (tmp_path / "people").glob("*.parquet"):
        if file.name not in needed:
            file.write_bytes(b"no parquet")
            broken += 1
    for crc in (tmp_path / "people").glob(".*.crc"):
        crc.unlink()
    assert broken >= 9 and late.collect() == wanted


@pytest.mark.parametrize("n", [1, 21, 450, 500, 10_000])
def test_first_rows(spark, n):
    table = spark.range(500).select((F.col("id") * 7919 % 500).alias("id"), F.lit("x").alias("t")).repartition(6)
    expected = list(range(min(n, 500)))
    assert sorted(ids(first_rows(table, "id", n), "id")) == expected
    for one_task, ranges in ((20, 50), (20, 4), (3, 3)):
        assert sorted(ids(first_rows(table, "id", n, one_task, ranges), "id")) == expected
    same = table.withColumn("id", F.lit(5))
    assert first_rows(same, "id", n, 20, 4).count() == min(n, 500)
    some = table.withColumn("id", F.when(F.col("id") % 3 > 0, F.col("id") % 100))
    found = ids(first_rows(some, "id", n, 20, 4), "id")
    wanted = sorted((r["id"] for r in some.collect()), key=lambda i: (i is None, i or 0))[:n]
    assert sorted(found, key=lambda i: (i is None, i or 0)) == wanted


def test_first_rows_refuses_nonsense(spark):
    for n in (0, -1, 1.5, True):
        with pytest.raises(ValueError):
            first_rows(spark.range(3), "id", n)
