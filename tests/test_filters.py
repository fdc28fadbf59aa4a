from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from popscope import PopulationSpec, categorical, count_matching, freetext, matching, number_range
from popscope.functions import predicates
from popscope.person import PERSON, SEX


def count(people, filters):
    return count_matching(people, PERSON, filters).first()["n"]


def rows(people):
    return [r.asDict() for r in people.collect()]


@pytest.mark.parametrize(
    "filters, test",
    [
        ({"province": "서울"}, lambda r: r["province"] == "서울"),
        ({"province": ["서울", "부산"]}, lambda r: r["province"] in ("서울", "부산")),
        ({"district": "부산-1구"}, lambda r: r["district"] == "부산-1구"),
        ({"sex": "여자"}, lambda r: r["sex"] == "여자"),
        ({"age_range": (30, 39)}, lambda r: r["age"] is not None and 30 <= r["age"] <= 39),
        ({"age_range": [40, 30]}, lambda r: False),
        ({"education_level": ["대학교", "고등학교"]}, lambda r: r["education_level"] in ("대학교", "고등학교")),
        ({"marital_status": "미혼"}, lambda r: r["marital_status"] == "미혼"),
        ({"family_type": "가구 3"}, lambda r: r["family_type"] == "가구 3"),
        ({"housing_type": "기타"}, lambda r: r["housing_type"] == "기타"),
        ({"occupation_contains": "DATA"}, lambda r: "data" in (r["occupation"] or "").lower()),
        ({"occupation_contains": ""}, lambda r: r["occupation"] is not None),
        ({"occupation_contains": "\\"}, lambda r: "\\" in (r["occupation"] or "")),
        ({"occupation_contains": "d_t"}, lambda r: "dat" in (r["occupation"] or "").lower()),
        ({"occupation_contains": "5%er"}, lambda r: (r["occupation"] or "") == "50% baker"),
        ({}, lambda r: True),
        (None, lambda r: True),
        ({"province": []}, lambda r: True),
        ({"province": None}, lambda r: True),
        ({"province": "서울", "sex": "남자", "age_range": (20, 60), "occupation_contains": "e"},
         lambda r: r["province"] == "서울" and r["sex"] == "남자" and r["age"] is not None
         and 20 <= r["age"] <= 60 and "e" in (r["occupation"] or "").lower()),
        ({"province": "Seoul"}, lambda r: False),
    ],
)
def test_filter(people, filters, test):
    assert count(people, filters) == sum(test(r) for r in rows(people))


@pytest.mark.parametrize(
    "filters",
    [
        {"city": "서울"},
        {"sex": "other"},
        {"sex": list(SEX)},
        {"age_range": (18, 30)},
        {"age_range": (30, 100)},
        {"age_range": (30.5, 40)},
        {"age_range": 30},
        {"age_range": (30,)},
        {"age_range": "30"},
        {"age_range": (True, 40)},
        {"occupation_contains": 3},
    ],
)
def test_refused_filter(people, filters):
    with pytest.raises(ValueError):
        matching(people, PERSON, filters)


def test_literal_words(spark):
    texts = ["50% off", "50 percent", "a_b", "aXb", "c\\d", None, "50% OFF"]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    spec = PopulationSpec(id="id", columns=(freetext("text", literal=True),))
    found = {w: [r["id"] for r in matching(table, spec, {"text_contains": w}).orderBy("id").collect()]
             for w in ("%", "_", "\\", "% off")}
    assert found == {"%": [0, 6], "_": [2], "\\": [4], "% off": [0, 6]}


def test_list_in_a_column(spark):
    table = spark.createDataFrame([(1, [1, 2]), (3, [1, 2]), (2, None)], "x int, allowed array<int>")
    assert [r["x"] for r in table.where(predicates.in_list(F.col("x"), F.col("allowed"))).collect()] == [1]


def test_open_range_takes_any_number(spark):
    spec = PopulationSpec(id="x", columns=(number_range("x"), categorical("k")))
    table = spark.createDataFrame([(0.5, 1), (2.5, 2), (None, 3)], "x double, k int")
    assert count_matching(table, spec, {"x_range": (0, 1.5)}).first()["n"] == 1
    assert count_matching(table, spec, {"k": [2, 3]}).first()["n"] == 2


def test_filters_reach_the_scan(spark):
    from registry.tables import PART, table

    rows = matching(table(spark, "/root/testdata/sf0.001", "part"), PART, {"p_type": ["PROMO"], "p_size_range": (3, 9)})
    plan = rows.select("p_partkey")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(p_type,PROMO)" in plan and "GreaterThanOrEqual(p_size,3)" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string,p_size:int>" in plan
