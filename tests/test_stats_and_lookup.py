from __future__ import annotations

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from popscope import (
    DatasetMissingError,
    Dimension,
    PopulationSpec,
    categorical,
    dataset_inventory,
    describe_filters,
    duplicate_ids,
    get_by_id,
    get_by_ids,
    open_population,
    rows_as_json,
    stats,
    write_json,
)
from popscope.functions.text import passage_text, row_summary
from popscope.person import PERSON, PERSON_SCHEMA


def test_stats(people):
    found = [tuple(r) for r in stats(people, PERSON, "province").collect()]
    counts = Counter(r["province"] for r in people.collect())
    assert dict(found) == dict(counts)
    assert found == sorted(found, key=lambda b: (-b[1], b[0] is None, b[0] or ""))
    assert stats(people, PERSON, "province").dtypes == [("value", "string"), ("count", "bigint")]


@pytest.mark.parametrize("dimension", sorted(PERSON.dimensions))
def test_every_dimension(people, dimension):
    total = sum(r["count"] for r in stats(people, PERSON, dimension, limit=300).collect())
    assert total == 200


def test_decade_labels(people):
    found = {r["value"]: r["count"] for r in stats(people, PERSON, "age_decade", {"age_range": (20, 39)}).collect()}
    assert set(found) == {"20대", "30대"}
    assert None in {r["value"] for r in stats(people, PERSON, "age_decade").collect()}


def test_bucket_limit(spark):
    spec = PopulationSpec(id="id", dimensions={"id": Dimension("id")})
    table = spark.range(400)
    sizes = {limit: stats(table, spec, "id", limit=limit).count() for limit in (None, 7, 300, 5000)}
    assert sizes == {None: 400, 7: 7, 300: 300, 5000: 400}
    for limit in (2.5, "3", True, 0, -5):
        with pytest.raises(ValueError):
            stats(table, spec, "id", limit=limit)
    with pytest.raises(ValueError):
        stats(table, spec, "name")


def test_lookup(spark, people):
    uuid = f"{5:032x}"
    assert [r["uuid"] for r in get_by_id(people, PERSON, uuid).collect()] == [uuid]
    assert get_by_id(people, PERSON, "none").count() == 0
    wanted = [f"{i:032x}" for i in range(10)] + ["none"]
    assert get_by_ids(people, PERSON, wanted).count() == 10
    assert get_by_ids(people, PERSON, []).count() == 0
    filtered = get_by_ids(people, PERSON, wanted, {"sex": "여자"}).collect()
    assert 0 < len(filtered) < 10 and {r["sex"] for r in filtered} == {"여자"}
    # A table of ids, one of which is most of its rows, and a long list of ids.
    table = spark.createDataFrame([(u,) for u in wanted + [wanted[0]] * 500], "some_id string")
    assert sorted(r["uuid"] for r in get_by_ids(people, PERSON, table).collect()) == sorted(wanted[:10])
    many = wanted + [f"missing {i}" for i in range(2000)]
    assert get_by_ids(people, PERSON, many).count() == 10
    # Ids of another type are compared as the column's, however many they are.
    numbers = spark.range(300).withColumn("x", F.lit(1))
    spec = PopulationSpec(id="id")
    assert get_by_ids(numbers, spec, ["5", 6, "x", None]).count() == 2
    assert get_by_ids(numbers, spec, [str(i) for i in range(2000)]).count() == 300


def test_duplicate_ids(people):
    assert duplicate_ids(people, PERSON).count() == 0
    again = people.unionByName(people.where(F.col("uuid") == f"{5:032x}"))
    assert [tuple(r) for r in duplicate_ids(again, PERSON).collect()] == [(f"{5:032x}", 2)]


def test_describe(people):
    found = {r["name"]: r for r in describe_filters(people, PERSON).collect()}
    assert list(found) == [role.name for role in PERSON.columns] or set(found) == {r.name for r in PERSON.columns}
    assert found["sex"]["allowed_values"] == ["남자", "여자"] and found["sex"]["cardinality"] == 2
    assert len(found["family_type"]["allowed_values"]) == found["family_type"]["cardinality"] == 39
    assert found["district"]["allowed_values"] is None and found["district"]["cardinality"] == 15
    assert (found["age"]["range_min"], found["age"]["range_max"]) == (19, 99)
    assert found["occupation"]["type"] == "freetext" and found["occupation"]["cardinality"] is None
    assert {r["total_records"] for r in found.values()} == {200}
    rough = {r["name"]: r for r in describe_filters(people, PERSON, exact=False).collect()}
    assert abs(rough["family_type"]["cardinality"] - 39) <= 4
    assert rough["housing_type"]["allowed_values"] == list(PERSON.columns[6].values)
    assert describe_filters(people, PERSON).schema == describe_filters(people, PERSON, exact=False).schema


def test_describe_of_a_column_without_values(spark):
    table = spark.range(3).withColumn("c", F.lit(None).cast("string"))
    spec = PopulationSpec(id="id", columns=(categorical("c"),))
    assert [(r["cardinality"], r["allowed_values"]) for r in describe_filters(table, spec).collect()] == [(0, None)]


def test_describe_reads_categories_once(people, spark, tmp_path):
    path = str(tmp_path / "people")
    people.write.parquet(path)
    rows = describe_filters(open_population(spark, path), PERSON)
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("FileScan") == 2  # the totals and the categories


def test_summary_and_passage(spark):
    row = ("0123456789abcdef", "남자", 33, "서울", "서울-중구", "기자")
    table = spark.createDataFrame([row], "uuid string, sex string, age int, province string, district string, occupation string")
    line = table.select(row_summary(F.col("uuid"), PERSON.summary)).first()[0]
    assert line == "[01234567] 남자 33세 / 서울 서울-중구 / 기자"
    with pytest.raises(ValueError):
        row_summary(F.col("uuid"), ["sex"])
    texts = spark.createDataFrame([("a", None, "c"), ("", "b", ""), (None, None, None)], "x string, y string, z string")
    assert [r[0] for r in texts.select(passage_text(["x", "y", "z"])).collect()] == ["a c", "b", ""]


def test_json_keeps_null(spark, people, tmp_path):
    documents = [json.loads(r["json"]) for r in rows_as_json(people).collect()]
    assert len(documents) == 200 and all(list(d) == people.columns for d in documents)
    assert {d["province"] for d in documents} >= {None, "", "서울"}
    write_json(people, str(tmp_path / "json"))
    lines = [json.loads(line) for f in (tmp_path / "json").glob("*.json") for line in f.read_text().splitlines()]
    assert sorted(d["uuid"] for d in lines) == sorted(d["uuid"] for d in documents)
    assert all(list(d) == people.columns for d in lines)


def test_missing_dataset(spark, people, tmp_path):
    (tmp_path / "empty").mkdir()
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "notes.txt").write_text("no table")
    for name in ("missing", "empty", "other"):
        for schema in (None, PERSON_SCHEMA):
            with pytest.raises(DatasetMissingError):
                open_population(spark, str(tmp_path / name), schema)
    with pytest.raises(DatasetMissingError):
        dataset_inventory(spark, str(tmp_path / "missing"))
    assert tuple(dataset_inventory(spark, str(tmp_path / "empty")).first()) == (0, 0)
    path = tmp_path / "people"
    people.repartition(3).write.parquet(str(path))
    (path / "notes.txt").write_text("no table")
    assert open_population(spark, str(path), PERSON_SCHEMA).count() == 200
    size = sum(f.stat().st_size for f in path.glob("*.parquet"))
    assert tuple(dataset_inventory(spark, str(path)).first()) == (3, size)
