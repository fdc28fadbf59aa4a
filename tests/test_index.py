from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.errors import PythonException, SparkRuntimeException
from pyspark.sql import functions as F

from popscope import (
    IndexMissingError,
    NgramEncoder,
    build_index,
    encode_passages,
    encode_queries,
    encode_query,
    index_info,
    open_index,
    open_population,
    publish_stream,
    search,
    start_index_stream,
    unpack,
)
from popscope.person import PERSON, PERSON_SCHEMA
from popscope.plans.index_build import encoded_rows, hashed_passages
from popscope.sources.vector_index import IndexStore
from popscope.sources.workspace import shared_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the encoders below run in the workers
ENCODER = NgramEncoder(dim=48)


@dataclass(frozen=True)
class Failing(NgramEncoder):
    """Fails on one text, as a lost model would."""

    def encode(self, texts):
        if any("persona 150 " in t for t in texts):
            raise RuntimeError("encoder failed")
        return super().encode(texts)


@dataclass(frozen=True)
class Narrow(NgramEncoder):
    def encode(self, texts):
        return super().encode(texts)[:, :-1]


def naive(text, dim):
    counts = [0] * dim
    for a, b, c in zip(text, text[1:], text[2:]):
        mixed = ord(a) * 7919 + ord(b) * 104729 + ord(c) * 1299709
        counts[mixed % 1000003 % dim] += 1 - 2 * (mixed // 1000003 % 2)
    norm = sum(n * n for n in counts) ** 0.5
    return np.array([n / norm if norm else 0 for n in counts], dtype=np.float32)


def passage(row):
    parts = (row["persona"], row["hobbies_and_interests"], row["career_goals_and_ambitions"])
    return "passage: " + " ".join(p for p in parts if p)


def stored(spark, root):
    rows = unpack(open_index(spark, root, ENCODER.dim), ENCODER.dim).collect()
    assert len({r["id"] for r in rows}) == len(rows)
    return {r["id"]: r["vec"] for r in rows}


def expected(rows):
    return {r["uuid"]: naive(passage(r), ENCODER.dim).tolist() for r in rows.collect()}


def test_encoder():
    texts = ["", "ab", "abc", "한국어 문장과 😀 그림", "é combining", "long " * 5000]
    found = ENCODER.encode(texts)
    assert found.dtype == np.float32 and found.shape == (6, 48)
    for row, text in zip(found, texts):
        assert row.tolist() == naive(text, 48).tolist()
    assert encode_query("abc", ENCODER) == naive("query: abc", 48).tolist()
    for query in ("", None, 3):
        with pytest.raises(ValueError):
            encode_query(query, ENCODER)


def test_encode_passages(people):
    for tasks in (None, 3):
        rows = encode_passages(people, PERSON, ENCODER, tasks)
        assert {r["id"]: r["vec"] for r in rows.collect()} == expected(people)


def test_encode_queries(spark):
    rows = spark.createDataFrame([(1, "abc"), (2, "xyz")], "query_id int, text string")
    found = {r["query_id"]: r["vec"] for r in encode_queries(rows, ENCODER).collect()}
    assert found[1] == naive("query: abc", 48).tolist()
    for text in ("", None):
        rows = spark.createDataFrame([(1, text)], "query_id int, text string")
        with pytest.raises(SparkRuntimeException, match="non-empty"):
            encode_queries(rows, ENCODER).collect()


def test_encoder_of_wrong_shape(people):
    with pytest.raises(PythonException):
        encode_passages(people, PERSON, Narrow(dim=48)).collect()


def test_build(spark, people, tmp_path):
    root = str(tmp_path / "index")
    with pytest.raises(IndexMissingError):
        open_index(spark, root)
    assert tuple(index_info(spark, root).first()) == (root, False, None, None)
    report = build_index(people, PERSON, ENCODER, root)
    assert (report.path, report.encoded) == (root, 200)
    assert stored(spark, root) == expected(people)
    info = index_info(spark, root).first()
    assert info["exists"] and info["rows"] == 200
    assert info["bytes"] == sum(f.stat().st_size for f in (tmp_path / "index" / "generation-1").glob("*.parquet"))
    assert info.asDict().keys() == index_info(spark, str(tmp_path / "none")).first().asDict().keys()
    # Nothing is encoded twice.
    assert build_index(people, PERSON, Failing(dim=48), root).encoded == 0
    assert stored(spark, root) == expected(people)


def test_index_files_are_sorted_ranges(spark, people, tmp_path):
    root = str(tmp_path / "index")
    build_index(people, PERSON, ENCODER, root, files=4)
    files = sorted((tmp_path / "index" / "generation-1").glob("*.parquet"))
    ids = [[r["id"] for r in spark.read.parquet(str(f)).collect()] for f in files]
    assert len(ids) == 4 and sum(ids, []) == sorted(sum(ids, []))


def test_subset_then_the_rest(spark, people, tmp_path):
    root = str(tmp_path / "index")
    assert build_index(people, PERSON, ENCODER, root, limit=30).encoded == 30
    assert sorted(stored(spark, root)) == [f"{i:032x}" for i in range(30)]
    assert build_index(people, PERSON, ENCODER, root, rounds=3).encoded == 170
    assert stored(spark, root) == expected(people)


def test_interrupted_build_goes_on(spark, people, tmp_path):
    root = str(tmp_path / "index")
    with pytest.raises(PythonException):
        build_index(people, PERSON, Failing(dim=48), root, rounds=6)
    with pytest.raises(IndexMissingError):
        open_index(spark, root)
    pending = IndexStore(spark, root).pending_path(1)
    done = spark.read.parquet(pending).count()
    assert 0 < done < 200
    assert build_index(people, PERSON, ENCODER, root).encoded == 200 - done
    assert stored(spark, root) == expected(people)


def test_failed_publishing_is_repeated(spark, people, tmp_path):
    """All is encoded and half a generation written, but not published."""
    root = str(tmp_path / "index")
    store = IndexStore(spark, root)
    rows = encoded_rows(hashed_passages(people, PERSON, ENCODER), ENCODER)
    rows.write.parquet(store.pending_path(1))
    rows.limit(10).write.parquet(store.generation_path(1))
    assert build_index(people, PERSON, Failing(dim=48), root).encoded == 0
    assert stored(spark, root) == expected(people)


def test_changed_text_replaces_the_vector(spark, people, tmp_path):
    root = str(tmp_path / "index")
    build_index(people, PERSON, ENCODER, root)
    changed = people.withColumn(
        "persona", F.when(F.col("age") % 10 == 3, "someone else").otherwise(F.col("persona"))
    )
    number = people.where("age % 10 = 3").count()
    assert build_index(changed, PERSON, ENCODER, root).encoded == number > 0
    assert stored(spark, root) == expected(changed)


def test_an_idle_build_writes_nothing(spark, people, tmp_path):
    root = tmp_path / "index"
    build_index(people, PERSON, ENCODER, str(root))
    before = sorted(p.name for p in root.iterdir())
    assert build_index(people, PERSON, ENCODER, str(root)).encoded == 0
    assert {p for p in (q.name for q in root.iterdir()) if "generation" in p or "pending" in p} <= set(before)
    assert IndexStore(spark, str(root)).generation() == 1


def test_another_encoder_makes_its_own_vectors(spark, people, tmp_path):
    root = str(tmp_path / "index")
    build_index(people, PERSON, NgramEncoder(name="old", dim=48), root)
    assert build_index(people, PERSON, ENCODER, root).encoded == 200
    assert stored(spark, root) == expected(people)


def test_text_changed_back_after_an_interrupted_run(spark, people, tmp_path):
    root = str(tmp_path / "index")
    build_index(people, PERSON, ENCODER, root)
    changed = people.withColumn("persona", F.concat(F.lit("new "), "persona")).where("age < 40")
    rows = encoded_rows(hashed_passages(changed, PERSON, ENCODER), ENCODER)
    rows.write.parquet(IndexStore(spark, root).pending_path(2))
    assert build_index(people, PERSON, ENCODER, root).encoded == 0
    assert stored(spark, root) == expected(people)


def test_ids_that_left_the_population_leave_the_index(spark, people, tmp_path):
    root = str(tmp_path / "index")
    build_index(people, PERSON, ENCODER, root)
    fewer = people.where("age < 70")
    assert build_index(fewer, PERSON, ENCODER, root).encoded == 0
    assert stored(spark, root) == expected(fewer)


def test_small_changes_write_little(spark, people, tmp_path):
    root = tmp_path / "index"
    build_index(people, PERSON, ENCODER, str(root), files=1)
    size = lambda g: sum(f.stat().st_size for f in (root / f"generation-{g}").glob("*.parquet"))
    ids = [r["uuid"] for r in people.select("uuid").orderBy("uuid").limit(6).collect()]
    rows, held = people, 200
    for g in (2, 3, 4):  # one text changes, then changes back while an id leaves, then the id returns
        if g == 2:
            rows = people.withColumn("persona", F.when(F.col("uuid") == ids[0], "someone else").otherwise(F.col("persona")))
        else:
            rows, held = (people.where(F.col("uuid") != ids[1]), 199) if g == 3 else (people, 200)
        report = build_index(rows, PERSON, ENCODER, str(root), files=1)
        assert (report.encoded, report.rows) == (1, held)
        assert IndexStore(spark, str(root)).newest() == (g, 1)
        assert stored(spark, str(root)) == expected(rows)
        assert spark.read.parquet(str(root / f"generation-{g}")).count() == 1
    info = index_info(spark, str(root)).first()
    assert info["rows"] == 200 and info["bytes"] == sum(map(size, (1, 2, 3, 4)))


def test_compaction_makes_a_new_base(spark, people, tmp_path):
    root = str(tmp_path / "index")
    build_index(people.where("age < 50"), PERSON, ENCODER, root)
    build_index(people, PERSON, ENCODER, root)
    store = IndexStore(spark, root)
    assert store.newest() == (3, 3)
    assert stored(spark, root) == expected(people)
    assert not store.compact()


def test_force_encodes_everything(spark, people, tmp_path):
    root = str(tmp_path / "index")
    build_index(people, PERSON, ENCODER, root)
    fewer = people.where("age < 50")
    report = build_index(fewer, PERSON, ENCODER, root, force=True, rounds=2)
    assert report.encoded == fewer.count()
    assert stored(spark, root) == expected(fewer)
    with pytest.raises(PythonException):
        build_index(people, PERSON, Failing(dim=48), root, force=True)
    assert stored(spark, root) == expected(fewer)


def test_refused_builds(spark, people, tmp_path):
    root = str(tmp_path / "index")
    with pytest.raises(ValueError):
        build_index(people.where("age < 0"), PERSON, ENCODER, root)
    with pytest.raises(ValueError):
        build_index(people, PERSON, ENCODER, root, limit=0)
    with pytest.raises(ValueError):
        build_index(people, PERSON, ENCODER, root, rounds=0)


def test_width_guard(spark, people, tmp_path):
    root = str(tmp_path / "index")
    build_index(people, PERSON, ENCODER, root)
    with pytest.raises(SparkRuntimeException, match="expected 384, found 48"):
        open_index(spark, root, 384).collect()


def test_search_by_text(spark, people, tmp_path):
    root = str(tmp_path / "index")
    build_index(people, PERSON, ENCODER, root)
    index = open_index(spark, root, ENCODER.dim)
    found = search(people, PERSON, index, 3, query="persona 77 hobbies", encoder=ENCODER).collect()
    scores = [r["score"] for r in found]
    assert len(found) == 3 and scores == sorted(scores, reverse=True)
    query = naive("query: persona 77 hobbies", 48).tolist()
    best = max(expected(people).items(), key=lambda item: (sum(x * y for x, y in zip(item[1], query)), item[0]))
    assert found[0]["uuid"] == best[0] or scores[0] == pytest.approx(scores[1])
    filtered = search(people, PERSON, index, 5, query="persona", encoder=ENCODER, filters={"sex": "여자"}).collect()
    assert len(filtered) == 5 and {r["sex"] for r in filtered} == {"여자"}


def test_stream(spark, people, tmp_path):
    source, root = str(tmp_path / "people"), str(tmp_path / "index")
    people.where("age < 60 OR age IS NULL").repartition(5).write.parquet(source)

    def run():
        stream = start_index_stream(spark, source, PERSON_SCHEMA, PERSON, ENCODER, root, files_per_trigger=2)
        stream.awaitTermination()
        publish_stream(spark, PERSON, PERSON_SCHEMA, root)
        return len([p for p in stream.recentProgress if p["numInputRows"]])

    assert run() == 3
    first = open_population(spark, source, PERSON_SCHEMA)
    assert stored(spark, root) == expected(first)
    assert run() == 0
    assert stored(spark, root) == expected(first)
    people.where("age >= 60").write.mode("append").parquet(source)
    assert run() >= 1
    assert stored(spark, root) == expected(people)
    # A batch build over the same index finds nothing left to do.
    assert build_index(people, PERSON, Failing(dim=48), root).encoded == 0


def test_shared_folder(spark):
    folder = shared_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir")) and folder != shared_folder(spark, "x")
