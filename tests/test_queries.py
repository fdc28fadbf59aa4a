"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from check_queries import compare, connect
from conftest import TESTDATA

from __spark_entry__ import entry, oracle_sql, queries
from registry.queries import QUERIES
from registry.sql import SQL


@pytest.fixture(scope="module")
def con():
    return connect(TESTDATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, TESTDATA, name) is None


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    rows = entry(spark)
    assert rows.dtypes == [("value", "string"), ("count", "bigint")] and rows.count() > 0


def test_stream_over_a_folder_of_files(spark, tmp_path):
    rows = spark.range(20).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang", "'s' AS source", "6L AS n_chars")
    rows.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    rows.withColumn("doc_id", rows.doc_id + 100).write.parquet(str(tmp_path / "other.parquet"))
    found = QUERIES["index_build_stream"](spark, str(tmp_path))
    assert sorted(r["id"] for r in found.collect()) == list(range(20))
