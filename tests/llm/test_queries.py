"""The registered queries of this folder, on the smallest tables."""

import pytest
from check_queries import compare, connect
from conftest import TESTDATA

from __spark_entry__ import oracle_sql, queries
from popscope.llm.queries import QUERIES
from popscope.llm.sql import SQL

COLUMNS = {
    "op1": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    "op2": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op3": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string",
            "near_edited": "double", "near_next": "double"},
    "op4": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op5": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint"},
    "op6": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op7": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op8": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op9": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op10": {"doc_id": "bigint", "item_id": "bigint"},
    "op12": {"doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "n_best": "bigint", "count_sum": "bigint",
             "groups_sha256": "string"},
    "op13": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op11": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
}
ROWS = {"op1": "pages", "op4": "pages", "op2": "documents", "op3": "documents", "op6": "documents", "op7": "documents", "op8": "documents", "op9": "documents", "op12": "documents", "op13": "documents"}


def test_all_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == set(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    assert compare(spark, connect(TESTDATA), TESTDATA, name) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_columns_and_rows(spark, name):
    found, number = queries()[name](spark, TESTDATA), name.split("_")[0]
    kinds = dict(found.dtypes)
    assert {c: kinds[c] for c in COLUMNS[number]} == COLUMNS[number]
    if number in ROWS:
        assert found.count() == spark.read.parquet(f"{TESTDATA}/{ROWS[number]}.parquet").count()
