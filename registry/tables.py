"""Specs of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popscope import Dimension, PopulationSpec, categorical, freetext, number_range, open_population

PART = PopulationSpec(
    id="p_partkey",
    columns=(
        categorical("p_type", "Kind of part"),
        categorical("p_brand", "Brand"),
        number_range("p_size", "Size", bounds=(1, 50), whole=True),
        freetext("p_name", "Name"),
    ),
    strata={"type": Dimension("p_type"), "brand": Dimension("p_brand"), "size_decade": Dimension("p_size", decades=True)},
    dimensions={
        "type": Dimension("p_type"),
        "brand": Dimension("p_brand"),
        "name": Dimension("p_name"),
        "size_decade": Dimension("p_size", decades=True, suffix="대"),
    },
    passage=("p_name", "p_type", "p_brand"),
    summary=("p_brand", "p_size", "p_type", "p_name", "p_brand"),
)

CUSTOMER = PopulationSpec(
    id="c_custkey",
    columns=(
        categorical("c_mktsegment", "Market segment"),
        categorical("c_nationkey", "Nation"),
        number_range("c_acctbal", "Balance"),
        freetext("c_name", "Name"),
    ),
    strata={"segment": Dimension("c_mktsegment"), "nation": Dimension("c_nationkey")},
    dimensions={"segment": Dimension("c_mktsegment"), "nation": Dimension("c_nationkey")},
)

ORDERS = PopulationSpec(
    id="o_orderkey",
    columns=(
        categorical("o_orderstatus", "Status"),
        categorical("o_orderpriority", "Priority"),
        number_range("o_totalprice", "Price"),
    ),
    strata={"status": Dimension("o_orderstatus"), "priority": Dimension("o_orderpriority")},
    dimensions={"status": Dimension("o_orderstatus"), "priority": Dimension("o_orderpriority")},
)

EVENTS = PopulationSpec(
    id="event_id",
    columns=(categorical("event_type", "Type"), number_range("value", "Value"), freetext("props", "Properties")),
    strata={"type": Dimension("event_type")},
    dimensions={"type": Dimension("event_type"), "user": Dimension("user_id")},
)

LINEITEM = PopulationSpec(
    id="l_orderkey",
    columns=(categorical("l_returnflag", "Return flag"), number_range("l_quantity", "Quantity")),
    dimensions={"flag": Dimension("l_returnflag"), "line": Dimension("l_linenumber", decades=True)},
)

# Its rows are told apart by two columns.
LINES = PopulationSpec(id=("l_orderkey", "l_linenumber"), columns=LINEITEM.columns)

DOCUMENTS = PopulationSpec(
    id="doc_id",
    columns=(
        categorical("lang", "Language"),
        categorical("source", "Source"),
        number_range("n_chars", "Length", whole=True),
        freetext("text", "Text"),
    ),
    strata={"lang": Dimension("lang"), "source": Dimension("source")},
    dimensions={"lang": Dimension("lang"), "source": Dimension("source")},
    passage=("lang", "source", "text"),
)

CONVERSATIONS = PopulationSpec(id="conv_id", passage=("role", "text"))


# Given, so that opening a table needs no job to find its columns.
SCHEMAS = {
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "conversations": "conv_id long, turn long, role string, text string",
    "benchmark": "item_id long, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return open_population(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name])


def given_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given embeddings in the form of a vector index."""
    rows = table(spark, sf_dir, "embeddings")
    return rows.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
