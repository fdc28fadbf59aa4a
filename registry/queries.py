"""The queries. Each takes (spark, sf_dir) and returns a DataFrame over whole tables."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import popscope as ps
from popscope.functions.text import passage_text, row_summary, with_prefix
from popscope.functions.vectors import checked_width, dot, l2_normalize
from popscope.plans.clustered_search import build_clusters, pruned_topk
from popscope.sources.workspace import shared_folder
from registry.tables import (
    CONVERSATIONS,
    CUSTOMER,
    DOCUMENTS,
    EVENTS,
    LINEITEM,
    LINES,
    ORDERS,
    PART,
    SCHEMAS,
    given_index,
    table,
)

ENCODER = ps.NgramEncoder()
SEARCH_TEXT = "the order of then and there"
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
CUSTOMER_IDS = [3, 14, 15, 92, 65, 35, 89, 79, 999_999_999]
QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# Filters


@query
def filter_in_list(spark, sf):
    return ps.matching(table(spark, sf, "part"), PART, {"p_type": ["PROMO", "SMALL"], "p_brand": "Brand#2"})


@query
def filter_equals(spark, sf):
    closed = ps.PopulationSpec(
        id="c_custkey", columns=(ps.categorical("c_mktsegment", values=SEGMENTS, closed=True),)
    )
    return ps.matching(table(spark, sf, "customer"), closed, {"c_mktsegment": "BUILDING"})


@query
def filter_between(spark, sf):
    return ps.matching(table(spark, sf, "part"), PART, {"p_size_range": (10, 19)})


@query
def filter_contains_ci(spark, sf):
    return ps.matching(table(spark, sf, "part"), PART, {"p_name_contains": "WIDG"})


@query
def filter_conjunction(spark, sf):
    filters = {"p_type": ["PROMO", "ECONOMY", "LARGE"], "p_size_range": (1, 25), "p_name_contains": "e"}
    return ps.matching(table(spark, sf, "part"), PART, filters)


@query
def filter_none(spark, sf):
    return ps.matching(table(spark, sf, "part"), PART, {"p_type": []})


@query
def filter_contains_wildcard(spark, sf):
    rows = ps.matching(table(spark, sf, "documents"), DOCUMENTS, {"text_contains": "T_E%\\%"})
    more = ps.matching(table(spark, sf, "documents"), DOCUMENTS, {"text_contains": "a_ b%of"})
    return rows.select("doc_id", F.lit("backslash").alias("pattern")).unionByName(
        more.select("doc_id", F.lit("wildcard").alias("pattern"))
    )


@query
def filter_contains_literal(spark, sf):
    literal = ps.PopulationSpec(id="doc_id", columns=(ps.freetext("text", literal=True),))
    rows = table(spark, sf, "documents")
    return ps.matching(rows, literal, {"text_contains": "%"}).select("doc_id", F.lit("%").alias("word")).unionByName(
        ps.matching(rows, literal, {"text_contains": "_"}).select("doc_id", F.lit("_").alias("word"))
    )


@query
def count_matching(spark, sf):
    filters = {"o_orderstatus": ["F", "O"], "o_totalprice_range": (50_000, 300_000)}
    return ps.count_matching(table(spark, sf, "orders"), ORDERS, filters)


# Samples and panels


@query
def sample_seeded(spark, sf):
    return ps.sample(table(spark, sf, "orders"), ORDERS, 20, seed=42)


@query
def sample_filtered(spark, sf):
    filters = {"p_type": ["PROMO", "SMALL"], "p_size_range": (5, 40)}
    return ps.sample(table(spark, sf, "part"), PART, 15, filters, seed=7)


@query
def panel_category(spark, sf):
    return ps.panel(table(spark, sf, "customer"), CUSTOMER, 17, "segment", seed=42)


@query
def panel_decade(spark, sf):
    return ps.panel(table(spark, sf, "part"), PART, 10, "size_decade", seed=42)


@query
def panel_filtered(spark, sf):
    return ps.panel(table(spark, sf, "part"), PART, 20, "brand", {"p_size_range": (20, 39)}, seed=3)


@query
def panel_more_strata_than_n(spark, sf):
    return ps.panel(table(spark, sf, "documents"), DOCUMENTS, 7, "source", seed=42)


@query
def panel_exhausted(spark, sf):
    filters = {"c_nationkey": [1, 2, 3], "c_acctbal_range": (9_000, 9_100.0)}
    return ps.panel(table(spark, sf, "customer"), CUSTOMER, 20, "nation", filters, seed=1)


@query
def panel_unstratified(spark, sf):
    return ps.panel(table(spark, sf, "part"), PART, 12, seed=42)


@query
def sample_late(spark, sf):
    return ps.sample_late(table(spark, sf, "documents"), DOCUMENTS, 20, {"lang": ["en", "fr"]}, seed=42)


@query
def panel_late(spark, sf):
    return ps.panel_late(table(spark, sf, "documents"), DOCUMENTS, 20, "source", {"n_chars_range": (100, 10**9)}, seed=42)


@query
def sample_large(spark, sf):
    return ps.sample(table(spark, sf, "orders"), ORDERS, 5_000, seed=42)


@query
def sample_larger(spark, sf):
    """More rows than meet in one task."""
    return ps.sample(table(spark, sf, "orders"), ORDERS, 12_000, seed=11)


@query
def sample_lineitem(spark, sf):
    return ps.sample(table(spark, sf, "lineitem"), LINES, 30, {"l_returnflag": ["A", "R"]}, seed=42)


@query
def panel_large(spark, sf):
    return ps.panel(table(spark, sf, "orders"), ORDERS, 11_000, "priority", seed=42)


@query
def sample_unseeded(spark, sf):
    """Any thirty rows: how many, how many ids, and how many of them are known."""
    orders = table(spark, sf, "orders")
    drawn = ps.sample(orders, ORDERS, 30).select("o_orderkey")
    known = drawn.join(orders.select("o_orderkey", F.lit(1).alias("there")), "o_orderkey", "left")
    return known.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("o_orderkey").alias("ids"), F.count("there").alias("known")
    )


# Distribution


@query
def stats_category(spark, sf):
    return ps.stats(table(spark, sf, "part"), PART, "brand")


@query
def stats_decade_label(spark, sf):
    return ps.stats(table(spark, sf, "part"), PART, "size_decade")


@query
def stats_filtered(spark, sf):
    return ps.stats(table(spark, sf, "customer"), CUSTOMER, "segment", {"c_nationkey": [1, 5, 7], "c_acctbal_range": (0, 5_000)})


@query
def stats_limit(spark, sf):
    return ps.stats(table(spark, sf, "events"), EVENTS, "user", limit=5)


@query
def stats_all_buckets(spark, sf):
    return ps.stats(table(spark, sf, "events"), EVENTS, "user")


@query
def stats_lineitem(spark, sf):
    return ps.stats(table(spark, sf, "lineitem"), LINEITEM, "flag", {"l_quantity_range": (10, 30)})


@query
def describe_filters(spark, sf):
    rows = ps.describe_filters(table(spark, sf, "part"), PART)
    return rows.select(
        "name", "type", "description", F.array_join("allowed_values", ",").alias("allowed_values"),
        "range_min", "range_max", "cardinality", "total_records",
    )


# Lookups and row forms


@query
def get_by_id(spark, sf):
    return ps.get_by_id(table(spark, sf, "customer"), CUSTOMER, 77)


@query
def get_by_id_missing(spark, sf):
    return ps.get_by_id(table(spark, sf, "customer"), CUSTOMER, -1)


@query
def get_by_ids(spark, sf):
    return ps.get_by_ids(table(spark, sf, "customer"), CUSTOMER, CUSTOMER_IDS)


@query
def get_by_ids_filtered(spark, sf):
    ids = ps.matching(table(spark, sf, "orders"), ORDERS, {"o_orderstatus": "F"}).select("o_custkey")
    filters = {"c_mktsegment": ["BUILDING", "MACHINERY"]}
    return ps.get_by_ids(table(spark, sf, "customer"), CUSTOMER, ids, filters)


@query
def duplicate_ids(spark, sf):
    return ps.duplicate_ids(table(spark, sf, "lineitem"), LINEITEM)


@query
def row_summary_lines(spark, sf):
    line = row_summary(F.col("p_partkey"), PART.summary)
    return table(spark, sf, "part").select("p_partkey", line.alias("summary"))


@query
def rows_as_json(spark, sf):
    return ps.rows_as_json(table(spark, sf, "part"))


@query
def dataset_inventory(spark, sf):
    """Rows of every table, and whether it has files with anything in them."""
    found = None
    for name in SCHEMAS:
        row = ps.table_inventory(table(spark, sf, name))
        row = row.select(F.lit(name).alias("name"), "rows", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"))
        found = row if found is None else found.unionByName(row)
    return found


@query
def dataset_present(spark, sf):
    """The check that a table is there, and one that is not."""
    try:
        ps.open_population(spark, f"{sf}/no-such-table.parquet")
        missing = False
    except ps.DatasetMissingError:
        missing = True
    return table(spark, sf, "part").agg((F.count(F.lit(1)) > 0).alias("present")).withColumn("missing", F.lit(missing))


@query
def index_guard(spark, sf):
    """Vectors of the right width, and of a wrong one, as the index guard tells them."""
    index = given_index(spark, sf)
    fits = F.size("vec") == 64
    packed = ps.pack(index.where(fits), 64).select(checked_width(F.col("vec"), 64).alias("vec"))
    right, wrong = packed.select(F.lit(True).alias("fits")), index.where(~fits).select(F.lit(False).alias("fits"))
    return right.unionByName(wrong).agg(F.count_if("fits").alias("right"), F.count_if(~F.col("fits")).alias("wrong"))


# Vectors


@query
def vector_normalize(spark, sf):
    tripled = F.transform("vec", lambda x: x * F.lit(3).cast("float"))
    rows = given_index(spark, sf).select("id", l2_normalize(tripled).alias("vec"))
    return rows.select("id", F.posexplode("vec").alias("pos", "x")).select(
        "id", "pos", F.round(F.col("x").cast("double"), 5).alias("value")
    )


@query
def vector_dot(spark, sf):
    index = given_index(spark, sf)
    ones = F.array_repeat(F.lit(0.125), 64)
    return index.select("id", F.round(dot(F.col("vec"), ones), 6).alias("score"))


@query
def vector_topk(spark, sf):
    index = given_index(spark, sf)
    hits = ps.vector_topk(index, _first_vector(index), 20)
    return hits.select("id", F.round("score", 6).alias("score"))


@query
def vector_topk_cosine(spark, sf):
    index = given_index(spark, sf)
    hits = ps.vector_topk(index, _first_vector(index), 20, metric="cosine")
    return hits.select("id", F.round("score", 6).alias("score"))


@query
def vector_topk_batch(spark, sf):
    index = given_index(spark, sf)
    hits = ps.vector_topk_batch(index, _label_centres(spark, sf), 5)
    return hits.select("query_id", "id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


@query
def vector_topk_batch_k100(spark, sf):
    index = given_index(spark, sf)
    hits = ps.vector_topk_batch(index, _label_centres(spark, sf), 100)
    return hits.select("query_id", "id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


@query
def vector_topk_batch_cells(spark, sf):
    """The same in many small blocks of queries."""
    index = given_index(spark, sf)
    hits = ps.vector_topk_batch(index, _label_centres(spark, sf), 5, block_numbers=100)
    return hits.select("query_id", "id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


def _first_vector(index: DataFrame) -> list[float]:
    return index.where("id = 0").first()["vec"]


def _label_centres(spark: SparkSession, sf: str) -> DataFrame:
    """The mean vector of each label as query vectors."""
    values = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = values.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    # One struct per position: as many as a vector has numbers.
    ordered = F.array_sort(F.collect_list(F.struct("pos", "mean")))
    return means.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(ordered, lambda s: s["mean"]).alias("vec")
    )


@query
def search_pruned(spark, sf):
    """The 20 best vectors, reading only clusters whose bound reaches the 20th score."""
    index = given_index(spark, sf)
    clustered = build_clusters(index, _workspace(spark, "clusters"), clusters=16)
    hits, _ = pruned_topk(spark, clustered, _first_vector(index), 20)
    return hits.select("id", F.round("score", 6).alias("score"))


@query
def search_hydrated(spark, sf):
    """Rank, then hydrate: ids that are not in the population leave fewer rows."""
    return _search(spark, sf, mode="post")


@query
def search_hydrated_all(spark, sf):
    """The n best rows that are in the population, by a top-k that widens while ids dangle."""
    return _search(spark, sf, mode="pre")


@query
def search_post_filter(spark, sf):
    return _search(spark, sf, filters={"lang": "en", "n_chars_range": (500, 1_000_000)}, mode="post")


@query
def search_pre_filter(spark, sf):
    return _search(spark, sf, filters={"lang": "en", "n_chars_range": (500, 1_000_000)}, mode="pre")


@query
def search_late(spark, sf):
    return _search(spark, sf, ps.search_late, filters={"lang": "en", "n_chars_range": (500, 1_000_000)}, mode="post")


def _search(spark, sf, search=ps.search, **options):
    index = given_index(spark, sf)
    hits = search(table(spark, sf, "documents"), DOCUMENTS, index, 10, vector=_first_vector(index), **options)
    return hits.withColumn("score", F.round("score", 6))


# Encoding


@query
def passage_texts(spark, sf):
    text = with_prefix("passage: ", passage_text(DOCUMENTS.passage))
    return table(spark, sf, "documents").select("doc_id", text.alias("passage"))


@query
def passage_texts_conversations(spark, sf):
    text = with_prefix("passage: ", passage_text(CONVERSATIONS.passage))
    return table(spark, sf, "conversations").select("conv_id", "turn", text.alias("passage"))


@query
def encode_passages(spark, sf):
    vectors = ps.encode_passages(table(spark, sf, "documents"), DOCUMENTS, ENCODER)
    values = vectors.select("id", F.posexplode("vec").alias("pos", "x")).where("x <> 0")
    return values.select("id", F.col("pos").cast("long").alias("pos"), F.round(F.col("x").cast("double"), 6).alias("value"))


@query
def encode_query_search(spark, sf):
    documents = table(spark, sf, "documents")
    index = ps.encode_passages(documents, DOCUMENTS, ENCODER)
    hits = ps.search(documents, DOCUMENTS, index, 10, query=SEARCH_TEXT, encoder=ENCODER)
    return hits.withColumn("score", F.round("score", 6))


@query
def encode_queries_search(spark, sf):
    """Every benchmark text as a query against all documents."""
    index = ps.encode_passages(table(spark, sf, "documents"), DOCUMENTS, ENCODER)
    texts = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    hits = ps.vector_topk_batch(index, ps.encode_queries(texts, ENCODER), 3)
    return hits.select("query_id", "id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


# Index


def _workspace(spark: SparkSession, name: str) -> str:
    try:
        return shared_folder(spark, name)
    except ValueError:
        # Without a named folder only tasks in this process can share one.
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise
        return tempfile.mkdtemp(prefix=f"popscope-{name}-")


def _index_print(spark: SparkSession, root: str) -> DataFrame:
    """Id, width and a weighted sum of every vector in the index."""
    weighted = F.aggregate(
        F.transform("vec", lambda x, i: x.cast("double") * i), F.lit(0.0), lambda total, x: total + x
    )
    return ps.unpack(ps.open_index(spark, root, dim=ENCODER.dim), ENCODER.dim).select(
        "id", F.size("vec").cast("long").alias("width"), F.round(weighted, 5).alias("print")
    )


@query
def index_build_batch(spark, sf):
    root = _workspace(spark, "build")
    ps.build_index(table(spark, sf, "documents"), DOCUMENTS, ENCODER, root)
    return _index_print(spark, root)


@query
def index_build_resume(spark, sf):
    """A part first, then the rest in rounds."""
    root, documents = _workspace(spark, "resume"), table(spark, sf, "documents")
    ps.build_index(documents, DOCUMENTS, ENCODER, root, limit=100)
    ps.build_index(documents, DOCUMENTS, ENCODER, root, rounds=3)
    return _index_print(spark, root)


@query
def index_build_changed(spark, sf):
    """Some texts changed, and changed back after a run that did not publish."""
    root, documents = _workspace(spark, "changed"), table(spark, sf, "documents")
    changed = documents.withColumn("text", F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("new "), "text")).otherwise(F.col("text")))
    ps.build_index(documents, DOCUMENTS, ENCODER, root)
    ps.build_index(changed, DOCUMENTS, ENCODER, root)
    ps.build_index(documents.where("doc_id % 5 <> 0"), DOCUMENTS, ENCODER, root)
    ps.build_index(documents, DOCUMENTS, ENCODER, root)
    return _index_print(spark, root)


@query
def index_build_subset(spark, sf):
    root = _workspace(spark, "subset")
    ps.build_index(table(spark, sf, "documents"), DOCUMENTS, ENCODER, root, limit=150)
    return _index_print(spark, root)


@query
def index_build_force(spark, sf):
    root, documents = _workspace(spark, "force"), table(spark, sf, "documents")
    ps.build_index(documents, DOCUMENTS, ENCODER, root)
    ps.build_index(documents, DOCUMENTS, ENCODER, root, force=True)
    return _index_print(spark, root)


@query
def index_build_stream(spark, sf):
    root, schema = _workspace(spark, "stream"), table(spark, sf, "documents").schema
    # A pattern, as a stream takes no single file by its path; the table may also be a folder of files.
    stream = ps.start_index_stream(
        spark, f"{sf}/documents.parque[t]", schema, DOCUMENTS, ENCODER, root, file_filter="*"
    )
    stream.awaitTermination()
    ps.publish_stream(spark, DOCUMENTS, schema, root)
    return _index_print(spark, root)


@query
def index_info(spark, sf):
    root = _workspace(spark, "info")
    ps.build_index(table(spark, sf, "documents"), DOCUMENTS, ENCODER, root)
    return ps.index_info(spark, root).select("exists", "rows", (F.col("bytes") > 0).alias("has_bytes"))
