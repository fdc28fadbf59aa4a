"""The same queries in SQL."""

from __future__ import annotations

from registry.queries import CUSTOMER_IDS, SEARCH_TEXT
from registry.tables import SCHEMAS


def _sample(table, id, seed, n, where="TRUE"):
    return f"SELECT * FROM {table} WHERE {where} ORDER BY md5(concat('{seed}:', {id})), {id} LIMIT {n}"


def _panel(table, id, stratum, seed, n, where="TRUE"):
    return f"""
        WITH numbered AS (
            SELECT *, row_number() OVER (PARTITION BY {stratum} ORDER BY md5(concat('{seed}:a:', {id})), {id}) AS rn
            FROM {table} WHERE {where})
        SELECT * EXCLUDE (rn) FROM numbered ORDER BY rn, md5(concat('{seed}:b:', {id})), {id} LIMIT {n}"""


def _stats(table, value, limit=None, where="TRUE"):
    return f"""SELECT CAST({value} AS VARCHAR) AS value, count(*) AS count FROM {table} WHERE {where}
        GROUP BY 1 ORDER BY 2 DESC, 1 {f"LIMIT {limit}" if limit else ""}"""


def _dot(a, b):
    return f"list_dot_product({a}::DOUBLE[], {b}::DOUBLE[])"


def _encoded(texts, name="coded"):
    """Common table expressions that encode (id, t) rows into (id, pos, value)."""
    return f"""
        {name}_points AS (
            SELECT id, unicode(unnest(string_split(t, '')))::BIGINT AS c,
                   generate_subscripts(string_split(t, ''), 1) AS place FROM ({texts})),
        {name}_mixed AS (
            SELECT id, c * 7919 + lead(c, 1) OVER w * 104729 + lead(c, 2) OVER w * 1299709 AS m
            FROM {name}_points WINDOW w AS (PARTITION BY id ORDER BY place)),
        {name}_counts AS (
            SELECT id, m % 1000003 % 384 AS pos, sum(1 - 2 * (m // 1000003 % 2)) AS n
            FROM {name}_mixed WHERE m IS NOT NULL GROUP BY 1, 2),
        {name}_norms AS (SELECT id, sqrt(sum(n * n)) AS norm FROM {name}_counts GROUP BY 1),
        {name} AS MATERIALIZED (
            SELECT id, pos, (n / norm)::FLOAT::DOUBLE AS value
            FROM {name}_counts JOIN {name}_norms USING (id) WHERE n <> 0)"""


def _dense(name, id, table):
    """The encoded rows as whole vectors."""
    return f"""
        {name}_dense AS MATERIALIZED (
            SELECT i.id, list(coalesce(value, 0) ORDER BY p.pos) AS vec
            FROM (SELECT {id} AS id FROM {table}) i CROSS JOIN (SELECT unnest(range(384)) AS pos) p
            LEFT JOIN {name} v ON v.id = i.id AND v.pos = p.pos GROUP BY 1)"""


_PASSAGE = "'passage: ' || concat_ws(' ', nullif(lang, ''), nullif(source, ''), nullif(text, ''))"
_DOCUMENTS = f"SELECT doc_id AS id, {_PASSAGE} AS t FROM documents"
_PRINT = "SELECT id, 384::BIGINT AS width, round(sum(pos * value), 5) AS print FROM coded GROUP BY id"
_QUERY = "(SELECT embedding FROM embeddings WHERE vec_id = 0)"
_FILTER = "lang = 'en' AND n_chars BETWEEN 500 AND 1000000"
_CENTRES = """
    means AS (
        SELECT label, pos, avg(x) AS mean FROM (
            SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
        GROUP BY 1, 2),
    centres AS (SELECT label AS query_id, list(mean ORDER BY pos) AS vec FROM means GROUP BY 1)"""
_BATCH = f"""
    WITH {_CENTRES},
    scored AS (
        SELECT query_id, vec_id AS id, {_dot('embedding', 'vec')} AS score FROM embeddings CROSS JOIN centres),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM scored)
    SELECT query_id, id, rank, round(score, 6) AS score FROM ranked WHERE rank <= 5"""


_INVENTORY = " UNION ALL ".join(
    f"SELECT '{name}' AS name, count(*) AS rows, TRUE AS has_files, TRUE AS has_bytes FROM {name}" for name in SCHEMAS
)


def _search(hits, where="TRUE", n=10):
    return f"""
        WITH scored AS (SELECT vec_id, {_dot('embedding', _QUERY)} AS s FROM embeddings),
        hits AS ({hits})
        SELECT d.*, round(s, 6) AS score FROM hits JOIN documents d ON doc_id = vec_id
        WHERE {where} ORDER BY s DESC, doc_id LIMIT {n}"""


SQL = {
    "filter_in_list": "SELECT * FROM part WHERE p_type IN ('PROMO', 'SMALL') AND p_brand IN ('Brand#2')",
    "filter_equals": "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'",
    "filter_between": "SELECT * FROM part WHERE p_size BETWEEN 10 AND 19",
    "filter_contains_ci": "SELECT * FROM part WHERE p_name ILIKE '%WIDG%'",
    "filter_conjunction": """SELECT * FROM part WHERE p_type IN ('PROMO', 'ECONOMY', 'LARGE')
        AND p_size BETWEEN 1 AND 25 AND p_name ILIKE '%e%'""",
    "filter_none": "SELECT * FROM part",
    "filter_contains_wildcard": r"""
        SELECT doc_id, 'backslash' AS pattern FROM documents WHERE text ILIKE '%T_E%\%%'
        UNION ALL SELECT doc_id, 'wildcard' FROM documents WHERE text ILIKE '%a_ b%of%'""",
    "filter_contains_literal": """
        SELECT doc_id, '%' AS word FROM documents WHERE contains(lower(text), '%')
        UNION ALL SELECT doc_id, '_' FROM documents WHERE contains(lower(text), '_')""",
    "count_matching": """SELECT count(*) AS n FROM orders
        WHERE o_orderstatus IN ('F', 'O') AND o_totalprice BETWEEN 50000 AND 300000""",
    "sample_seeded": _sample("orders", "o_orderkey", 42, 20),
    "sample_large": _sample("orders", "o_orderkey", 42, 5_000),
    "sample_larger": _sample("orders", "o_orderkey", 11, 12_000),
    "sample_lineitem": """SELECT * FROM lineitem WHERE l_returnflag IN ('A', 'R')
        ORDER BY md5(concat('42:', l_orderkey, ':', l_linenumber)), l_orderkey, l_linenumber LIMIT 30""",
    "panel_large": _panel("orders", "o_orderkey", "o_orderpriority", 42, 11_000),
    "sample_unseeded": "SELECT least(30, count(*)) AS rows, least(30, count(*)) AS ids, least(30, count(*)) AS known FROM orders",
    "dataset_inventory": _INVENTORY,
    "dataset_present": "SELECT TRUE AS present, TRUE AS missing",
    "index_guard": "SELECT count(*) FILTER (len(embedding) = 64) AS right, count(*) FILTER (len(embedding) <> 64) AS wrong FROM embeddings",
    "sample_filtered": _sample("part", "p_partkey", 7, 15, "p_type IN ('PROMO', 'SMALL') AND p_size BETWEEN 5 AND 40"),
    "panel_category": _panel("customer", "c_custkey", "c_mktsegment", 42, 17),
    "panel_decade": _panel("part", "p_partkey", "p_size - p_size % 10", 42, 10),
    "panel_filtered": _panel("part", "p_partkey", "p_brand", 3, 20, "p_size BETWEEN 20 AND 39"),
    "panel_more_strata_than_n": _panel("documents", "doc_id", "source", 42, 7),
    "panel_exhausted": _panel(
        "customer", "c_custkey", "c_nationkey", 1, 20, "c_nationkey IN (1, 2, 3) AND c_acctbal BETWEEN 9000 AND 9100"
    ),
    "panel_unstratified": _sample("part", "p_partkey", 42, 12),
    "sample_late": _sample("documents", "doc_id", 42, 20, "lang IN ('en', 'fr')"),
    "panel_late": _panel("documents", "doc_id", "source", 42, 20, "n_chars BETWEEN 100 AND 1000000000"),
    "stats_category": _stats("part", "p_brand"),
    "stats_decade_label": _stats("part", "(p_size - p_size % 10)::VARCHAR || '대'"),
    "stats_filtered": _stats("customer", "c_mktsegment", None, "c_nationkey IN (1, 5, 7) AND c_acctbal BETWEEN 0 AND 5000"),
    "stats_limit": _stats("events", "user_id", 5),
    "stats_all_buckets": _stats("events", "user_id"),
    "stats_lineitem": _stats("lineitem", "l_returnflag", None, "l_quantity BETWEEN 10 AND 30"),
    "describe_filters": """
        SELECT 'p_type' AS name, 'categorical' AS type, 'Kind of part' AS description,
               string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS allowed_values,
               NULL::DOUBLE AS range_min, NULL::DOUBLE AS range_max,
               count(DISTINCT p_type) AS cardinality, count(*) AS total_records FROM part
        UNION ALL
        SELECT 'p_brand', 'categorical', 'Brand', string_agg(DISTINCT p_brand, ',' ORDER BY p_brand), NULL, NULL,
               count(DISTINCT p_brand), count(*) FROM part
        UNION ALL
        SELECT 'p_size', 'range', 'Size', NULL, min(p_size)::DOUBLE, max(p_size)::DOUBLE, NULL, count(*) FROM part
        UNION ALL
        SELECT 'p_name', 'freetext', 'Name', NULL, NULL, NULL, NULL, count(*) FROM part""",
    "get_by_id": "SELECT * FROM customer WHERE c_custkey = 77 LIMIT 1",
    "get_by_id_missing": "SELECT * FROM customer WHERE c_custkey = -1 LIMIT 1",
    "get_by_ids": f"SELECT * FROM customer WHERE c_custkey IN ({', '.join(map(str, CUSTOMER_IDS))})",
    "get_by_ids_filtered": """SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
        AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
    "duplicate_ids": "SELECT l_orderkey, count(*) AS count FROM lineitem GROUP BY 1 HAVING count(*) > 1",
    "row_summary_lines": """SELECT p_partkey, printf('[%s] %s %s세 / %s %s / %s', substr(p_partkey::VARCHAR, 1, 8),
        p_brand, p_size::VARCHAR, p_type, p_name, p_brand) AS summary FROM part""",
    "rows_as_json": "SELECT to_json(part)::VARCHAR AS json FROM part",
    "vector_normalize": """
        WITH tripled AS (SELECT vec_id AS id, list_transform(embedding, lambda x: (x * 3::FLOAT)::DOUBLE) AS v FROM embeddings),
        normed AS (SELECT id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM tripled)
        SELECT id, (unnest(generate_series(1, len(v))) - 1)::INTEGER AS pos,
               round(unnest(list_transform(v, lambda x: (x / norm)::FLOAT::DOUBLE)), 5) + 0.0::DOUBLE AS value FROM normed""",
    "vector_dot": "SELECT vec_id AS id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * 0.125)), 6) AS score FROM embeddings",
    "vector_topk": f"""SELECT vec_id AS id, round({_dot('embedding', _QUERY)}, 6) AS score FROM embeddings
        ORDER BY {_dot('embedding', _QUERY)} DESC, vec_id LIMIT 20""",
    "search_pruned": f"""SELECT vec_id AS id, round({_dot('embedding', _QUERY)}, 6) AS score FROM embeddings
        ORDER BY {_dot('embedding', _QUERY)} DESC, vec_id LIMIT 20""",
    "vector_topk_cosine": f"""
        WITH q AS (SELECT embedding AS v FROM embeddings WHERE vec_id = 0),
        scored AS (
            SELECT vec_id AS id, {_dot('embedding', 'v')} / sqrt({_dot('embedding', 'embedding')} * {_dot('v', 'v')}) AS s
            FROM embeddings, q)
        SELECT id, round(s, 6) AS score FROM scored ORDER BY s DESC, id LIMIT 20""",
    "vector_topk_batch": _BATCH,
    "vector_topk_batch_cells": _BATCH,
    "vector_topk_batch_k100": _BATCH.replace("rank <= 5", "rank <= 100"),
    "search_hydrated": _search("SELECT * FROM scored ORDER BY s DESC, vec_id LIMIT 10"),
    "search_hydrated_all": _search("SELECT * FROM scored"),
    "search_post_filter": _search("SELECT * FROM scored ORDER BY s DESC, vec_id LIMIT 100", _FILTER),
    "search_late": _search("SELECT * FROM scored ORDER BY s DESC, vec_id LIMIT 100", _FILTER),
    "search_pre_filter": _search("SELECT * FROM scored", _FILTER),
    "passage_texts": f"SELECT doc_id, {_PASSAGE} AS passage FROM documents",
    "passage_texts_conversations": """SELECT conv_id, turn,
        'passage: ' || concat_ws(' ', nullif(role, ''), nullif(text, '')) AS passage FROM conversations""",
    "encode_passages": f"WITH {_encoded(_DOCUMENTS)} SELECT id, pos, round(value, 6) AS value FROM coded",
    "encode_query_search": f"""
        WITH {_encoded(_DOCUMENTS)}, {_encoded(f"SELECT 0 AS id, 'query: {SEARCH_TEXT}' AS t", "asked")},
        hits AS (SELECT c.id, sum(c.value * a.value ORDER BY c.pos) AS s FROM coded c JOIN asked a USING (pos) GROUP BY 1
                 ORDER BY 2 DESC, 1 LIMIT 10)
        SELECT d.*, round(s, 6) AS score FROM hits JOIN documents d ON doc_id = hits.id""",
    "encode_queries_search": f"""
        WITH {_encoded(_DOCUMENTS)}, {_dense("coded", "doc_id", "documents")},
        {_encoded("SELECT item_id AS id, 'query: ' || text AS t FROM benchmark", "asked")},
        {_dense("asked", "item_id", "benchmark")},
        scored AS (SELECT a.id AS query_id, c.id, {_dot('c.vec', 'a.vec')} AS s
                   FROM coded_dense c CROSS JOIN asked_dense a),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM scored)
        SELECT query_id, id, rank, round(s, 6) AS score FROM ranked WHERE rank <= 3""",
    "index_build_batch": f"WITH {_encoded(_DOCUMENTS)} {_PRINT}",
    "index_build_resume": f"WITH {_encoded(_DOCUMENTS)} {_PRINT}",
    "index_build_force": f"WITH {_encoded(_DOCUMENTS)} {_PRINT}",
    "index_build_stream": f"WITH {_encoded(_DOCUMENTS)} {_PRINT}",
    "index_build_changed": f"WITH {_encoded(_DOCUMENTS)} {_PRINT}",
    "index_build_subset": f"WITH {_encoded(_DOCUMENTS + ' ORDER BY doc_id LIMIT 150')} {_PRINT}",
    "index_info": "SELECT TRUE AS exists, count(*) AS rows, TRUE AS has_bytes FROM documents",
}
