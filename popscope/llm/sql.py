"""The same queries in SQL, where SQL can express them."""

from __future__ import annotations

_TARGETS = r"""
    sized AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
               (('0x' || substr(md5('7:' || doc_id::VARCHAR), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
        FROM documents),
    per AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k
            FROM sized GROUP BY source),
    weighted AS (SELECT source, source_size, CASE k % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
                        2 * source_size AS cap, sum(source_size) OVER () AS everything FROM per),
    levels AS (
        SELECT *, (1.5::DOUBLE * everything
                   - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM weighted),
    targets AS (
        SELECT source, source_size, CASE WHEN cap / weight <= level THEN cap::DOUBLE
               ELSE max(level) FILTER (NOT cap / weight <= level) OVER () * weight END AS target FROM levels),
    shares AS (
        SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
               CASE WHEN source_size > 0 THEN target - floor(target / source_size) * source_size ELSE 0 END AS draw FROM targets)"""

_CONTROL = ("<|turn|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")


def _escaped(text):
    """The text with a backslash more for each backslash and control string."""
    text = f"replace({text}, '\\', '\\\\')"
    for mark in _CONTROL:
        text = f"replace({text}, '{mark}', '{mark[0]}\\{mark[1:]}')"
    return text


SQL = {
    "op2_pareto_mix": f"""
        WITH {_TARGETS},
        ranked AS (
            SELECT doc_id, s.source, size, source_size, target, whole, draw,
                   CASE WHEN draw > 0 THEN (u / (1 - u)) / ((draw / source_size) / (1 - draw / source_size)) END AS q
            FROM sized s JOIN shares t ON s.source IS NOT DISTINCT FROM t.source),
        fronts AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q) AS front FROM ranked),
        gaps AS (SELECT source, draw - coalesce(max(front) FILTER (front <= draw), 0) AS gap FROM fronts WHERE q IS NOT NULL
                 GROUP BY source, draw),
        nearest AS (
            SELECT f.source, f.q, abs(size - gap) AS off, gap,
                   row_number() OVER (PARTITION BY f.source ORDER BY abs(size - gap), f.q) AS k
            FROM fronts f JOIN gaps g ON f.source IS NOT DISTINCT FROM g.source WHERE q IS NOT NULL AND front > draw AND size > 0),
        closing AS (SELECT source, q AS closing_q FROM nearest WHERE k = 1 AND off < gap)
        SELECT doc_id, size, source_size, target,
               (size * (whole + CASE WHEN q IS NOT NULL AND (front <= draw OR coalesce(q = closing_q, FALSE)) THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM fronts f LEFT JOIN closing c ON f.source IS NOT DISTINCT FROM c.source""",
    "op4_url_cascade": """
        WITH cut AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
        parts AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
        rules(kind, rule_host, rule_path) AS (
            VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                   ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
        fits AS (
            SELECT page_id, kind, rule_host || rule_path AS rule,
                   row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS k
            FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
        SELECT p.page_id, host, path, rule, coalesce(kind, 'allow') AS verdict
        FROM parts p LEFT JOIN fits f ON p.page_id = f.page_id AND k = 1""",
    "op1_warc_revisit": """
        WITH marks AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
        coded AS (
            SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + (((instr('0123456789abcdef', hex[(5 * i) // 4 + 1]) - 1) * 16 + greatest(instr('0123456789abcdef', hex[(5 * i) // 4 + 2]) - 1, 0))
                     // (1 << (3 - (5 * i) % 4)::INTEGER)) % 32, 1)), '') AS payload_digest
            FROM marks),
        firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM coded)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to FROM firsts""",
    "op5_chat_spans": rf"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(17 + length(role) + length({_escaped('text')}))::BIGINT AS formatted_chars
        FROM turns GROUP BY conv_id""",
}

_TERMS = r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SQL["op11_reversed_search"] = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format('text')} AS terms FROM documents),
    totals AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms)) AS n_terms FROM d),
    wanted AS (SELECT item_id, term, count(*) AS repeats
               FROM (SELECT item_id, unnest({_TERMS.format('text')}) AS term FROM benchmark) GROUP BY item_id, term),
    tf AS (SELECT r, doc_id, len(terms) AS n, term, count(*) AS tf
           FROM (SELECT r, doc_id, terms, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM wanted)
           GROUP BY r, doc_id, len(terms), term),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    scored AS (
        SELECT item_id, doc_id, r,
               sum(repeats * floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT
                   * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS score
        FROM tf JOIN wanted USING (term) JOIN df USING (term), totals GROUP BY item_id, doc_id, r),
    ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
               FROM scored WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score FROM ranked WHERE rank <= 20"""
