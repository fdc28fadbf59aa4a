import random

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from popscope.llm.common import table
from popscope.llm.url_cascade import RULES, build_cascade, judge_urls


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, kind) for kind, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


ODD = [
    None, "", "no scheme/x", "http://", "http://ORG/x", "http://a.b.org", "http://a.b.org/", "https://Example.ORG/es/1?x=/fr/", "http://org./", "http://.org/",
    "http://x.com#/fr/", "http://x.com/fr/", "http://x.com/FR/", "http://xcom/fr/", "http://comcom.com/de/a/b", "a://b://c.com/fr/", "http://é.com/de/é\n", "http://x.com/de/\r\n",
    "http://example.org/en/1", "http://example.org/en/", "http://notexample.org/en/1", "http://" + "a." * 500 + "com/de/",
]


def test_odd_urls(spark):
    rows = [(i, u, None) for i, u in enumerate(ODD)] * 2 + [(None, "http://a.org/", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("host", "path", "keys", "best", "rule")})
    found = judge_urls(pages).collect()
    assert len(found) == len(rows)
    for r in found:
        url = "http://a.org/" if r.page_id is None else ODD[r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == plain(url, RULES), url


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", None)], "page_id long, url string, html string")
    assert [r.verdict for r in judge_urls(pages, ()).collect()] == ["allow"]
    assert judge_urls(pages.limit(0)).collect() == []


def test_many_rules(spark):
    pages = table(spark, TESTDATA, "pages")
    urls = {r.page_id: r.url for r in pages.collect()}
    draw, rules = random.Random(2), set()
    for url in urls.values():
        host, path, _, _ = plain(url, ())
        rules.add((draw.choice(["allow", "block"]), ".".join(host.split(".")[-draw.randint(1, 4) :]), path[: draw.randint(1, 5)]))
    rules = [r for r in rules if r[0] == "block" or ("block", *r[1:]) not in rules]
    for r in judge_urls(pages, tuple(rules)).collect():
        assert (r.host, r.path, r.rule, r.verdict) == plain(urls[r.page_id], rules)


@pytest.mark.parametrize("listed", [0, 1, 300, 2000])
def test_cascade_is_exact_over_its_universe(spark, listed):
    keys = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = build_cascade(keys.limit(0) if not listed else keys.where(F.col("key").isin([f"k{i}" for i in range(listed)])), keys)
    held = {r.key for r in keys.where(cascade.holds(F.col("key"))).collect()}
    assert held == {f"k{i}" for i in range(listed)}


def test_no_python(spark):
    plan = judge_urls(table(spark, TESTDATA, "pages"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan
