import hashlib
import re

from conftest import TESTDATA
from hypothesis import given, settings
from hypothesis import strategies as st

from popscope.llm.common import table
from popscope.llm.pii import find_pii

from .conftest import ODD_DOCUMENTS

KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    spans = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(PATTERNS[kind], text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            spans.append((m.start(), k, m.end()))
    return sorted(spans)


def shown(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def check(rows, texts):
    assert len(rows) == len(texts)
    for row in rows:
        spans = base(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(shown(spans).encode()).hexdigest(), row
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert set(filter(None, shown(spans).split(","))) <= set(row.spans.split(","))


def test_against_plain_expressions(spark):
    docs = table(spark, TESTDATA.replace("0.001", "0.01"), "documents")
    check(find_pii(docs).collect(), {r.doc_id: r.text for r in docs.collect()})


PIECES = ["a@b.c", "_d@e.f", "@", ".", " ", "-", "+1 (555) 010-9999", "+", "(", "4111 1111 1111 1111", "4111-1111", "1.2.3.4", ".5.6.7.8",
          "256.1.1.1", "0099.1.2.3", "é", "🙂", "x", "9" * 40, "12", "\n", "a.b-c@d-e.f-g.h"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), min_size=60, max_size=80))
def test_against_plain_expressions_on_odd_texts(spark, texts):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    check(find_pii(docs).collect(), dict(enumerate(texts)))


def test_context_finds_what_the_expressions_miss(spark):
    texts = [f"story {i} please call me at +1 (555) 010-{1000 + i} today" for i in range(12)]
    texts += ["later please call me at (555) 010-7777 today", "the year of 2001 0405 1999 was long", "lot 555 010 7777 4"]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    rows = {r.doc_id: r for r in find_pii(docs).collect()}
    start = texts[12].index("(555)")
    assert rows[12].added == f"phone:{start}:{start + 14}" and rows[12].spans == rows[12].added
    assert all(not rows[i].added for i in rows if i != 12)


def test_long_runs_end(spark):
    texts = ["a" * 200_000 + " 1" * 20_000, "a@" + "b." * 30_000 + "c", "9" * 100_000, "+" + "1 " * 50_000 + "x"]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    check(find_pii(docs).collect(), dict(enumerate(texts)))


def test_odd_rows(clashing, empty):
    rows = find_pii(clashing).collect()
    assert len(rows) == len(ODD_DOCUMENTS) and all(r.spans == "" for r in rows)
    assert find_pii(empty).collect() == []


def added_numbers(spark, texts):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    return {r.doc_id for r in find_pii(docs).collect() if r.added}


def test_more_unseen_identifiers_than_seeds(spark):
    seeds = [f"x{i} please ring +1 (555) 010-{1000 + i} y{i}" for i in range(20)]
    unseen = [f"x{i} please ring (555) 020-{1000 + i} y{i}" for i in range(60)]
    assert added_numbers(spark, seeds + unseen) == set(range(20, 80))


def test_three_seeds_are_not_enough(spark):
    for n, found in ((3, set()), (4, {4})):
        seeds = [f"x{i} please ring +1 (555) 010-{1000 + i} y{i}" for i in range(n)]
        assert added_numbers(spark, [*seeds, "x please ring (555) 020-1000 y"]) == found


def test_a_chain_of_patterns(spark):
    texts = [f"x{i} hop zero +1 (555) 010-{1000 + i} y{i}" for i in range(60)]
    names = ["zero", "one", "two", "three", "four", "five"]
    for hop in range(5):
        for i in range(40):
            number = f"(555) 0{20 + hop}-{1000 + i}"
            texts += [f"x{hop}.{i} hop {names[hop]} {number} y{hop}.{i}", f"v{hop}.{i} hop {names[hop + 1]} {number} w{hop}.{i}"]
    assert added_numbers(spark, texts) == set(range(60, len(texts)))
