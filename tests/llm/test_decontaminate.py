import random

import pyarrow as pa
import pytest

from conftest import TESTDATA

from popscope.llm.common import table
from popscope.llm.decontaminate import Items, contaminated, edit_distance, without_items, words_of

from .conftest import lower_ascii, words


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_found(text, item):
    t, i = words(lower_ascii(text or "")), words(lower_ascii(item or ""))
    n = len(i)
    if not n or not t:
        return None
    best = min(plain_distance(i, t[s : s + n]) for s in range(max(1, len(t) - n + 1)))
    return best if best <= n // 4 else None


def test_distance():
    draw = random.Random(3)
    for _ in range(300):
        a, b = ([draw.choice("abcd") for _ in range(draw.randint(1, 90))] for _ in range(2))
        x, y = words_of([" ".join(a), " ".join(b)])
        masks = {}
        for place, w in enumerate(x.tolist()):
            masks[w] = masks.get(w, 0) | 1 << place
        assert edit_distance(masks, len(a), y) == plain_distance(a, b)


def test_given_tables(spark):
    docs, items = table(spark, TESTDATA, "documents"), table(spark, TESTDATA, "benchmark")
    found = {(r.doc_id, r.item_id): r.distance for r in contaminated(docs, items).collect()}
    whole = {i.item_id: lower_ascii(i.text) for i in items.collect()}
    inside = {(d.doc_id, i) for d in docs.collect() for i, t in whole.items() if f" {' '.join(words(t))} " in f" {' '.join(words(lower_ascii(d.text)))} "}
    assert inside and {key for key, distance in found.items() if distance == 0} == inside
    left = {r.doc_id for r in without_items(docs, items).collect()}
    assert left == {r.doc_id for r in docs.select("doc_id").collect()} - {d for d, _ in found}


def edited(draw, item, edits):
    out = list(item)
    for _ in range(edits):
        at = draw.randrange(len(out))
        kind = draw.randrange(3)
        if kind == 0:
            out[at] = f"new{draw.randrange(99)}"
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out.insert(at, f"new{draw.randrange(99)}")
    return out


def test_recall_and_exactness(spark):
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.choice([1, 2, 4, 8, 9, 15, 30, 60, 80])))) for i in range(60)]
    texts = []
    for n in range(300):
        item = words(items[draw.randrange(60)][1])
        body = edited(draw, item, draw.randint(0, len(item) // 4 + 1))
        around = [draw.choices(vocabulary, k=draw.randint(0, 30)) for _ in range(2)]
        texts.append((n, " ".join([*around[0], *body, *around[1]]), None, None, None))
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    bench = spark.createDataFrame(items, "item_id long, text string")
    truth = {(d[0], i): plain_found(d[1], t) for d in texts for i, t in items}
    truth = {key: distance for key, distance in truth.items() if distance is not None}
    found = {(r.doc_id, r.item_id): r.distance for r in contaminated(docs, bench).collect()}
    assert set(found) <= set(truth)
    assert len(found) >= 0.98 * len(truth)
    assert sum(found[key] == truth[key] for key in found) >= 0.98 * len(found)


def test_odd_rows(spark, odd, clashing, empty, make):
    items = make("benchmark", [(1, "A B c d e x g"), (2, None), (3, ""), (4, "no ID here at all"), (None, "日本語のテキスト")])
    found = {(r.doc_id, r.item_id, r.distance) for r in contaminated(odd, items).collect()}
    assert found == {(1, 1, 1), (5, 1, 1), (None, 4, 0), (9, None, 0)}
    left = without_items(clashing, items)
    assert left.columns == clashing.columns and left.count() == clashing.count() - 5
    assert contaminated(empty, items).count() == 0 and contaminated(odd, make("benchmark", [])).count() == 0


def test_items_fit_words():
    block = Items([1, 2], ["a b c", None])
    assert block.ids == [1] and block.need.tolist() == [2]


@pytest.mark.parametrize("n", [15, 60, 100, 200, 400])
@pytest.mark.parametrize("spread", [True, False])
def test_all_at_the_largest_distance(n, spread):
    draw = random.Random(n)
    items = [[f"i{i}w{draw.randrange(4 * n)}" for _ in range(n)] for i in range(30)]
    texts = []
    for item in items:
        body = list(item)
        for at in [4 * e + 1 for e in range(n // 4)] if spread else draw.sample(range(n), n // 4):
            body[at] = f"new{draw.randrange(10**6)}"
        texts.append(" ".join(["before"] * 3 + body + ["after"] * 2))
    found = Items(list(range(30)), [" ".join(item) for item in items]).found(pa.array(texts))
    assert found == {i: {i: (n // 4, 3)} for i in range(30)}


def test_item_ids_of_other_types(spark, make):
    from popscope.llm.decontaminate import contaminated

    passage = "the quick brown fox jumps over the lazy dog near the river bank today"
    docs = make("documents", [(1, f"intro words here {passage} and more", "en", "s", 1), (2, "nothing at all", "en", "s", 1)])
    for kind, key in (("int", 7), ("string", "q7"), ("long", 2**40)):
        items = spark.createDataFrame([(key, passage)], f"item_id {kind}, text string")
        found = contaminated(docs, items).collect()
        assert [(r.doc_id, r.item_id) for r in found] == [(1, key)], kind
