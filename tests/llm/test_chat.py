import hashlib

from conftest import TESTDATA
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from popscope.llm.chat import CONTROL, digests, escaped, format_conversations, parse_plain, render_plain, render_spans, unescaped
from popscope.llm.common import table

PIECES = st.lists(st.sampled_from([*CONTROL, "\\", "\n", "<", "|", "a", "é", "🙂", "[", "]", "assistant"]), max_size=12).map("".join)
TURNS = st.lists(st.tuples(st.one_of(st.just("assistant"), st.just("user"), PIECES), PIECES), max_size=6)


@settings(max_examples=300, deadline=None)
@given(TURNS)
def test_round_trip(turns):
    found = render_spans(turns)
    assert parse_plain(found.text) == turns and found.rewritten_at is None
    assert [unescaped(found.text[a:b]) for a, b in found.loss] == [t for r, t in turns if r == "assistant" and t]
    assert "".join(found.text[a:b] for _, a, b in found.spans) == found.text
    assert not any(mark in escaped(t) for _, t in turns for mark in CONTROL)


def without_old_replies(turns, prompt):
    """A template that shortens earlier replies."""
    last = max((i for i, t in enumerate(turns) if t[0] == "user"), default=-1)
    return render_plain([(r, "" if r == "assistant" and i < last else t) for i, (r, t) in enumerate(turns)], prompt)


def test_rewriting_is_noticed():
    turns = [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]
    found = render_spans(turns, without_old_replies)
    assert found.rewritten_at == 2 and not found.loss and not found.spans
    assert render_spans(turns[:2], without_old_replies).rewritten_at is None


def test_other_templates():
    def inst(turns, prompt):
        return "".join(f"[INST] {t} [/INST]" if r == "user" else f" {t}</s>" for r, t in turns) + (" " if prompt else "")

    found = render_spans([("user", "x"), ("assistant", "</s>y"), ("user", "z"), ("assistant", "")], inst)
    assert [found.text[a:b] for a, b in found.loss] == ["</s>y"]


ODD = [
    (1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, None, None), (2, None, "system", ""), (3, 0, "assistant", "x"), (3, 0, "assistant", "x"),
    (None, 0, "user", "lost"), (4, 0, "user", "long " * 40_000), (4, 1, "assistant", "\\</s>" * 20_000),
]


def test_odd_rows(spark):
    rows = spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("formatted", "spans", "loss")}).repartition(5)
    found = {r.conv_id: r for r in digests(format_conversations(rows)).collect()}
    assert set(found) == {1, 2, 3, 4, None}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert found[1].turns_sha256 == sha("user\na\nassistant\nb\n") and found[1].loss_sha256 == sha("b")
    assert found[2].turns_sha256 == sha("system\n\n\n\n") and found[2].loss_chars == 0
    assert (found[3].n_turns, found[3].loss_sha256) == (2, sha("xx"))
    assert found[4].loss_chars == 100_000 and found[None].n_turns == 1
    assert format_conversations(rows.limit(0)).collect() == []


def test_spans_of_the_given_table(spark):
    rows = table(spark, TESTDATA, "conversations")
    for r in format_conversations(rows).collect():
        assert r.rewritten_at is None and [s.role for s in r.spans] == [t for t, _ in parse_plain(r.formatted)]
