import zlib

import numpy as np
import pytest
from conftest import TESTDATA

from popscope.llm import langid
from popscope.llm.common import table
from popscope.llm.langid import _slopes, identify_languages, in_a_language, train

from .conftest import ODD_DOCUMENTS


def test_held_out_accuracy(spark):
    docs = table(spark, TESTDATA.replace("0.001", "0.01"), "documents")
    langs = {r.doc_id: r.lang for r in docs.collect()}
    rows = identify_languages(docs).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    tested = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
    assert len(tested) > 200 and np.mean(tested) > 0.97


def test_gradients():
    draw = np.random.default_rng(0)
    weights = [draw.normal(0, 0.5, s) for s in ((2, 257, 3, langid.HIDDEN), (2, 3, langid.HIDDEN, langid.HIDDEN), (2 * langid.HIDDEN, 3), (3,))]
    weights[0][:, langid.PAD] = 0
    weights[0][:, langid.PAD, 1] = -30
    ids, wanted = draw.integers(0, 5, (6, 4)), draw.integers(0, 3, 4)
    ids[4:, 0] = langid.PAD

    def loss():
        net = langid.Network(["a", "b", "c"], *weights)
        inside = ids != langid.PAD
        p = net.position_probabilities(ids)[:, np.arange(4), wanted]
        return -np.log(p)[inside].mean()

    slopes = _slopes(weights, ids, wanted)
    for w, slope in zip(weights, slopes):
        for _ in range(12):
            at = tuple(draw.integers(0, n) for n in w.shape)
            if w is weights[0]:
                at = (at[0], int(draw.integers(0, 5)), *at[2:])
            kept = w[at]
            w[at] = kept + 0.01
            up = loss()
            w[at] = kept - 0.01
            down = loss()
            w[at] = kept
            assert slope[at] == pytest.approx((up - down) / 0.02, abs=2e-3)


def test_training_is_repeatable_and_learns():
    pieces = [b"aaab abba " * 6, b"cdcd ddcc " * 6] * 20
    one, two = (train(pieces, ["x", "y"] * 20) for _ in range(2))
    assert all(np.array_equal(getattr(one, k), getattr(two, k)) for k in ("table", "loop", "out", "bias"))
    data = np.frombuffer(b"abab" * 100 + b"dcdc" * 3, np.uint8)
    found = one.document_probabilities(data, np.array([0, 400, 400, 412]))
    assert found[0].argmax() == 0 and found[2].argmax() == 1 and not found[1].any()
    assert train([], []) is None


def test_odd_rows(odd, clashing, empty):
    rows = {str(r.doc_id): r for r in identify_languages(clashing).collect()}
    assert len(rows) == len({d[0] for d in ODD_DOCUMENTS})
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in ("2", "3", "4"))
    assert all(rows[i].lang_pred in ("en", "de", "fr") for i in ("1", "5", "6", "7", "8", "9", "None")) and rows["None"].held_out is False
    left = in_a_language(clashing)
    assert left.columns == clashing.columns and sorted(str(r.doc_id) for r in left.collect()) == ["1", "5", "5", "6", "7", "8", "9", "None"]
    assert identify_languages(empty).collect() == [] and in_a_language(empty).collect() == []


def test_nothing_to_learn_from(make):
    rows = make("documents", [(1, "a b", None, None, 3)])
    assert [r.lang_pred for r in identify_languages(rows).collect()] == ["und"]


def test_unlabelled_table_keeps_its_texts(spark):
    rows = [(1, "some words", None, "s", 10), (2, None, None, "s", None), (3, "12 34", None, "s", 5), (4, "日本語", None, "s", 3), (5, "", None, "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in in_a_language(docs).collect()} == {1, 4}
