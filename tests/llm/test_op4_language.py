import numpy as np
import pytest

from sensorlake.llm import op4_language as op
from sensorlake.llm.common import crc_mod, table

from tests.llm.conftest import LONG


@pytest.mark.parametrize("n", [2, 3, 4, 7, 8, 20])
def test_codewords_correct_errors(n):
    code = op.codewords(n)
    assert code.shape[0] == n and set(np.unique(code)) <= {-1.0, 1.0}
    apart = (code.shape[1] - code @ code.T) / 2 + code.shape[1] * np.eye(n)
    assert apart.min() >= (code.shape[1] + 1) / 2 if n <= 7 else apart.min() >= 0.25 * code.shape[1]
    assert (np.abs(code.sum(0)) < n).all()  # no bit has all languages on one side


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    found = op.identify(docs, op.train(docs)).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(found) > 1500 and np.mean([r.lang_pred == r.lang for r in found]) >= 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, "123 ..."), (None, "the words"), (4, LONG), (5, "é"), (5, "é"), (6, "le mot", None)]
    rows += [(k, "the house and the garden of words", "en") for k in range(10, 30)]
    rows += [(k, "la maison et le jardin des mots", "fr") for k in range(30, 50)]
    docs = documents(rows)
    model = op.train(docs)
    got = op.identify(docs, model).collect()
    assert len(got) == len(rows) and model.langs == ["en", "fr"]
    assert {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id in (1, 2, 3)} == dict.fromkeys((1, 2, 3), ("und", 0.0))
    assert all(r.lang_pred == ("en" if r.doc_id < 30 else "fr") for r in got if r.doc_id and r.doc_id >= 10)
    one = docs.filter("lang = 'en'")
    assert {r.lang_pred for r in op.identify(one, op.train(one)).collect()} == {"en", "und"}
    none = docs.withColumn("lang", docs["lang"].substr(1, 0)).filter("lang is null")
    assert op.train(none) is None
    assert op.identify(docs.limit(0), op.train(docs.limit(0))).count() == 0
    assert {r.lang_pred for r in op.identify(docs, None).collect()} == {"und"}


def test_training_reads_no_held_out_text(spark, documents):
    docs = documents([(k, f"text number {k}", "en") for k in range(40)])
    used = {r.doc_id for r in op.sample(docs).collect()}
    assert used == {r.doc_id for r in docs.filter(crc_mod("doc_id", 4) != 2).collect()}


def test_stage_rejects_texts_without_letters(spark, documents):
    docs = documents([(1, "a text"), (2, None), (3, "1 2 3"), (4, ""), (1, "a text"), (None, "ß")])
    out = op.stage(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == [(0, "ß"), (1, "a text"), (1, "a text")]


def test_close_languages_are_flagged():
    x = np.eye(4, op.BINS, dtype=np.float32)
    model = op.fit(x, np.arange(4), ["a", "b", "c", "d"])
    _, share, close = model.decode(np.concatenate([x, (x[:1] + x[1:2]) / 2]))
    assert not close[:4].any() and close[4] and share[4] < 0.6


def test_a_language_of_long_texts_only_is_learned(spark, documents):
    rows = [(k, f"{k} the house and the garden of words " * 2000, "en") for k in range(12)]
    rows += [(k, f"{k} la maison et le jardin des mots é", "fr") for k in range(20, 32)]
    docs = documents(rows)
    assert all(0 < len(r.text.encode()) <= op.SAMPLE_BYTES for r in op.sample(docs).collect())
    got = op.identify(docs, op.train(docs)).collect()
    assert len(got) == 24 and all(r.lang_pred == ("en" if r.doc_id < 20 else "fr") for r in got)
    # digits but for the end: the passage is the one with the letters
    digits = documents([(k, "7 " * 60_000 + f"mot {k}", "fr") for k in range(4)])
    assert all("mot" in r.text for r in op.sample(digits).collect())


def test_stage_keeps_long_and_unlabelled_texts(spark, documents):
    for lang in ("en", None):
        docs = documents([(k, f"{k} words of a book " * 3000, lang) for k in range(4)] + [(9, "12 34", lang)])
        assert sorted(r.doc_id for r in op.stage(spark, docs, "").collect()) == [0, 1, 2, 3]


def test_fit_in_blocks_equals_fit_at_once(monkeypatch):
    rng = np.random.default_rng(0)
    x = (rng.random((30, op.BINS)) * (rng.random((30, op.BINS)) < 0.01)).astype(np.float32)
    y = np.arange(30) % 3
    want = op.fit(x, y, ["a", "b", "c"])
    monkeypatch.setattr(op, "ROWS", 7)
    got = op.fit(op.Sparse([(np.flatnonzero(r), r[r != 0]) for r in x], op.BINS), y, ["a", "b", "c"])
    assert np.allclose(got.weights, want.weights, atol=1e-3) and np.allclose(got.trust, want.trust)


def test_any_number_of_languages(spark, documents, monkeypatch):
    words = [f"{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(400)]
    docs = documents([(k, f"{w * 3} {w * 2} {w * 4}", w) for k, w in enumerate(words)])
    model = op.train(docs)
    known = {r.lang for r in docs.filter(crc_mod("doc_id", 4) != 2).collect()}
    assert set(model.langs) == known and len(known) > 256
    got = [(r.doc_id, r.lang_pred) for r in op.identify(docs, model).collect() if not r.held_out]
    assert np.mean([words[k] == lang for k, lang in got]) > 0.9
    # of more languages than the sample has room for, each still gives a text
    monkeypatch.setattr(op, "TOTAL", 10)
    assert op.sample(docs).count() == len(known)


def test_decoding_equals_the_logistic_loss():
    rng = np.random.default_rng(1)
    x = rng.random((9, op.BINS)).astype(np.float32)
    model = op.fit(x, np.arange(9), list("abcdefghi"))
    margin = x @ model.weights + model.bias
    loss = np.logaddexp(0, -margin[:, None, :] * model.code[None]) @ model.trust
    share = np.exp(-loss) / np.exp(-loss).sum(1, keepdims=True)
    best, score, _ = model.decode(x)
    assert (best == share.argmax(1)).all() and np.allclose(score, share.max(1))


def test_stage_decides_by_language_and_ambiguity(spark, documents):
    rows = [(k, f"the house and the garden number {k} are old and the words are short", "en") for k in range(24)]
    rows += [(k, f"la maison et le jardin numéro {k} sont vieux et les mots sont courts", "und") for k in range(30, 54)]
    docs = documents([*rows, (90, "你好世界这是没有学习过的语言", "en"), (91, None, "en")])
    kept = {r.doc_id for r in op.stage(spark, docs, "").collect()}
    # a language may be called und: its documents are decided like others
    assert {r[0] for r in rows} <= kept and 91 not in kept
    only = {r.doc_id for r in op.stage(spark, docs, "", frozenset({"en"})).collect()}
    assert {k for k in kept if k < 24} == {k for k in only if k < 54} and not any(30 <= k < 54 for k in only)
    names, score, close = np.array(["en", "en", "fr", "en"], object), np.array([0.9, 0.55, 0.95, 0.4]), np.array([False, True, False, False])
    spoken = np.array([True, True, True, True])
    assert op.decided(names, score, close, spoken).tolist() == [True, False, True, False]
    assert op.decided(names, score, close, spoken & [False, True, True, True], frozenset({"en"})).tolist() == [False] * 4


def test_stage_leaves_columns_of_clashing_names(spark, documents):
    docs = documents([(1, "a text"), (2, "1 2")]).withColumnRenamed("h", "Has_letter")
    assert op.stage(spark, docs, "").columns == docs.columns
