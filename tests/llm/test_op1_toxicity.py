import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorlake.llm import op1_toxicity as op
from sensorlake.llm.common import crc_mod, table

from tests.llm.conftest import LONG


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    emit, first, move = rng.normal(0, 2, 15), np.zeros(15, bool), np.array([0.7, -1.1])
    first[[0, 6, 7]] = True
    want = []
    for part in (emit[:6], emit[6:7], emit[7:]):
        total, mass = 0.0, np.zeros(len(part))
        for y in itertools.product((0, 1), repeat=len(part)):
            s = np.exp(sum(part[t] + (move[0] if t and y[t - 1] else move[1]) for t in range(len(part)) if y[t]))
            total, mass = total + s, mass + s * np.array(y)
        want.append(mass / total)
    for chains in (1, 2, 7, 64):
        assert np.allclose(op.marginals(emit, first, move, chains), np.concatenate(want), atol=1e-12)


def test_held_out_accuracy_and_spans(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    found = op.tag(docs, op.train(docs, labels)).join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id") \
        .filter("held_out").collect()
    right = [r.predicted == r.toxic for r in found]
    assert len(right) > 500 and np.mean(right) >= 0.975
    assert np.mean([r.predicted for r in found if r.toxic]) >= 0.9
    assert all(0 <= r.score <= 1 and (r.score >= 0.5) == (r.predicted == 1) == bool(r.spans) for r in found)
    marked = [r.text[s.start:s.end] for r in found for s in r.spans]
    assert marked and all(m and m[0].isalnum() and m[-1].isalnum() for m in marked)


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, "..."), (None, "idiot words"), (4, LONG), (5, "you idiot"), (5, "you idiot")]
    labels = spark.createDataFrame([(5, 1, 1), (5, 1, 0), (4, 1, 0), (6, 1, None), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    docs = documents(rows)
    got = op.tag(docs, op.train(docs, labels)).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id: r.score for r in got if r.doc_id in (1, 2, 3)} == {1: 0.0, 2: 0.0, 3: 0.0}
    none = op.tag(docs, op.train(docs, labels.limit(0))).agg(F.max("score")).first()[0]
    assert none == 0.0
    empty = docs.limit(0)
    assert op.tag(empty, op.train(empty, labels)).count() == 0
    folds = docs.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out")).distinct().collect()
    assert {(r.doc_id, r.held_out) for r in got} == {(r.doc_id, r.held_out) for r in folds}


def test_training_reads_no_held_out_label(spark, documents):
    docs = documents([(k, f"text number {k}") for k in range(40)])
    labels = docs.select("doc_id", F.lit(1).alias("toxic"))
    used = {r.doc_id for r in op.sample(docs, labels).collect()}
    assert used == {r.doc_id for r in docs.filter(crc_mod("doc_id", 5) != 0).collect()}


def test_stage_keeps_the_columns(spark, documents):
    docs = documents([(1, "a clean text"), (None, None), (1, "a clean text")])
    out = op.stage(spark, docs, "/root/testdata/sf0.001")
    assert out.columns == docs.columns and out.count() == 3


@pytest.mark.parametrize("word,size", [("abc", 3), ("abcdefgh", 8), ("abcdefghijklmnopqrs", 19)])
def test_word_keys_tell_words_apart(word, size):
    import pyarrow as pa
    keys = op.word_keys(pa.array([word, word[:-1] + "Z", word], pa.string()))
    assert keys["word"][0] == keys["word"][2] != keys["word"][1]
    assert (keys["p3"][0] != 0) == (size > 3)


def test_sample_is_full_where_labels_lack_documents_or_texts_are_long(spark, documents):
    docs = documents([(k, f"text number {k} " * (5000 if k < 100 else 1)) for k in range(200)])
    labels = spark.range(4000).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    found = op.sample(docs, labels, 20).collect()
    assert [sum(r.toxic == t for r in found) for t in (0, 1)] == [20, 20]
    assert max(len(r.text) for r in found) <= op.SAMPLE_BYTES


def test_long_toxic_documents_are_learned(spark, documents):
    rows = [(k, f"plain words {k} of a book and a garden " * 1200 if k % 2 else f"you idiotic fool {k} go on " * 1800) for k in range(120)]
    docs = documents(rows)
    labels = docs.selectExpr("doc_id", "cast(1 - doc_id % 2 as int) as toxic")
    got = op.tag(docs, op.train(docs, labels)).collect()
    assert all(r.predicted == 1 - r.doc_id % 2 for r in got)
