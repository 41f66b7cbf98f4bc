"""The pipeline's stages on a small corpus whose right decisions are known."""

import corpus_pipeline
import pytest

from sensorlake.llm.common import stored, table

from tests.llm.conftest import SF, words_of
from tests.llm.test_op3_jaccard_join import shingles


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "near_duplicates", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def outputs(spark):
    docs = table(spark, SF, "documents")
    extra = [(100_000, "12 34 ...", "en", "s", 9), (100_001, None, "en", "s", None)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def test_each_stage_decides(spark, outputs):
    rows = [{r.doc_id: r.text for r in o.select("doc_id", "text").collect()} for o in outputs[:5]]
    rejected = set(rows[0]) - set(rows[1])
    assert {100_000, 100_001} <= rejected and len(rejected) <= 3 + 0.01 * len(rows[0])
    assert all(a.columns == outputs[0].columns for a in outputs[:5])
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    gone = set(rows[1]) - set(rows[2])
    assert sum(labels.get(k) == 0 for k in gone) <= 0.02 * len(rows[1])
    toxic = {k for k in rows[1] if labels.get(k) == 1}
    assert toxic and len(toxic & gone) >= 0.9 * len(toxic)
    # near duplicates: brute force over what the stage before kept
    sets = {k: shingles(t) for k, t in rows[2].items()}
    label = {k: k for k in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if b < a and len(both := sets[a] & sets[b]) >= 0.8 * (len(sets[a]) + len(sets[b]) - len(both)):
                x, y = label[a], label[b]
                label = {k: min(x, y) if v in (x, y) else v for k, v in label.items()}
    assert set(rows[3]) == set(label.values())
    # decontamination
    windows = set()
    for r in table(spark, SF, "benchmark").collect():
        w = words_of(r.text)
        windows |= {tuple(w[k:k + 10]) for k in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in windows}

    def hit(text):
        w = words_of(text)
        return any(tuple(w[k:k + n]) in windows for n in sizes for k in range(len(w) - n + 1))

    assert set(rows[4]) == {k for k, t in rows[3].items() if not hit(t)}


def test_all_kept_documents_are_packed(outputs):
    packed = {r.doc_id: r.n for r in outputs[5].groupBy("doc_id").sum("length").withColumnRenamed("sum(length)", "n").collect()}
    total = {r.doc_id: r.doc_tokens for r in outputs[5].select("doc_id", "doc_tokens").distinct().collect()}
    assert packed == total and set(packed) == {r.doc_id for r in outputs[4].select("doc_id").collect()}


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0
