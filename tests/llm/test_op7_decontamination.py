import hashlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sensorlake.llm import op7_decontamination as op
from sensorlake.llm.common import table

from tests.llm.conftest import LONG, SF, same, words_of


def brute(rows, items, size=10):
    windows = set()
    for item, text in items:
        w = words_of(text)
        windows |= {(item, tuple(w[k:k + size])) for k in range(max(1, len(w) - size + 1)) if w}
    out = []
    for doc_id, text in rows:
        w, hit, found = words_of(text), set(), set()
        for item, win in windows:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    found.add(item)
        ids = ",".join(sorted(str(i) for i in found if i is not None))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def result(docs, items, **more):
    found = op.search(op.build_index(docs), items, **more)
    return sorted((tuple(r) for r in op.report(found).drop("hash").collect()), key=repr)


def test_supplied_tables(spark, duck):
    same(op.query(spark, SF), duck, op.ORACLE)


ITEMS = [(1, "One two three four five six seven eight nine ten eleven"), (2, "alpha BETA"), (2, "gamma"), (3, None), (4, "..."),
         (5, "one two three four five six seven eight nine ten"), (None, "delta"), (6, "le été é")]
DOCS = [(1, None), (2, ""), (3, "x one, two-three four five six seven eight nine ten ELEVEN y"), (4, "alpha beta alpha beta gamma"),
        (4, "alpha beta alpha beta gamma"), (None, "delta"), (7, LONG + " gamma"), (8, "one two three four five six seven eight nine"),
        (9, "LE été É"), (10, "le été é"), (11, "beta"), (12, "alpha"), (13, "gamma gamma gamma")]


@pytest.mark.parametrize("slice_words", [1_000_000, 3])
def test_odd_rows(spark, documents, slice_words):
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, block string")
    docs = documents(DOCS)
    assert result(docs, items, slice_words=slice_words) == brute(DOCS, ITEMS)
    assert result(docs.limit(0), items) == []
    clean = result(docs, items.limit(0))
    assert [r[2:4] for r in clean] == [(0, 0)] * len(DOCS)


def test_repeated_and_long_items(spark, documents):
    long = " ".join(f"w{k % 97}x{k % 61}" for k in range(2300))  # more words than a slice and than a piece
    items = [(1, "the same ten words stand in a third of all items")] * 30 + [(k, f"the same ten words stand in a third of item {k}")
             for k in range(2, 32)] + [(50, long), (51, long), (None, long)]
    parts = long.split()
    rows = [(1, long), (2, " ".join(parts[995:1012])), (3, " ".join(parts[1500:1509])), (4, " ".join(parts[2280:])),
            (5, "x the same ten words stand in a third of all items y"), (6, "the same ten words stand in a third of item 7")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items)
    assert result(documents(rows), bench, slice_words=8000) == want
    assert result(documents(rows), bench) == want


def test_phrases_do_not_cross_documents(spark, documents):
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    got = result(documents([(1, "one two"), (2, "three one two three"), (3, "three")]).coalesce(1), items)
    assert {r[0]: r[2] for r in got} == {1: 0, 2: 3, 3: 0}


def test_proximity(spark, documents):
    items = spark.createDataFrame([(1, "red green blue")], "item_id long, text string")
    rows = [(1, "blue green red"), (2, "red x green blue"), (3, "red x x green blue"), (4, "red green"), (5, "blue x green x red")]
    found = op.search(op.build_index(documents(rows).coalesce(1)), items, slack=1).collect()
    want = {}
    for doc_id, text in rows:  # some span of four words holds all three
        w = text.split()
        want[doc_id] = any({"red", "green", "blue"} <= set(w[k:k + 4]) for k in range(len(w)))
    assert {r.doc_id: bool(r.items) for r in found} == want == {1: True, 2: True, 3: False, 4: False, 5: False}


def test_stage_drops_contaminated_documents(spark, documents):
    bench = [words_of(r.text) for r in table(spark, SF, "benchmark").collect()]
    text = " ".join(bench[0])
    docs = documents([(1, "clean words"), (2, f"before {text} after"), (2, "clean too"), (None, None)])
    out = op.stage(spark, docs, SF)
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == [(0, None), (1, "clean words"), (2, "clean too")]


def test_index_is_read_in_small_pieces(spark):
    word = lambda k: F.concat(F.lit("w"), F.pmod(F.xxhash64("doc_id", k), F.lit(5000)).cast("string"))
    docs = spark.range(24, numPartitions=1).withColumnRenamed("id", "doc_id") \
        .withColumn("text", F.array_join(F.transform(F.sequence(F.lit(1), F.lit(350_000)), word), " "))
    index = op.build_index(docs)  # one task makes 24 rows of about 1.5 MB
    groups = []
    for path in index.inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file:").replace("//", "/")).metadata
        groups += [meta.row_group(k) for k in range(meta.num_row_groups)]
    assert sum(g.num_rows for g in groups) == index.count() == 24
    assert max(g.total_byte_size for g in groups) < 16 << 20
