import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorlake.llm.common import BATCH_BYTES, Words, smallest, stored, text_blocks, work_path

from tests.llm.conftest import words_of


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB9 -.\né中\x00~`{", max_size=30)), max_size=8))
@settings(max_examples=150, deadline=None)
def test_words_equal_the_pattern(texts):
    w = Words(pa.array(texts, pa.string()))
    vocab = w.vocab.to_pylist()
    got = [[vocab[c] for c in w.codes[a:b]] for a, b in zip(w.ptr[:-1], w.ptr[1:], strict=True)]
    assert got == [words_of(t) for t in texts]


@given(st.lists(st.lists(st.one_of(st.none(), st.text(max_size=60)), max_size=9), max_size=5), st.integers(1, 200))
@settings(max_examples=100, deadline=None)
def test_blocks_keep_all_rows_in_order(parts, size):
    batches = [pa.RecordBatch.from_arrays([pa.array(p, pa.string())], names=["text"]) for p in parts]
    out = list(text_blocks(batches, max_bytes=size))
    assert [x for b in out for x in b.column("text").to_pylist()] == [x for p in parts for x in p]
    assert all(b.num_rows for b in out)


def test_tables_lie_in_the_shared_folder(spark):
    shared = spark.sparkContext.getCheckpointDir().rsplit("/", 1)[0]
    path = work_path(spark, "x")
    assert shared.removeprefix("file:").lstrip("/") in path and path != work_path(spark, "x")
    assert stored(spark.range(3), "x").count() == 3


def test_the_smallest_hashes_of_each_group(spark):
    rows = spark.range(3000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("h"))
    got = {(r.g, r.h) for r in smallest(rows, 7, "h", ["g"]).collect()}
    want = set()
    for g in range(3):
        some = [r.h for r in rows.collect() if r.g == g]
        want |= {(g, h) for h in sorted(some, key=lambda h: h % (1 << 40))[:7]}
    assert got == want
    assert smallest(rows.limit(0), 7, "h").count() == 0 and smallest(rows, 5, "h").count() == 5


def test_smallest_hashes_of_many_groups(spark):
    rows = spark.range(900).select((F.col("id") % 300).alias("g"), F.xxhash64("id").alias("h"))
    assert {(r.g, r["count"]) for r in smallest(rows, 2, "h", ["g"]).groupBy("g").count().collect()} == {(g, 2) for g in range(300)}


def test_wide_rows_come_in_small_batches(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    rows = spark.range(30, numPartitions=1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    got = stored(rows.mapInArrow(sizes, "n long, size long"), "sizes", wide=True).collect()
    assert sum(r.n for r in got) == 30 and max(r.size for r in got) <= BATCH_BYTES + (2 << 20)
    assert spark.conf.get(key) == before
    with pytest.raises(Exception):  # and it is given back when a write fails
        stored(rows.select(F.raise_error(F.lit("no")).alias("x")), "sizes", wide=True)
    assert spark.conf.get(key) == before
