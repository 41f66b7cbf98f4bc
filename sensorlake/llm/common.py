"""Helpers of the operators: shared folder, tables, row numbering, vectorised words."""

from __future__ import annotations

import ctypes
import gc
import os
import pickle
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager, nullcontext

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_dir

#: Text handled at once inside a task; a longer single document is a block of its own.
BLOCK_BYTES = 2 << 20
#: How rows of megabytes are written: Parquet looks at the bytes it holds after each row, not first after 100,
#: so neither a page nor a row group, which readers hold whole, grows with the rows of a task.
WIDE = {"parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
#: Arrow bytes that are sent to Python at once where rows are wide (Spark's own bound is 64 MB).
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str, whole_buffers: bool = True) -> DataFrame:
    """``whole_buffers`` False: a row group's column isn't read through a buffer of its size outside the heap."""
    options = {} if whole_buffers else {"parquet.hadoop.vectored.io.enabled": False}
    return spark.read.options(**options).parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_sensorlake_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    made = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "sensorlake"), "zip", top, "sensorlake")
    sc.addPyFile(made)
    sc._sensorlake_shipped = True


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder in ``spark.checkpoint.dir`` (see ``scratch_dir``): a run never meets
    another run's files, and all of them are removed when the driver ends."""
    return f"{scratch_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, wide: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    ``wide``: rows of megabytes come or go; pages and row groups are closed by their bytes (see ``WIDE``),
    and Python gets them in small batches.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    with small_batches(spark) if wide else nullcontext():
        df.write.options(**WIDE if wide else {}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside sends Python Arrow batches of about ``BATCH_BYTES`` (one row at least): an executor holds each
    some times over outside its heap, while buffers grow and until the next garbage collection."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_mod(col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the text 'null'."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("null")).cast("binary")) % n


def smallest(rows: DataFrame, per: int, hashed: str, by: list[str] | None = None) -> DataFrame:
    """The ``per`` rows with the smallest values of ``hashed`` (a 64-bit hash) of all rows, or of each group.

    Hashes are spread evenly, so a threshold from the number of rows leaves about four
    times ``per``, and only those are sorted, whatever the input's size. There may be any
    number of groups: their sizes are joined, not collected.
    """
    by = by or []
    if by:
        sizes = salted_max(rows, by, [F.count("*").alias("_m")], [F.sum("_m").alias("_size")], spread=hashed)
        rows = copies_joined(rows, by, sizes, spread=hashed)
    else:
        rows = rows.withColumn("_size", F.lit(rows.count()))
    place = F.pmod(F.col(hashed), F.lit(1 << 40))
    few = rows.filter(place / F.lit(float(1 << 40)) * F.col("_size") <= 4.0 * per).drop("_size")
    order = Window.partitionBy(*by, F.lit(0)).orderBy(place, *few.columns)
    return few.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per).drop("_n")


def excerpt(text: Column, hashed: Column, most: int) -> Column:
    """The text, or of a text over ``most`` bytes a passage of at most so many, from a place that its hash gives.

    A passage without a letter gives way to the one from the text's first letter on.
    """
    size = most // 4  # characters, of at most four bytes each
    room = F.greatest(F.char_length(text) - size + 1, F.lit(1))
    passage = text.substr((F.pmod(hashed, room) + 1).cast("int"), F.lit(size))
    first = F.regexp_extract(text, rf"\p{{L}}[\s\S]{{0,{size - 1}}}", 0)
    return F.when(F.octet_length(text) <= most, text).when(passage.rlike(r"\p{L}") | (first == ""), passage).otherwise(first)


def fitted(sample: DataFrame, fit: Callable[[pa.Table], object]) -> object | None:
    """What ``fit`` makes of a bounded sample, in one task; only the fitted model comes to the driver.

    None for a sample without rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            model = pickle.dumps(fit(pa.Table.from_batches(held)))
            held.clear()
            give_back()
            yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    found = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0].model) if found else None


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on after a task that needed much of it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def text_blocks(batches: Iterable[pa.RecordBatch], column: str = "text",
                max_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut and join Arrow batches so that each holds about ``max_bytes`` of text."""
    kept: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64)) + 16 * np.arange(1, batch.num_rows + 1)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + max_bytes - size, "right")))
            kept.append(batch.slice(at, to - at))
            size += int(ends[to - 1] - before)
            at = to
            if size >= max_bytes * 0.9:
                yield _joined(kept)
                kept, size = [], 0
    if kept:
        yield _joined(kept)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, end to end, and the offset of each row (null: empty)."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), offs - offs[0]
    return np.frombuffer(data, np.uint8)[offs[0]:offs[-1]], offs - offs[0]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of a word once A-Z is lower case: digits, a-z and everything beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


class Words:
    """The words of a block of texts: maximal runs of digits, letters and non-ASCII characters.

    ``codes`` has a number for each word occurrence, ``vocab`` the distinct words
    (Arrow strings) that the numbers stand for, ``ptr`` where each text's words begin.
    """

    def __init__(self, column: pa.Array) -> None:
        data, offs = utf8(column)
        low = _LOWER[data]
        word = _WORD[low]
        before = np.empty_like(word)
        before[:1] = False
        before[1:] = word[:-1]
        cuts = offs[:-1][offs[:-1] < len(word)]
        before[cuts] = False
        after = np.empty_like(word)
        after[-1:] = False
        after[:-1] = word[1:]
        after[offs[1:][offs[1:] > 0] - 1] = False
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        self.ptr = np.searchsorted(self.starts, offs)
        self.offs = offs
        self.low = low
        lengths = np.zeros(len(self.starts) + 1, np.int32)
        np.cumsum(self.ends - self.starts, out=lengths[1:])
        raw = np.ascontiguousarray(low[word])
        words = pa.StringArray.from_buffers(len(self.starts), pa.py_buffer(lengths), pa.py_buffer(raw))
        coded = words.dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        self.vocab = coded.dictionary

    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)


def copies_joined(rows: DataFrame, key: list[str], per_key: DataFrame, salts: int = 64,
                  spread: str = "doc_id") -> DataFrame:
    """Left join of ``rows`` with one row per key, safe when one key holds a third of the rows.

    ``per_key`` has ``key``, its values and ``_salts`` (the salts that occur with
    the key, see ``salted_max``), so each key is copied once for each salt in use:
    never more copies than rows.
    """
    salt = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    dealt = per_key.withColumn("_salt", F.explode("_salts")).drop("_salts")
    return rows.withColumn("_salt", salt).join(dealt, [*key, "_salt"], "left").drop("_salt")


def salted_max(rows: DataFrame, key: list[str], aggs: list[Column], again: list[Column],
               salts: int = 64, spread: str = "doc_id") -> DataFrame:
    """Aggregate by key in two steps, with the salts of each key gathered as ``_salts``."""
    salt = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int").alias("_salt")
    first = rows.groupBy(*key, salt).agg(*aggs)
    return first.groupBy(*key).agg(*again, F.collect_set("_salt").alias("_salts"))
