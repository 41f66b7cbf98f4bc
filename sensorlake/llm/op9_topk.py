"""Exact top-k inner products with a bit-sliced index.

Vectors are quantised to integers. An index block holds some ten thousand rows in
ascending vec_id order and, for each component, its more significant binary slices
as bitmaps over the rows. For a query the slices are added with bitmap arithmetic
(carry-save adders, a negative weight adds the complement), which gives every row's
coarse score as slices. From the most significant slice down, the k-th best coarse
score is found, then the bitmap of the rows that could still reach it given what the
``FINE`` slices left out can add. Those boundary rows are resolved exactly.

Each query meets each block once and brings back at most k rows, so what is sent
grows with queries times blocks, and a task holds one block and streams queries.

Cases: a vector that is null or holds a null or a non-finite component takes no
part, nor does a row without vec_id; rows with the query's own vec_id are no
candidates of it; only vectors of the query's length are; repeated candidate rows
count each, repeated query rows once; components of any finite size are ranked
exactly, and a score that no long can hold is null; a vector whose scaled component
passes the doubles takes no part; an empty table gives no rows; further columns are
not read.

Quantised components are whole numbers in doubles, as floor(scale * x) is. Rows are
kept in an index block by the size of their components (2-byte, 8-byte integers, or
doubles beyond them), so a few large vectors leave the slices of the others small.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, table

TOP = 20
EVERY = 20
SCALE = 64
BLOCK_ROWS = 65_536
#: Components in an index block, whatever the length of the vectors.
BLOCK_VALUES = 64 * BLOCK_ROWS
#: Least significant slices of a component that only the exact step reads, and the most that others read.
FINE, COARSE = 2, 20
#: Sizes of stored components: bytes of an integer, and the bound below which rows are stored so; doubles beyond.
SIZES = ((2, float(1 << 15)), (8, float(1 << 61)), (0, float("inf")))
STORED = {2: "<i2", 8: "<i8", 0: "<f8"}

BLOCKS = "block int, dim int, wide int, ids binary, rows binary"
#: A score beyond a long is ordered by ``beyond``, its signed length in bytes, and then ``big``, its bytes.
FOUND = "query_id long, query_hash long, vec_id long, score long, beyond int, big binary"


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and floor(scale * x) of the vectors that take part."""
    x = F.transform(F.col("embedding").cast("array<double>"), lambda v: v * float(scale))
    whole: Column = ~F.exists("scaled", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    # doubles from 2^53 on are whole
    floor = lambda v: F.when(F.abs(v) < float(1 << 53), F.floor(v).cast("double")).otherwise(v)
    return vectors.select(F.col("vec_id").cast("long"), x.alias("scaled")) \
        .filter(F.col("vec_id").isNotNull() & F.col("scaled").isNotNull()).filter(whole) \
        .select("vec_id", F.transform("scaled", floor).alias("vector"))


class Block:
    """Rows of one length: ids in order, the exact components (integers, or doubles that are whole),
    slices and their complements."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, fine: int = FINE) -> None:
        self.ids, self.rows = ids, rows
        low, high = int(rows.min(initial=0)), int(rows.max(initial=0))
        self.top_value = max(-low, high)
        # large components leave more slices to the exact step
        self.fine = fine = max(fine, (high - low).bit_length() - COARSE)
        if rows.dtype.kind == "f":
            coarse = (np.floor(np.ldexp(rows, -fine)) - np.floor(np.ldexp(float(low), -fine))).astype(np.int64)
        else:
            coarse = (rows >> fine) - (low >> fine)
        self.bits = max(1, int(coarse.max(initial=0)).bit_length())
        n, pad = len(ids), -len(ids) % 64
        flags = np.zeros(n + pad, np.uint8)
        self.slices = np.zeros((rows.shape[1], self.bits, (n + pad) // 64), np.uint64)
        for d in range(rows.shape[1]):
            for b in range(self.bits):
                flags[:n] = (coarse[:, d] >> b) & 1
                self.slices[d, b] = np.packbits(flags, bitorder="little").view(np.uint64)
        flags[:n] = 1
        self.all = np.packbits(flags, bitorder="little").view(np.uint64)
        self.others = ~self.slices & self.all

    def added(self, weights: list[int]) -> list[np.ndarray]:
        """Slices of sum |w| * (coarse component, or its complement where w < 0), least significant first."""
        columns: list[list[np.ndarray]] = [[] for _ in range(self.bits + max(abs(w) for w in weights).bit_length())]
        for d, w in enumerate(weights):
            source = self.slices[d] if w > 0 else self.others[d]
            w = abs(w)
            for a in range(w.bit_length()):
                if w >> a & 1:
                    for b in range(self.bits):
                        columns[a + b].append(source[b])
        out = []
        k = 0
        while k < len(columns):
            col = columns[k]
            if len(col) > 1 and k + 1 == len(columns):
                columns.append([])
            while len(col) > 2:
                x, y, z = col.pop(), col.pop(), col.pop()
                half = x ^ y
                columns[k + 1].append((x & y) | (z & half))
                # the sum goes to the far end, so sums are used as late as may be
                col.insert(0, half ^ z)
            if len(col) == 2:
                x, y = col
                columns[k + 1].append(x & y)
                col[:] = [x ^ y]
            out.append(col[0] if col else np.zeros_like(self.all))
            k += 1
        return out

    def top(self, vector: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but those with the id ``own``; ties to the smaller id."""
        weights = [int(w) for w in vector]
        live = self.all.copy()
        for at in range(*np.searchsorted(self.ids, [own, own + 1])):
            live[at >> 6] &= ~np.uint64(1 << (at & 63))
        left = int(np.bitwise_count(live).sum())
        if any(weights) and left > k:
            slices = self.added(weights)
            best = _kth(slices, live, k)
            slack = (sum(map(abs, weights)) * ((1 << self.fine) - 1)) >> self.fine
            live = _at_least(slices, live, best - slack)
        rows = np.flatnonzero(np.unpackbits(live.view(np.uint8), bitorder="little"))
        if sum(map(abs, weights)) * self.top_value >= 1 << 63:
            return self._top_beyond(rows, weights, k)
        scores = self.rows[rows].astype(np.int64) @ np.array(weights, np.int64)
        if len(rows) > k:
            edge = np.partition(scores, len(scores) - k)[len(scores) - k]
            rows, scores = rows[scores >= edge], scores[scores >= edge]
        # rows are in ascending id order: a stable sort gives ties to the smaller id
        order = np.argsort(-scores, kind="stable")[:k]
        return self.ids[rows[order]], scores[order]

    def _top_beyond(self, rows: np.ndarray, weights: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best of the rows where scores may pass 63 bits, in integers of any size."""
        used = [d for d, w in enumerate(weights) if w]
        scored = ((-sum(weights[d] * int(self.rows[r, d]) for d in used), r) for r in rows.tolist())
        best = heapq.nsmallest(k, scored)
        return self.ids[[r for _, r in best]], np.array([-s for s, _ in best], object)


def _kth(slices: list[np.ndarray], live: np.ndarray, k: int) -> int:
    """The k-th largest value among the live rows, from the most significant slice down."""
    above, equal, value = np.zeros_like(live), live, 0
    for b in range(len(slices) - 1, -1, -1):
        ones = equal & slices[b]
        if int(np.bitwise_count(above | ones).sum()) >= k:
            equal = ones
            value |= 1 << b
        else:
            above = above | ones
            equal = equal & ~slices[b]
    return value


def _at_least(slices: list[np.ndarray], live: np.ndarray, value: int) -> np.ndarray:
    if value <= 0:
        return live
    above, equal = np.zeros_like(live), live
    for b in range(len(slices) - 1, -1, -1):
        if value >> b & 1:
            equal = equal & slices[b]
        else:
            above = above | (equal & slices[b])
            equal = equal & ~slices[b]
    return above | equal


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def build_index(vectors: DataFrame, blocks: int) -> DataFrame:
    """Blocks of quantised vectors (block, dim, ids and components as bytes), stored in the shared folder."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            sizes = pc.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes).tolist():
                some = batch.filter(pa.array(sizes == dim))
                held.setdefault(dim, []).append((some.column("vec_id").to_numpy(), _matrix(some.column("vector"), dim)))
        for dim, parts in held.items():
            ids, x = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], x[order]
            size, low = np.abs(x).max(axis=1, initial=0), -1.0
            for wide, bound in SIZES:
                some = (size >= low) & (size < bound)
                low = bound
                if some.any():
                    yield pa.RecordBatch.from_arrays([
                        pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([dim], pa.int32()),
                        pa.array([wide], pa.int32()), pa.array([ids[some].tobytes()], pa.binary()),
                        pa.array([x[some].astype(STORED[wide]).tobytes()], pa.binary())],
                        names=["block", "dim", "wide", "ids", "rows"])

    return stored(vectors.repartition(blocks).mapInArrow(build, BLOCKS), "slices")


def search(vectors: DataFrame, queries: DataFrame, k: int = TOP, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The k best candidates of ``vectors`` for each of ``queries`` (both vec_id, vector of whole numbers)."""
    spark = vectors.sparkSession
    vectors, queries = (d.select(F.col("vec_id").cast("long"), F.col("vector").cast("array<double>")) for d in (vectors, queries))
    rows, values = vectors.agg(F.count("*"), F.coalesce(F.sum(F.size("vector").cast("long")), F.lit(0))).first()
    blocks = max(1, -(-rows // block_rows), -(-values // BLOCK_VALUES))
    index = build_index(vectors, blocks)
    # with few blocks, the queries are dealt to several tasks for each block
    parts = max(1, -(-2 * spark.sparkContext.defaultParallelism // blocks))
    sent = index.select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("kind"),
        F.lit(None).cast("long").alias("vec_id"), F.array(F.col("dim").cast("double"), F.col("wide").cast("double")).alias("vector"),
        F.concat(F.col("ids"), F.col("rows")).alias("data"))
    asked = queries.distinct().select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(F.xxhash64("vec_id", "vector"), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("kind"),
        "vec_id", "vector", F.lit(None).cast("binary").alias("data"))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        for batch in batches:
            slim = batch.select(["block", "part", "kind", "vec_id"]).to_pylist()
            out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
            for r, row in enumerate(slim):
                vector = batch.column("vector")[r].values.to_numpy(zero_copy_only=False)
                if row["kind"] == 0:
                    if (row["block"], row["part"]) != now:
                        now, held = (row["block"], row["part"]), {}
                    dim, wide = (int(x) for x in vector)
                    held.setdefault(dim, []).append(_loaded(batch.column("data")[r].as_buffer(), dim, wide))
                elif (row["block"], row["part"]) == now:
                    for block in held.get(len(vector), ()):
                        found, scores = block.top(vector, row["vec_id"], k)
                        out.append((row["vec_id"], _hash(vector), found, scores))
            if out:
                n = [len(x[2]) for x in out]
                parts = [_columns(x[3]) for x in out]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(np.array([x[0] for x in out], np.int64), n)),
                    pa.array(np.repeat(np.array([x[1] for x in out], np.int64), n)),
                    pa.array(np.concatenate([x[2] for x in out])),
                    *(pa.concat_arrays([p[c] for p in parts]) for c in range(3))],
                    names=["query_id", "query_hash", "vec_id", "score", "beyond", "big"])

    met = sent.unionByName(asked).repartition(blocks * parts, "block", "part") \
        .sortWithinPartitions("block", "part", "kind")
    found = met.mapInArrow(answer, FOUND)
    order = Window.partitionBy("query_id", "query_hash").orderBy(
        F.desc("beyond"), F.desc("score"), F.desc("big"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _hash(vector: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(vector.astype("<f8").tobytes()) >> 1


def _columns(scores: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """score, beyond and big: a score within a long as it is, another by its size and bytes in ascending order."""
    n = len(scores)
    if scores.dtype != object:
        return pa.array(scores, pa.int64()), pa.array(np.zeros(n, np.int32)), pa.nulls(n, pa.binary())
    longs, sizes, bytes_ = [], [], []
    for s in scores.tolist():
        fits = -1 << 63 <= s < 1 << 63
        size = 0 if fits else s.bit_length() // 8 + 1
        longs.append(s if fits else None)
        sizes.append(size if s > 0 else -size)
        # of negative scores the remainder above the smallest of that size
        bytes_.append(None if fits else (s if s > 0 else s + (1 << 8 * size)).to_bytes(size, "big"))
    return pa.array(longs, pa.int64()), pa.array(sizes, pa.int32()), pa.array(bytes_, pa.binary())


def _loaded(data: pa.Buffer, dim: int, wide: int) -> Block:
    raw = np.frombuffer(data, np.uint8)
    n = len(raw) // (8 + (wide or 8) * dim)
    rows = raw[8 * n:].view(STORED[wide]).reshape(n, dim)
    return Block(raw[:8 * n].view(np.int64), rows if wide == 0 else rows.astype(np.int64))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return search(vectors, vectors.filter(F.col("vec_id") % EVERY == 0))


ORACLE = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum([a.q[i] * b.q[i] FOR i IN range(1, len(a.q) + 1)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
