"""Approximate nearest neighbours by multi-index hashing of learned rotated binary codes.

Codes: for each vector length, rotations of the principal components are learned on a
sample so that signs lose least (alternating between signs and the closest rotation); a
vector's code is the signs of its rotated components. The largest inner product
becomes the smallest angle by one more component, which lifts every stored vector to
the length of the longest one and is 0 for queries.

A block of the index holds vectors, their codes and a table for each substring of the
code. A code within Hamming radius r of a query's is, for thresholds t of the substrings with
sum(t + 1) = r + 1, within t of it in one substring at least (pigeonhole), so probing each
table with all values that close retrieves every such code; its true distance is
checked, and the inner products of all that remain are computed exactly. The radius is
measured: ``PROBES`` rows are searched exactly among all rows, and the radius takes in
``SHARE`` of their neighbours. A block in which fewer than k rows lie within the radius doubles
it until there are k, so that each query has k neighbours wherever there are so many.

Each query meets each block once and brings back at most k rows. Equal vectors are one
code in a block, with their ids.

Cases: a vector that is null, zero or holds a null or a non-finite component takes no part,
nor does a row without vec_id; rows with the query's own vec_id are no candidates of
it; only vectors of the query's length are; repeated candidate rows count each, repeated
query rows once; a sum beyond a double's range is infinite, one that is no number counts as minus
infinity; an empty table gives no rows; further columns are not read. All rows are indexed; only the rotations are learned on a sample, of ``SAMPLE``
vectors in all, shared evenly by the lengths, with one each at least.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import copies_joined, salted_max, smallest, stored, table

TOP = 20
EVERY = 20
#: Bits of a code, at least; a whole number of rotations is taken.
BITS = 256
SAMPLE = 4096
PROBES = 128
SHARE = 0.97
TURNS = 20
#: Bytes of the vectors of an index block.
BLOCK_BYTES = 8 << 20

RAW = "block int, dim int, ids binary, rows binary"
FOUND = "query_id long, query_hash long, vec_id long, score double, distance int"


def participating(vectors: DataFrame) -> DataFrame:
    """vec_id, vector and its length of the vectors that take part."""
    x = F.col("embedding").cast("array<double>")
    whole = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vectors.select(F.col("vec_id").cast("long"), x.alias("embedding")) \
        .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(whole & F.exists("embedding", lambda v: v != 0.0)) \
        .select("vec_id", F.col("embedding").alias("vector"), F.size("embedding").alias("dim"))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by their largest component, so that squares stay finite."""
    return x / np.abs(x).max(1, keepdims=True)


class Codes:
    """Learned projections of lifted vectors: the signs are the code."""

    def __init__(self, centre: np.ndarray, turn: np.ndarray, longest: float) -> None:
        self.centre, self.turn, self.longest = centre, turn, longest

    @classmethod
    def fit(cls, x: np.ndarray, longest: float, bits: int = BITS) -> Codes:
        """``x`` is a sample, ``longest`` the largest length of all vectors."""
        lifted = cls._lifted(x, longest)
        centre = lifted.mean(0)
        lifted = lifted - centre
        _, _, axes = np.linalg.svd(lifted.T @ lifted)
        axes = axes[:min(bits, lifted.shape[1])].T
        y = lifted @ axes
        rng = np.random.default_rng(len(centre))
        turns = []
        for _ in range(-(-bits // axes.shape[1])):
            turn = np.linalg.qr(rng.normal(size=(axes.shape[1], axes.shape[1])))[0]
            for _ in range(TURNS):
                u, _, v = np.linalg.svd(np.where(y @ turn >= 0, 1.0, -1.0).T @ y)
                turn = (u @ v).T
            turns.append(axes @ turn)
        turn = np.concatenate(turns, 1)
        return cls(centre, turn[:, :turn.shape[1] // 16 * 16], longest)

    @staticmethod
    def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
        y = x / longest
        return np.column_stack([y, np.sqrt(np.maximum(0, 1 - (y * y).sum(1)))])

    def stored(self, x: np.ndarray) -> np.ndarray:
        return self._signs(self._lifted(x, self.longest))

    def asked(self, x: np.ndarray) -> np.ndarray:
        y = scaled(x)
        return self._signs(np.column_stack([y / np.sqrt((y * y).sum(1, keepdims=True)), np.zeros(len(y))]))

    def _signs(self, y: np.ndarray) -> np.ndarray:
        return np.packbits((y - self.centre) @ self.turn >= 0, axis=1, bitorder="little")

    def dump(self) -> bytes:
        return np.array([*self.turn.shape], "<i8").tobytes() + \
            b"".join(np.ascontiguousarray(v, "<f8").tobytes() for v in (self.centre, self.turn, [self.longest]))

    @classmethod
    def load(cls, data: bytes) -> Codes:
        rows, columns = np.frombuffer(data, "<i8", 2).tolist()
        values = np.frombuffer(data, "<f8", offset=16)
        return cls(values[:rows], values[rows:rows + rows * columns].reshape(rows, columns), float(values[-1]))


@lru_cache(maxsize=64)
def _near(width: int, most: int) -> np.ndarray:
    """All values of so many bits with at most ``most`` ones."""
    values = np.arange(1 << width)
    return values[np.bitwise_count(values) <= most]


def thresholds(radius: int, tables: int) -> list[int]:
    """How far to probe each table: the sum of (threshold + 1) is radius + 1; -1 leaves a table out."""
    whole, more = divmod(radius + 1, tables)
    return [whole - 1 + (t < more) for t in range(tables)]


class Block:
    """Different vectors of one length, in columns, their ids, codes and substring tables."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, codes: Codes) -> None:
        # equal vectors share a code; ids are in order within each (0.0 and -0.0 are equal)
        rows = rows + 0.0
        _, first, place = np.unique(rows.view(f"V{rows.itemsize * rows.shape[1]}").ravel(), return_index=True, return_inverse=True)
        order = np.lexsort((ids, place))
        self.ids, self.ptr = ids[order], np.searchsorted(place[order], np.arange(len(first) + 1))
        self.columns = np.ascontiguousarray(rows[first].T)
        self.codes = codes
        self.code = codes.stored(rows[first])
        self.words = self._words(self.code)
        self.tables: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    @staticmethod
    def _words(code: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(np.pad(code, ((0, 0), (0, -code.shape[1] % 8)))).view(np.uint64)

    def table(self, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each substring of 8 or 16 bits the rows in the order of its values, and where each value begins."""
        if width not in self.tables:
            parts = self.code.view(np.uint16) if width == 16 else self.code
            self.tables[width] = [(np.argsort(part, kind="stable").astype(np.int32),
                                   np.searchsorted(np.sort(part), np.arange((1 << width) + 1))) for part in parts.T]
        return self.tables[width]

    def width(self, radius: int) -> int:
        """The width of the substrings that reads fewer buckets and rows for this radius."""
        def cost(width: int) -> float:
            near = [len(_near(width, t)) for t in thresholds(radius, self.code.shape[1] * 8 // width) if t >= 0]
            return sum(near) * (1 + len(self.code) / (1 << width))
        return min((8, 16), key=cost)

    def within(self, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose codes are at most ``radius`` from ``code``, and their distances."""
        words = self._words(code[None])
        if radius >= self.code.shape[1] * 8:
            rows = np.arange(len(self.code))
        else:
            width = self.width(radius)
            parts = code.view(np.uint16) if width == 16 else code
            hit = np.zeros(len(self.code), bool)
            tables = self.table(width)
            for part, most, (order, begins) in zip(parts.tolist(), thresholds(radius, len(tables)), tables, strict=True):
                if most >= 0:
                    values = _near(width, most) ^ part
                    sizes = begins[values + 1] - begins[values]
                    some = sizes > 0
                    sizes, at = sizes[some], begins[values[some]]
                    hit[order[np.repeat(at - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))]] = True
            rows = np.flatnonzero(hit)
        distance = np.bitwise_count(self.words[rows] ^ words).sum(1, dtype=np.int64)
        near = distance <= radius
        return rows[near], distance[near]

    def top(self, vector: np.ndarray, own: int, radius: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, scores and code distances of the k best rows within the radius, which grows while they are fewer."""
        code = self.codes.asked(vector[None])[0]
        every = self.code.shape[1] * 8
        while True:
            rows, distance = self.within(code, radius)
            ids, scores, apart = self._best(rows, distance, vector, own, k)
            if len(ids) >= k or radius >= every:
                return ids, scores, apart
            radius = min(2 * radius + 1, every)

    def _best(self, rows, distance, vector, own, k):  # noqa: ANN001, ANN202
        scores = np.zeros(len(rows))
        with np.errstate(all="ignore"):
            # one component after the other: equal vectors have equal sums
            for column, v in zip(self.columns, vector.tolist(), strict=True):
                scores += column[rows] * v
        scores[np.isnan(scores)] = -np.inf
        # of equal vectors only the k + 1 smallest ids can be among the best, the query's own left out
        some = np.argsort(-scores, kind="stable") if len(rows) <= 4 * k else _first(scores, k + 1)
        counts = np.diff(self.ptr)[rows[some]]
        place = np.concatenate([np.arange(p, p + n) for p, n in zip(self.ptr[rows[some]].tolist(), counts.tolist(), strict=True)]) \
            if len(some) else np.zeros(0, np.int64)
        of = np.repeat(some, counts)
        ids = self.ids[place]
        other = ids != own
        ids, of = ids[other], of[other]
        order = np.lexsort((ids, -scores[of]))[:k]
        return ids[order], scores[of[order]], distance[of[order]]


def _first(scores: np.ndarray, k: int) -> np.ndarray:
    """The places of the k largest scores and of all that equal the least of them."""
    edge = np.partition(scores, len(scores) - k)[len(scores) - k]
    return np.flatnonzero(~(scores < edge))


def learned(vectors: DataFrame) -> DataFrame:
    """(dim, model) for each length of the vectors: rotations learned on a bounded sample."""
    long = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v))
    # also where squares leave a double's range
    shape = vectors.groupBy("dim").agg(F.greatest(F.least(F.max(long), F.lit(1e308)), F.lit(1e-150)).alias("longest"))
    lengths = max(1, shape.count())
    hashed = vectors.withColumn("h", F.xxhash64("vec_id", "vector"))
    few = smallest(hashed, max(1, SAMPLE // lengths), "h", ["dim"])

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("h")
        codes = Codes.fit(np.array(rows["vector"].tolist(), float), float(rows["longest"].iloc[0]))
        return pd.DataFrame({"dim": [int(rows["dim"].iloc[0])], "model": [codes.dump()]})

    return stored(few.join(shape, "dim").groupBy("dim").applyInPandas(fit, "dim int, model binary"), "rotations")


def build_index(vectors: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of vectors of one length (block, dim, ids and components as bytes) with the length's model, stored in the
    shared folder."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            sizes = pc.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes).tolist():
                some = batch.filter(pa.array(sizes == dim))
                flat = some.column("vector").flatten().to_numpy(zero_copy_only=False)
                held.setdefault(dim, []).append((some.column("vec_id").to_numpy(), flat.reshape(-1, dim)))
        for dim, parts in held.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([dim], pa.int32()),
                pa.array([np.concatenate([p[0] for p in parts]).astype("<i8").tobytes()], pa.binary()),
                pa.array([np.concatenate([p[1] for p in parts]).astype("<f8").tobytes()], pa.binary())],
                names=["block", "dim", "ids", "rows"])

    size = vectors.agg(F.sum(F.col("dim") + 1).alias("n")).first().n or 0
    blocks = max(1, -(-8 * size // block_bytes))
    raw = stored(vectors.select("vec_id", "vector").repartition(blocks).mapInArrow(build, RAW), "vectors")
    dealt = salted_max(raw.select("dim", "block"), ["dim"], [F.lit(1).alias("_one")], [F.max("_one").alias("_one")], spread="block")
    return stored(copies_joined(raw, ["dim"], dealt.select("dim", "_salts").join(learned(vectors), "dim"), spread="block"), "codes")


def met(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """What each of ``queries`` (vec_id, vector, radius) finds in each block."""
    spark = index.sparkSession
    last = index.agg(F.max("block").alias("b")).first().b
    blocks = 1 + (last if last is not None else 0)
    # with few blocks, the queries are dealt to several tasks for each block
    parts = max(1, -(-2 * spark.sparkContext.defaultParallelism // blocks))
    sent = index.select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("kind"), F.col("dim").alias("radius"),
        F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("array<double>").alias("vector"), "ids", "rows", "model")
    nothing = F.lit(None).cast("binary")
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(F.xxhash64("vec_id", "vector"), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("kind"), "radius",
        "vec_id", "vector", nothing.alias("ids"), nothing.alias("rows"), nothing.alias("model"))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        for batch in batches:
            out = []
            for r, row in enumerate(batch.select(["block", "part", "kind", "radius", "vec_id"]).to_pylist()):
                if row["kind"] == 0:
                    if (row["block"], row["part"]) != now:
                        now, held = (row["block"], row["part"]), {}
                    dim = row["radius"]
                    ids, rows, model = (batch.column(c)[r].as_buffer() for c in ("ids", "rows", "model"))
                    held[dim] = Block(np.frombuffer(ids, "<i8"), np.frombuffer(rows, "<f8").reshape(-1, dim), Codes.load(model.to_pybytes()))
                elif (row["block"], row["part"]) == now:
                    vector = batch.column("vector")[r].values.to_numpy(zero_copy_only=False)
                    if len(vector) in held:
                        out.append((row["vec_id"], _hash(vector), *held[len(vector)].top(vector, row["vec_id"], row["radius"], k)))
            if out:
                n = [len(x[2]) for x in out]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(np.array([x[0] for x in out], np.int64), n)),
                    pa.array(np.repeat(np.array([x[1] for x in out], np.int64), n)),
                    pa.array(np.concatenate([x[2] for x in out])), pa.array(np.concatenate([x[3] for x in out])),
                    pa.array(np.concatenate([x[4] for x in out]).astype(np.int32))],
                    names=["query_id", "query_hash", "vec_id", "score", "distance"])

    return sent.unionByName(asked).repartitionById(blocks * parts, (F.col("block") * parts + F.col("part")).cast("int")) \
        .sortWithinPartitions("block", "part", "kind").mapInArrow(answer, FOUND)


def _hash(vector: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(vector.astype("<f8").tobytes()) >> 1


def best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)


def radii(index: DataFrame, vectors: DataFrame, k: int, probes: int = PROBES, share: float = SHARE) -> DataFrame:
    """(dim, radius): the code distance that takes in ``share`` of the exact neighbours of some rows, for each length."""
    lengths = max(1, vectors.select("dim").distinct().count())
    some = smallest(vectors.withColumn("h", F.xxhash64("vector", "vec_id")), max(1, probes // lengths), "h", ["dim"])
    every = (1 << 30)
    exact = best(met(index, some.select("vec_id", "vector", F.lit(every).alias("radius")).distinct(), k), k)
    per = exact.join(some.select(F.col("vec_id").alias("query_id"), "dim").distinct(), "query_id")
    return stored(per.groupBy("dim").agg(F.percentile("distance", F.lit(share)).alias("p"))
                  .select("dim", F.ceil("p").cast("int").alias("radius")), "radii")


def search(vectors: DataFrame, queries: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k nearest found among ``vectors`` for each of ``queries`` (both vec_id, vector, dim)."""
    index = build_index(vectors, block_bytes)
    # one row for each length: n lengths take n * n / 2 components at least, so there are no more than sqrt(2 * components)
    asked = queries.distinct().join(F.broadcast(radii(index, vectors, k)), "dim", "left") \
        .select("vec_id", "vector", F.coalesce("radius", F.lit(0)).alias("radius"))
    return best(met(index, asked, k), k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = participating(table(spark, sf_dir, "embeddings"))
    return search(vectors, vectors.filter(F.col("vec_id") % EVERY == 0))
