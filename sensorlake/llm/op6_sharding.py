"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

A row descends region -> rack -> shard. At each node every child draws
``-ln(u) / weight`` with u from a hash of the key and the child's own path, and
the smallest draw wins, so a child gets rows in proportion to its weight. A draw
depends on the child alone: a changed weight moves rows only into or out of that
child, which confines movement to the subtrees whose weights change. Capacity is
added as a new region, so one more shard takes rows only into itself.

Cases: a null key is a key like any other; null text has no bytes (size 8);
repeated rows get the same shard and neighbouring slots; an empty table gives an
empty result; extra columns are left alone, as only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table

SEED = 20260101
#: Slots of equal rows that are given back together.
PIECE = 65_536


@dataclass(frozen=True)
class Tree:
    """Weights of the shards as regions of racks of shards; shards are numbered left to right."""

    regions: tuple[tuple[tuple[float, ...], ...], ...]

    @property
    def shards(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)

    def grown(self, weight: float = 1.0) -> "Tree":
        """One more shard, in a region and rack of its own."""
        return Tree((*self.regions, ((weight,),)))


def balanced(shards: int, per_rack: int = 4, racks: int = 2) -> Tree:
    """Full regions of ``racks`` x ``per_rack`` shards; the rest are regions of one shard each."""
    full = shards // (per_rack * racks)
    block = tuple(tuple(1.0 for _ in range(per_rack)) for _ in range(racks))
    return Tree((*[block] * full, *[((1.0,),)] * (shards - full * per_rack * racks)))


def _draw(key: Column, path: Column, weight: Column) -> Column:
    """-ln(u) / weight, u in (0, 1) from 53 bits of the hash."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(SEED), path), 11)
    u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return F.when(weight > 0, -F.log(u) / weight)


def _choice(key: Column, parent: Column, weights: Column) -> Column:
    """Index of the child with the smallest draw; ``weights``: array of the children's weights."""
    draws = F.transform(weights, lambda w, i: F.struct(
        F.coalesce(_draw(key, F.concat_ws("/", parent, i.cast("string")), w),
                   F.lit(float("inf"))).alias("draw"), i.alias("i")))
    return F.array_min(draws)["i"]


def _floats(values) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


def place(rows: DataFrame, tree: Tree, key: str = "doc_id", out: str = "shard") -> DataFrame:
    """Add the shard of each row."""
    regions = tree.regions
    k = F.col(key)
    rack_w = F.array(*[_floats(sum(rack) for rack in region) for region in regions])
    shard_w = F.array(*[F.array(*[_floats(rack) for rack in region]) for region in regions])
    first, n = [], 0
    for region in regions:
        row = []
        for rack in region:
            row.append(n)
            n += len(rack)
        first.append(F.array(*[F.lit(x) for x in row]))
    d = rows.withColumn("_r", _choice(k, F.lit("root"), _floats(sum(map(sum, r)) for r in regions)))
    d = d.withColumn("_k", _choice(k, F.concat_ws("/", F.lit("region"), F.col("_r").cast("string")),
                                   F.get(rack_w, F.col("_r"))))
    d = d.withColumn("_s", _choice(k, F.concat_ws("/", F.lit("rack"), F.col("_r").cast("string"),
                                                  F.col("_k").cast("string")),
                                   F.get(F.get(shard_w, F.col("_r")), F.col("_k"))))
    base = F.get(F.get(F.array(*first), F.col("_r")), F.col("_k"))
    return d.withColumn(out, (base + F.col("_s")).cast("int")).drop("_r", "_k", "_s")


def numbered(rows: DataFrame, within: str, order: list[str], buckets: int = 4096, piece: int = PIECE) -> DataFrame:
    """Add ``slot``: 0, 1, ... within each value of ``within``.

    Rows are dealt to hash buckets of all the ordering columns; a bucket's first
    slot is the sum of the smaller buckets' counts, so no task sees a whole shard.
    Fully equal rows are counted first and given back as a run of slots, so copies
    of one row don't meet in one sort. A run is cut into pieces of ``piece`` slots,
    which are dealt to all tasks, so a row of any number of copies is spread.
    """
    spread = F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int")
    kinds = rows.withColumn("_b", spread).groupBy(within, "_b", *order).agg(F.count("*").alias("_n"))
    sizes = kinds.groupBy(within, "_b").agg(F.sum("_n").alias("_m"))
    ahead = Window.partitionBy(within).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(within, "_b", F.coalesce(F.sum("_m").over(ahead), F.lit(0)).alias("_first"))
    run = Window.partitionBy(within, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = kinds.withColumn("_at", F.coalesce(F.sum("_n").over(run), F.lit(0)))
    both = placed.join(first, [within, "_b"])
    start = F.col("_first") + F.col("_at")
    last = F.floor((F.col("_n") - 1) / piece)
    pieces = both.select(within, *order, start.alias("_from"), (start + F.col("_n") - 1).alias("_to"),
                         F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_p")) \
        .select(within, *order, (F.col("_from") + F.col("_p") * piece).alias("_from"), "_to") \
        .repartition(within, "_from")
    to = F.least("_to", F.col("_from") + (piece - 1))
    return pieces.select(within, *order, F.explode(F.sequence("_from", to)).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    tree = balanced(shards)
    sized = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    placed = place(place(sized, tree), tree.grown(), out="grown_shard")
    slots = numbered(placed, "shard", ["doc_id", "size", "text_crc32", "grown_shard"])
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                        F.col("slot").cast("long"), "grown_shard")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
