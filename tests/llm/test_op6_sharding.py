import collections
import math
import struct
import zlib

import pytest
import xxhash

from sensorlake.llm import op6_sharding as op
from sensorlake.llm.common import table

from tests.llm.conftest import LONG


def draw(key, path, weight):
    h = 42
    if key is not None:
        h = xxhash.xxh64_intdigest(struct.pack("<q", key), h)
    h = xxhash.xxh64_intdigest(struct.pack("<i", op.SEED), h)  # an int hashes as four bytes
    h = xxhash.xxh64_intdigest(path.encode(), h)
    u = ((h >> 11) + 0.5) / (1 << 53)
    return -math.log(u) / weight


def place(key, tree):
    r = min(range(len(tree.regions)), key=lambda i: draw(key, f"root/{i}", sum(map(sum, tree.regions[i]))))
    racks = tree.regions[r]
    k = min(range(len(racks)), key=lambda i: draw(key, f"region/{r}/{i}", sum(racks[i])))
    s = min(range(len(racks[k])), key=lambda i: draw(key, f"rack/{r}/{k}/{i}", racks[k][i]))
    return sum(len(x) for region in tree.regions[:r] for x in region) + sum(map(len, racks[:k])) + s


def test_descent_equals_brute_force(spark):
    tree = op.Tree((((1.0, 2.0), (1.0,)), ((3.0, 0.5, 0.5),)))
    got = {r.doc_id: r.shard for r in op.place(spark.range(500).toDF("doc_id"), tree).collect()}
    assert got == {k: place(k, tree) for k in range(500)}


def test_supplied_documents(spark):
    sf = "/root/testdata/sf0.01"
    out = op.query(spark, sf)
    rows = out.collect()
    docs = {r.doc_id: (r.text or "").encode() for r in table(spark, sf, "documents").collect()}
    tree = op.balanced(24)
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all((r.size, r.text_crc32, r.law, r.shard, r.grown_shard)
               == (len(docs[r.doc_id]) + 8, zlib.crc32(docs[r.doc_id]), "key", place(r.doc_id, tree), place(r.doc_id, tree.grown()))
               for r in rows)
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    plan = out._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_movement_is_confined(spark):
    keys = spark.range(20_000).toDF("doc_id")
    at = lambda tree: {r.doc_id: r.shard for r in op.place(keys, tree).collect()}
    tree = op.balanced(24)
    before, grown = at(tree), at(tree.grown())
    moved = [k for k in before if before[k] != grown[k]]
    assert {grown[k] for k in moved} == {24} and abs(len(moved) - 20_000 / 25) < 150
    # a heavier shard in the second region takes rows only from the rest of the tree and inside its own racks
    heavy = op.Tree((tree.regions[0], ((2.0, 1, 1, 1), tree.regions[1][1]), tree.regions[2]))
    after = at(heavy)
    region = lambda s: s // 8
    assert all(region(after[k]) == 1 for k in before if before[k] != after[k])
    counts = collections.Counter(before.values())
    assert max(counts.values()) < 1.25 * min(counts.values())


def test_odd_rows(spark, documents):
    rows = [(None, "a"), (None, None), (1, None), (2, ""), (3, LONG), (4, "same"), (4, "same"), (4, "other")]
    out = op.shard_documents(documents(rows)).collect()
    assert len(out) == 8 and len({r.shard for r in out if r.doc_id == 4}) == 1
    assert {r.size for r in out if r.doc_id in (1, 2)} == {8} and {r.text_crc32 for r in out if r.doc_id == 1} == {0}
    by = collections.defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert op.shard_documents(documents(rows).limit(0)).count() == 0


def test_a_third_of_equal_rows(spark, documents):
    rows = [(7, "copy")] * 300 + [(k, "x") for k in range(600)]
    out = op.shard_documents(documents(rows)).collect()
    slots = sorted(r.slot for r in out if r.shard == place(7, op.balanced(24)))
    assert len(out) == 900 and slots == list(range(len(slots))) and len(slots) > 300


@pytest.mark.parametrize("piece", [1, 7, 100, 300, 65_536])
def test_long_runs_are_cut_into_pieces(spark, piece):
    rows = [("s", 7)] * 300 + [("s", k) for k in range(100)] + [("t", 1)] * 7 + [("t", 2)] * 8
    got = op.numbered(spark.createDataFrame(rows, "shard string, k int"), "shard", ["k"], piece=piece).collect()
    assert collections.Counter((r.shard, r.k) for r in got) == collections.Counter(rows)
    for shard, n in (("s", 400), ("t", 15)):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))


@pytest.mark.parametrize("n", [1, 8, 9, 24, 31])
def test_any_number_of_shards(n):
    assert op.balanced(n).shards == n and op.balanced(n).grown().shards == n + 1
