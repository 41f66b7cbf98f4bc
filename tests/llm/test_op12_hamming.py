import numpy as np
import pytest

from sensorlake.llm import op12_hamming as op
from sensorlake.llm.common import table

from tests.llm.conftest import SF


def neighbours(vectors, k=20):
    """Exact neighbours of the queries, by sums from the first component on."""
    out = {}
    for qid, q in vectors:
        if qid % 20 == 0:
            near = []
            for vid, v in vectors:
                if vid != qid and len(v) == len(q):
                    s = 0.0
                    for a, b in zip(v, q, strict=True):
                        s += a * b
                    near.append((-s, vid))
            out[qid] = [(vid, -s) for s, vid in sorted(near)[:k]]
    return out


def recall(found, want):
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = 0
    for qid, near in want.items():
        mine = sorted(got.get(qid, []))
        assert [r for r, _, _ in mine] == list(range(1, len(near) + 1))
        assert [x[1:] for x in mine] == sorted([x[1:] for x in mine], key=lambda x: (-x[1], x[0]))
        hits += len({v for _, v, _ in mine} & {v for v, _ in near})
    return hits / max(1, sum(len(n) for n in want.values()))


def rows_of(df):
    return [(r.vec_id, list(r.vector)) for r in df.collect()]


def test_recall_on_supplied_vectors(spark):
    for sf, least in ((SF, 0.93), (SF.replace("0.001", "0.1"), 0.93)):
        want = neighbours(rows_of(op.participating(table(spark, sf, "embeddings"))))
        found = op.query(spark, sf).collect()
        assert recall(found, want) >= least
        exact = {(q, v): s for q, near in want.items() for v, s in near}
        assert all(exact.get((r.query_id, r.vec_id), r.score) == r.score for r in found)


@pytest.mark.parametrize("block_bytes", [3000, 1 << 23])
def test_lengths_copies_and_clusters(spark, block_bytes):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 24)) * rng.uniform(0.2, 5, (8, 1))
    rows = [(int(k), (centres[k % 8] + rng.normal(size=24) * 0.3).tolist()) for k in range(800)]
    rows += [(1000 + k, rows[3][1]) for k in range(300)]  # one vector many times
    rows += [(2000 + k, rng.normal(size=3).tolist()) for k in range(30)] + [(2100, [5.0]), (2101, [-2.0]), (2200, [0.5, 0.5])]
    df = spark.createDataFrame(rows + rows[:2], "vec_id long, embedding array<double>")
    vectors = op.participating(df)
    found = op.search(vectors, vectors.filter("vec_id % 20 = 0"), 20, block_bytes).collect()
    want = neighbours(rows + rows[:2])
    assert recall(found, want) >= 0.9


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 16))
    x[1000:1200] = x[:200] + rng.normal(size=(200, 16)) * 0.05
    block = op.Block(np.arange(3000), x, op.Codes.fit(x, float(np.sqrt((x * x).sum(1)).max())))
    bits = block.code.shape[1] * 8
    for q in range(0, 200, 20):
        code = block.code[block.ptr.searchsorted(q, "right") - 1]
        apart = np.bitwise_count(block.words ^ block._words(code[None])).sum(1)
        for radius in (0, 3, 17, 40, 90, 130, bits):
            for width in (8, 16):
                if radius < bits:
                    block.width = lambda radius, width=width: width
                rows, distance = block.within(code, radius)
                assert (rows == np.flatnonzero(apart <= radius)).all() and (distance == apart[rows]).all()


def test_thresholds_are_the_pigeonhole():
    for radius in range(0, 120, 7):
        for tables in (1, 3, 16, 32):
            t = op.thresholds(radius, tables)
            assert sum(x + 1 for x in t) == radius + 1 and min(t) >= -1


def test_learned_codes_keep_near_vectors_near():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2000, 32))
    codes = op.Codes.load(op.Codes.fit(x[:500], 20.0).dump())
    near = np.bitwise_count(codes.stored(x) ^ codes.stored(x + rng.normal(size=x.shape) * 0.05)).sum(1).mean()
    far = np.bitwise_count(codes.stored(x) ^ codes.stored(rng.normal(size=x.shape))).sum(1).mean()
    assert near < far / 5


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (20, None, 1), (40, [1.0, None], 1), (60, [nan, 0.0], 1), (80, [inf, 0.0], 1), (100, [0.0, -0.0], 1),
            (1, [0.25, 0.25], 2), (None, [1.0, 1.0], 2), (2, [0.25, 0.25], 3), (2, [0.25, 0.25], 3), (120, [0.5], 3), (0, [1.0, 0.5], 1),
            (3, [-1e30, 0.0], 0), (140, [], 0)]
    vectors = op.participating(spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int"))
    assert sorted(r.vec_id for r in vectors.collect()) == [0, 0, 1, 2, 2, 3, 120]
    got = sorted(tuple(r) for r in op.search(vectors, vectors.filter("vec_id % 20 = 0")).collect())
    assert [r[:3] for r in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 2), (0, 4, 3)] and got[0][3] == 0.375
    huge = spark.createDataFrame([(0, [1e300, 1e300]), (1, [1e300, -1e300]), (2, [1e-300, 0.0]), (3, [1e308, 1e308])],
                                 "vec_id long, embedding array<double>")
    huge = op.participating(huge)
    assert [(r.rank, r.vec_id) for r in sorted(op.search(huge, huge.filter("vec_id = 0")).collect())] == [(1, 3), (2, 2), (3, 1)]
    none = vectors.limit(0)
    assert op.search(none, none).count() == 0
