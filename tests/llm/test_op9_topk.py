import math

import numpy as np
import pytest

from sensorlake.llm import op9_topk as op

from tests.llm.conftest import SF, same


def brute(vectors, queries, k):
    out = []
    for qid, q in queries:
        scored = sorted((-int(np.dot(q, v)), vid) for vid, v in vectors if vid != qid and len(v) == len(q))
        out += [(qid, n + 1, vid, -s) for n, (s, vid) in enumerate(scored[:k])]
    return sorted(out)


def test_supplied_vectors(spark, duck):
    same(op.query(spark, SF), duck, op.ORACLE)


@pytest.mark.parametrize("block_rows", [37, 100000])
def test_blocks_and_ties(spark, block_rows):
    rng = np.random.default_rng(1)
    vectors = [(int(k), rng.integers(-9, 9, 5).tolist()) for k in range(150)]
    vectors += [(200 + k, [1, 2, 3, 4, 5]) for k in range(60)]  # one vector many times
    vectors += [(300 + k, [7, -70000]) for k in range(3)] + [(400, [0, 0, 0, 0, 0]), (401, []), (402, [])]
    queries = [v for v in vectors if v[0] % 20 == 0] + [(401, [])]
    df = spark.createDataFrame(vectors, "vec_id long, vector array<long>")
    asked = spark.createDataFrame(queries + queries[:1], "vec_id long, vector array<long>")
    got = sorted(tuple(r) for r in op.search(df, asked, 20, block_rows).collect())
    assert got == brute(vectors, queries, 20)


def test_slices_select_the_kth_value():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 40, 300)
    slices = [np.packbits(np.append((values >> b) & 1, np.zeros(20, int)).astype(np.uint8), bitorder="little").view(np.uint64)
              for b in range(6)]
    live = np.packbits(np.append(np.ones(300), np.zeros(20)).astype(np.uint8), bitorder="little").view(np.uint64)
    for k in (1, 20, 299, 300):
        v = op._kth(slices, live, k)
        assert v == np.sort(values)[::-1][k - 1]
        kept = np.unpackbits(op._at_least(slices, live, v).view(np.uint8), bitorder="little")[:300]
        assert (kept.astype(bool) == (values >= v)).all()


def test_added_slices_are_the_coarse_scores():
    rng = np.random.default_rng(3)
    rows = rng.integers(-40, 40, (130, 6))
    block = op.Block(np.arange(130), rows, fine=2)
    weights = [3, -5, 0, 1, -1, 37]
    coarse = (rows - rows.min()) >> 2
    top = (1 << block.bits) - 1
    want = sum(w * coarse[:, d] if w >= 0 else -w * (top - coarse[:, d]) for d, w in enumerate(weights))
    bits = [np.unpackbits(s.view(np.uint8), bitorder="little")[:130].astype(int) for s in block.added(weights)]
    assert (sum(b << k for k, b in enumerate(bits)) == want).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (20, None, 1), (40, [1.0, None], 1), (60, [nan, 0.0], 1), (80, [inf, 0.0], 1), (1, [0.25, 0.25], 2),
            (None, [1.0, 1.0], 2), (2, [0.25, 0.25], 3), (2, [0.25, 0.25], 3), (100, [0.1], 3), (0, [1.0, 0.5], 1)]
    vectors = op.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>, block int"))
    assert sorted(r.vec_id for r in vectors.collect()) == [0, 0, 1, 2, 2, 100]
    got = sorted(tuple(r) for r in op.search(vectors, vectors.filter("vec_id % 20 = 0")).collect())
    # the only vector of its length has no candidate; rows of the query's own id are none
    assert got == [(0, 1, 1, 64 * 16 + 32 * 16), (0, 2, 2, 1536), (0, 3, 2, 1536)]
    none = vectors.limit(0)
    assert op.search(none, none).count() == 0


def test_large_components_are_ranked_exactly(spark):
    rng = np.random.default_rng(6)
    rows = [(k, rng.normal(0, 2, 8).tolist()) for k in range(120)]
    for k, size in enumerate([5e6, -5e6, 1e12, -1e12, 3e17, 1e25, 1e300, -1e300, 2.0 ** 53, 2.0 ** 55]):
        rows += [(200 + 4 * k + j, [size * (1 + j / 8), *rng.normal(0, 2, 7).tolist()]) for j in range(4)]
    rows += [(300, [1e308] * 8), (320, [0.0, 1.0] * 4), (321, [0.0, 1.0] * 4), (340, [5e6] * 8), (341, [5e6] * 8)]
    vectors = op.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    # 64 * 1e308 is no double
    whole = [(k, [math.floor(64 * x) for x in v]) for k, v in rows if k != 300]
    assert {r.vec_id: [int(x) for x in r.vector] for r in vectors.collect()} == dict(whole)
    asked = [(k, v) for k, v in whole if k % 20 == 0]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in op.search(vectors, vectors.filter("vec_id % 20 = 0"), 20, 50).collect())
    want = []
    for q, v in asked:
        best = sorted((-sum(a * b for a, b in zip(v, w)), k) for k, w in whole if k != q)[:20]
        want += [(q, n + 1, k, -s if -1 << 63 <= -s < 1 << 63 else None) for n, (s, k) in enumerate(best)]
    assert got == sorted(want, key=lambda x: x[:2])
    assert any(x[3] is None for x in got) and any(x[3] and x[3] > 1 << 50 for x in got)


def test_scores_beyond_a_long_keep_their_order():
    values = sorted([s * (1 << b) + d for s in (-1, 1) for b in (62, 63, 64, 71, 72, 2000) for d in (-1, 0, 1)])
    score, beyond, big = (c.to_pylist() for c in op._columns(np.array(values, object)))
    keys = [(n, s if s is not None else 0, b or b"") for s, n, b in zip(score, beyond, big)]
    assert keys == sorted(keys) and len(set(keys)) == len(set(values))
