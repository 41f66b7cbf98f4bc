import math
import re
from collections import Counter

import numpy as np
import pytest

from sensorlake.llm import op11_lexical as op

from tests.llm.conftest import ASCII_LOWER, LONG, SF, same

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def brute(docs, items, k):
    bags = [(d, Counter(terms_of(t))) for d, t in docs if d is not None and terms_of(t)]
    n, all_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in sorted({(i, tuple(sorted(set(terms_of(t))))) for i, t in items}, key=repr):
        scored = []
        for d, b in bags:
            m = 50 + (50 * sum(b.values()) * n) // all_terms
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * b[t]) // (1000 * b[t] + 20 * m))
                        for t in text if b[t])
            if score > 0:
                scored.append((-score, d))
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def test_supplied_tables(spark, duck):
    same(op.query(spark, SF), duck, op.ORACLE)


@pytest.mark.parametrize("block_terms", [60, 1 << 22])
def test_blocks_ties_and_odd_rows(spark, documents, block_terms):
    rng = np.random.default_rng(1)
    vocab = [f"w{k}" for k in range(40)]
    text = lambda n: " ".join(rng.choice(vocab, n, p=(q := 1 / np.arange(1, 41)) / q.sum()))
    docs = [(k, text(int(rng.integers(1, 60)))) for k in range(120)]
    docs += [(200 + k, "W1 w3, w3; É und") for k in range(90)]  # copies: a hot stratum, ties
    docs += [(5, "w1 w2"), (5, "w1 w2"), (None, "w1 w9"), (300, None), (301, ""), (302, " -- "), (303, LONG + " w1")]
    items = [(1, "w1 w3 É"), (2, text(30)), (3, "nowhere at all"), (4, None), (5, ""), (None, "w3 w1 É w1"), (1, "w3 w1 É"),
             (6, "many words w39"), (6, "w38"), (7, LONG)]
    asked = spark.createDataFrame([(i, t, 0, "x") for i, t in items], "item_id long, text string, rank int, set_id string")
    got = [tuple(r) for r in op.ranked(documents(docs), asked, 7, block_terms).collect()]
    assert sorted(got, key=repr) == brute(docs, items, 7)


def test_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    some = documents([(1, "w1"), (2, "b")])
    assert op.ranked(documents([]), items).count() == 0
    assert op.ranked(some, items.limit(0)).count() == 0
    assert op.ranked(documents([(1, None), (2, "-")]), items).count() == 0


def test_visits_of_any_size_find_the_same(spark):
    rng = np.random.default_rng(2)
    n, words = 3000, 25
    m = np.sort(rng.integers(50, 90, n))
    doc, word = np.nonzero(rng.random((n, words)) < 1 / np.arange(2, words + 2))
    tf = rng.integers(1, 9, len(doc))
    ids = rng.permutation(n).astype(np.int64)
    order = np.lexsort((ids, m))
    block = op.Block.load(op.Block.build(doc, word, tf, ids[order], m, words).dump())
    ids = ids[order]
    score = np.zeros(n, np.int64)
    asked = [(3, 900), (7, 2500), (20, 4000), (0, 10)]
    for t, w in asked:
        at = word == t
        score[doc[at]] += w * (10 ** 9 * tf[at] // (1000 * tf[at] + 20 * m[doc[at]]))
    want = np.lexsort((ids, -score))[:50]
    for visit in (1, 64, 1 << 20):
        got, scores = block.top(asked, 50, visit)
        assert (got == ids[want]).all() and (scores == score[want]).all()
    assert (block.dfs() == np.bincount(word, minlength=words)).all()


def test_strata_below_the_best_are_not_visited():
    # one term: short documents first; the long ones' bound lies below the k-th score
    n = 4000
    m = np.sort(np.random.default_rng(3).integers(50, 4000, n))
    block = op.Block.build(np.arange(n), np.zeros(n, np.int64), np.ones(n, np.int64), np.arange(n), m, 1)
    visited = []
    scores = block._scores
    block._scores = lambda asked, strata: visited.append(int(block.size[strata].sum())) or scores(asked, strata)
    got, _ = block.top([(0, 7)], 20, 50)
    assert got.tolist() == list(range(20)) and sum(visited) < n // 10
