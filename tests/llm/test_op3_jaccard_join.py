import collections
import random

import numpy as np
from sensorlake.llm import op3_jaccard_join as op
from sensorlake.llm.common import table
from sensorlake.llm.graph import components

from tests.llm.conftest import LONG, words_of


def shingles(text):
    w = words_of(text)
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """Per row number: (least doc_id of its component, links, least doc_id of equal sets)."""
    sets = [shingles(t) for _, t in rows]
    order = lambda k: (rows[k][0] is not None, rows[k][0] or 0)
    links, label = collections.defaultdict(set), list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                    links[a].add(b)
                    links[b].add(a)
                    x, y = label[a], label[b]
                    label = [min(x, y) if c in (x, y) else c for c in label]
    out = []
    for a in range(len(rows)):
        group = [k for k in range(len(rows)) if label[k] == label[a]]
        equal = [k for k in range(len(rows)) if sets[k] == sets[a]] if sets[a] else [a]
        out.append((rows[a][0], rows[min(group, key=order)][0], len(links[a]), rows[min(equal, key=order)][0]))
    return sorted(out, key=repr)


def copies(seed, families, size):
    rng = random.Random(seed)
    rows = []
    for _ in range(families):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randrange(30, 120))]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(3)):
                text[rng.randrange(len(text))] = f"x{rng.randrange(9999)}"
            rows.append((len(rows), " ".join(text)))
    return rows


def result(df):
    return sorted([(r.doc_id, r.class_id, r.n_links, r.copy_of) for r in df.collect()], key=repr)


def test_supplied_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(op.join(docs)) == brute(rows)


def test_groups_over_several_blocks(spark, documents):
    # one family holds a third of the rows and is cut into blocks of a few classes
    rows = copies(3, 1, 40) + [(100 + k, t) for k, t in copies(4, 16, 5)]
    got = result(op.join(documents(rows), block=4))
    assert got == brute(rows)


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, "..."), (4, "one two"), (5, "One, two!"), (6, "one two three"), (7, LONG), (7, LONG),
            (8, LONG + "end"), (None, "one two"), (9, "a b c d e"), (9, "f g h i j")]
    docs = documents(rows)
    assert result(op.join(docs)) == brute(rows)
    assert op.join(docs.limit(0)).count() == 0
    kept = op.stage(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    # one of each group; rows without words stand for themselves
    assert got == sorted([(1, None), (2, ""), (3, "..."), (None, "one two"), (6, "one two three"), (7, LONG),
                          (9, "a b c d e"), (9, "f g h i j")], key=repr)


def test_prefix_is_shortened_to_the_recall():
    depth = op.prefix_length(40, 0.8, 0.999, 12)
    recall = lambda d: 1 - (1 - 0.8 ** d) ** 40
    assert depth == 8 and recall(depth) >= 0.999 > recall(depth + 1)
    assert op.prefix_length(1, 0.5, 0.999, 12) == 1
    # the least similar band in which pairs were found decides; none, or only close ones, leave the prefix as it is
    assert op.shortened(12, [0] * 8) == 12
    assert op.shortened(12, [0, 0, 0, 0, 0, 0, 1, 5]) == 12
    assert op.shortened(12, [3, 0, 0, 0, 0, 0, 0, 0]) == 8
    assert [op.shortened(12, [0] * k + [1] * (8 - k)) for k in range(8)] == [8, 9, 11, 12, 12, 12, 12, 12]


def test_shared_prefixes():
    key = np.array([[1, 2, 3], [1, 2, 4], [1, 2, 4], [1, 2, 4], [9, 2, 4]], np.uint8)
    assert op.shared(key, np.array([0, 0, 0, 1, 1])).tolist() == [2, 3, 0, 0]


def rounds(docs, **more):
    found, depths = op.matches(docs, op.classes_of(op.signed(docs, op.TREES, op.DEEPEST)), **more)
    return {r.set: r.links for r in found.collect()}, depths


def test_rounds_follow_the_pairs(spark, documents):
    rng = random.Random(8)
    close, far = [], []
    for _ in range(30):
        base = [f"w{rng.randrange(9000)}" for _ in range(300)]
        close += [base, base[:-1]]
        other = list(base)
        for k in rng.sample(range(0, 300, 10), 6):  # each changed word spoils five runs
            other[k] = "changed"
        far += [base, other]
    _, depths = rounds(documents([(k, " ".join(w)) for k, w in enumerate(close)]))
    assert depths == [12]
    rows = [(k, " ".join(w)) for k, w in enumerate(far)]
    found, depths = rounds(documents(rows))
    assert len(depths) > 1 and depths[-1] == 8
    assert result(op.join(documents(rows))) == brute(rows)


def test_recall_near_the_threshold(spark, documents):
    rng = random.Random(12)
    rows = []
    for _ in range(400):
        base = [f"w{rng.randrange(99999)}" for _ in range(200)]
        other = list(base)
        for k in rng.sample(range(0, 200, 8), 4):
            other[k] = f"x{rng.randrange(99999)}"
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(other))]
    sets = [shingles(t) for _, t in rows]
    alike = [len(sets[k] & sets[k + 1]) / len(sets[k] | sets[k + 1]) for k in range(0, len(rows), 2)]
    near = [2 * k for k, s in enumerate(alike) if 0.8 <= s < 0.85]
    assert len(near) > 300
    links = {r.doc_id: r.n_links for r in op.join(documents(rows)).collect()}
    met = sum(links[k] == 1 for k in near)
    assert met >= 0.99 * len(near)
    assert all(links[2 * k] == 0 for k, s in enumerate(alike) if s < 0.8)


def test_groups_of_long_texts_are_cut_by_their_runs(spark, documents):
    rows = copies(5, 3, 6)
    assert result(op.join(documents(rows), block_runs=100)) == brute(rows)


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 80)] + [(300, 300), (301, 302), (302, 301)]
    rng.shuffle(edges)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {k: 0 for k in range(61)} | {100 + k: 100 for k in range(80)} | {301: 301, 302: 301}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
