import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorlake.llm import op13_runs as op
from sensorlake.llm.common import table

from tests.llm.conftest import LONG, SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_of(words, least=24, times=3):
    """Every period on its own: maximal stretches of equal neighbours, the least period of each."""
    n, out = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def digests(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_of(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)))


def checked(spark, df, rows):
    assert sorted(map(repr, (tuple(r) for r in df.collect()))) == sorted(repr(digests(*r)) for r in rows)


def test_supplied_documents(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    checked(spark, op.query(spark, SF), docs)


def test_odd_documents(spark, documents, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(k, " ".join(f"w{x}" for x in rng.integers(0, 3, rng.integers(1, 400)))) for k in range(150)]
    rows += [(None, "a b " * 40), (500, None), (501, ""), (502, " \t\n "), (503, "one"), (504, LONG), (504, LONG), (505, "x y\x0b" * 60),
             (506, "É " * 24), (507, "É " * 23), (508, "a b c d e f g h i j " * 3), (509, "a b c d e f g h i j " * 2)]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r) for r in op.query(spark, str(tmp_path)).collect()}
    assert len(op.query(spark, str(tmp_path)).collect()) == len(rows)
    for d, t in rows:
        if t != LONG:
            assert got[d] == digests(d, t)
    assert got[504][1:5] == (1, 0, 72000, 8) and zlib.crc32(b"504") % 10
    assert op.periodic(documents([])).count() == 0


words = st.one_of(
    st.lists(st.sampled_from("ab"), max_size=70), st.lists(st.sampled_from("abc"), max_size=70),
    st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 12), st.lists(st.sampled_from("abcd"), max_size=8))
    .map(lambda x: x[2] + x[0] * x[1] + x[2]))


@given(st.lists(words, max_size=5), st.sampled_from([(24, 3), (4, 3), (9, 3), (6, 4)]))
@settings(max_examples=300, deadline=None)
def test_runs_are_those_of_every_period(texts, limits):
    counts, runs, kept = op.block_runs(op.Spaced(pa.array(["  ".join(t) for t in texts], pa.string())), *limits)
    for text, n, mine, rest in zip(texts, counts, runs, kept.to_pylist(), strict=True):
        want = runs_of(text, *limits)
        assert n == len(text) and [(r["start"], r["length"], r["period"]) for r in mine] == want
        assert rest == collapsed(text, want)


@given(st.lists(st.integers(0, 3), min_size=2, max_size=80), st.data())
@settings(max_examples=300, deadline=None)
def test_extensions_are_exact(text, data):
    text = np.array(text)
    a = data.draw(st.integers(0, len(text) - 1))
    b = data.draw(st.integers(a + 1, len(text)))
    grammar = op.Grammar(text)
    right = left = 0
    while b + right < len(text) and text[a + right] == text[b + right]:
        right += 1
    while left < a and text[a - left - 1] == text[b - left - 1]:
        left += 1
    assert grammar.extension(np.array([a]), np.array([b]), True)[0] == right
    assert grammar.extension(np.array([a]), np.array([b]), False)[0] == left


def test_a_long_periodic_text_needs_few_levels_and_steps():
    text = np.resize(np.random.default_rng(2).integers(0, 50, 1000), 300_000)
    grammar = op.Grammar(text)
    assert len(grammar.levels) < 80 and sum(len(lv.padded) for lv in grammar.levels) < 8 * len(text)
    assert grammar.extension(np.array([5]), np.array([1005]), True)[0] == 300_000 - 1005
    assert op.find_runs(text, len(text)).tolist() == [[0, 300_000, 1000]]
