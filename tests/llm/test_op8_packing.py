import collections
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sensorlake.llm import op8_packing as op
from sensorlake.llm.common import table

from tests.llm.conftest import LONG

PATH = public_tokenizers.path(op.VOCABULARY)


def checked(rows, df, length):
    """Every id lies in one piece, windows are gapless and no longer than ``length``; returns the windows' sizes."""
    tok = Tokenizer.from_file(PATH)
    pieces, windows = collections.defaultdict(list), collections.defaultdict(list)
    for r in df.collect():
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    texts = collections.defaultdict(list)
    for doc_id, text in rows:
        texts[doc_id].append(tok.encode(text or "", add_special_tokens=False).ids + [1])
    assert set(pieces) == set(texts)
    for doc_id, docs in texts.items():
        want = sum((ids for ids in docs), [])
        assert sum(r.length for r in pieces[doc_id]) == len(want)
        if len(docs) > 1:
            continue
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            part = np.array(want[at:at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(want), zlib.crc32(part))
            at += r.length
    for rs in windows.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= length
    return [sum(r.length for r in rs) for rs in windows.values()]


@pytest.mark.parametrize("length", [16, 2048])
def test_supplied_documents(spark, length):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    sizes = checked([(r.doc_id, r.text) for r in docs.collect()], op.pack_documents(docs, PATH, length), length)
    padding = sum(0 if n & (n - 1) == 0 else length - n for n in sizes)
    assert padding <= (0.01 if length > 16 else 0.2) * sum(sizes)


def test_odd_rows(spark, documents):
    rows = [(None, "first"), (1, None), (2, ""), (3, LONG), (4, "same"), (4, "same"), (5, "a" * 30000), (6, "中文 <|endoftext|>")]
    out = op.pack_documents(documents(rows), PATH)
    assert checked(rows, out, 2048)
    assert op.pack_documents(documents(rows).limit(0), PATH).count() == 0
    assert op.stage(spark, documents(rows), "").columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                           "sequence_id", "offset"]


def test_ids_of_the_pieces(spark, documents):
    for r in op.pack_documents(documents([(1, "some words. more words!"), (2, LONG)]), PATH, with_ids=True).collect():
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32


def test_cuts_have_the_least_cost():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n, length = int(rng.integers(5, 120)), int(rng.integers(4, 30))
        ends = np.unique(np.append(rng.integers(1, n + 1, 4), n))
        sentences = np.unique(rng.integers(1, n + 1, 8))
        at, cost = op.candidates(n, ends, sentences, min(op.STEP, length))
        best, back = op.best_cuts(at, cost, length)
        points, value = [0, *at.tolist()], [0.0]
        for j in range(1, len(points)):  # every transition tried
            value.append(min(value[i] + length - (points[j] - points[i]) + cost[j - 1]
                             for i in range(j) if points[j] - points[i] <= length))
        assert value[1:] == best
        cuts = op._path(at, back, len(at) - 1)
        assert cuts[-1] == n and all(b - a <= length for a, b in zip([0, *cuts], cuts))


def test_the_rest_is_cut_at_powers_of_two():
    cuts = op.window_cuts(1337, np.array([1337]), np.array([], int), 2048, True)
    assert np.diff([0, *cuts]).tolist() == [1024, 256, 32, 16, 8, 1]
    assert op.window_cuts(2048, np.array([2048]), np.array([], int), 2048, True) == [2048]
    assert op.window_cuts(100, np.array([100]), np.array([], int), 2048, False) == []
