import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sensorlake.llm import op5_token_files as op
from sensorlake.llm.common import table
from sensorlake.llm.tokens import TextIds

from tests.llm.conftest import LONG

PATH = public_tokenizers.path(op.VOCABULARY)
ODD = st.text(alphabet="ab' srelvmtd\n\t .1²é \u0085ÀßſΣİ中😀́<|endoftext|>", max_size=24)


@pytest.mark.parametrize("bits", [1, 2, 3, 7, 8, 9, 13, 16, 17, 24, 31, 32])
def test_round_trip_and_random_access(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 5, 100, 1001):
        ids = rng.integers(0, 1 << bits, n, np.uint64).astype(np.uint32)
        data = op.pack(ids, bits, block_ids=100)
        seg = op.Segment(data)
        assert (seg.ids(0, n) == ids).all() and seg.n == n
        for a, b in rng.integers(0, n + 1, (20, 2)):
            assert (seg.ids(int(a), int(b)) == ids[a:b]).all()
        blocks = -(-n // 100)
        assert len(data) == op.HEAD.size + 8 * blocks + sum(-(-min(100, n - 100 * k) * bits // 8) for k in range(blocks))
    with pytest.raises(ValueError):
        op.Segment(b"no segment" * 10)


def test_fewest_bits():
    assert [op.width(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


@pytest.fixture(scope="module", params=[("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def fast(request):
    return TextIds(public_tokenizers.path(request.param[0]), request.param[1])


@given(st.lists(st.one_of(st.none(), ODD), max_size=6))
@settings(max_examples=300, deadline=None)
def test_ids_equal_the_library(fast, texts):
    ids, ptr = fast.encode(pa.array(texts, pa.string()))
    got = [ids[a:b].tolist() for a, b in zip(ptr[:-1], ptr[1:], strict=True)]
    assert got == [fast.lib.encode(t or "", add_special_tokens=False).ids for t in texts]


def brute(rows):
    tok, at, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def result(df):
    return [tuple(r) for r in df.orderBy("start").collect()]


def test_supplied_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert result(op.query(spark, "/root/testdata/sf0.001")) == brute(rows)


def test_odd_rows(spark, documents):
    rows = [(None, "first"), (1, None), (2, ""), (3, LONG), (4, "same"), (4, "same"), (4, "same"), (9, "<|endoftext|> 中")]
    docs = documents(rows[::-1]).repartition(3)
    assert result(op.read_token_files(op.write_token_files(docs, PATH))) == brute(rows)
    assert op.read_token_files(op.write_token_files(docs.limit(0), PATH)).count() == 0


def test_the_store_of_words_starts_afresh(monkeypatch):
    monkeypatch.setattr("sensorlake.llm.tokens.KEPT_WORDS", 5)
    tok = TextIds(PATH, False)
    for text in ("one two three", "four five six seven eight nine ten", "one two"):
        ids, _ = tok.encode(pa.array([text]))
        assert ids.tolist() == tok.lib.encode(text, add_special_tokens=False).ids
