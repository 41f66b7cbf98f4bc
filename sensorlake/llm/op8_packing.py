"""Order-preserving packing of documents into windows of a fixed length.

Documents in ascending doc_id order are one stream of ids. A dynamic program places
the cuts between windows at the end of a document, of a sentence or, in a long
sentence, at every so many ids, with the smallest sum of padding and penalties:

    best(j) = min over i with p_j - p_i <= length of best(i) + length - (p_j - p_i) + penalty(j)

best(i) + p_i over the reachable i is a sliding minimum, so a monotone queue finds
every transition in constant time. A task holds one block of the stream and what the
block before it left behind its last cut. The rest at the end of a partition is cut
at powers of two, which need no padding. A window's number is the partition's times
2^32 plus its place there.

Cases: null or empty text has only the end id; a document longer than a window is
cut; rows of one doc_id follow each other by a hash of the text; an empty table gives
no rows; columns of any name beside doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import table, text_blocks
from .op5_token_files import in_order
from .tokens import TextIds, ended, tokenizer

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
LENGTH = 2048
#: Cost in ids of padding of a cut inside a document and of one inside a sentence.
DOCUMENT_CUT, SENTENCE_CUT = 2, 8
#: In a sentence, a cut is allowed after each so many ids.
STEP = 16

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, ids binary")


def sentence_ends(tok: TextIds) -> np.ndarray:
    """For each id of the vocabulary, whether it ends a sentence."""
    out = np.zeros(tok.size, bool)
    for word, k in tok.lib.get_vocab().items():
        if word.endswith("</w>"):
            body = word.removesuffix("</w>").rstrip("\"')]}")
            out[k] = body[-1:] in (".", "!", "?")
    return out


def candidates(n: int, doc_ends: np.ndarray, sentences: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a stream of n ids may be cut, and the penalty of each cut; ends with n.

    ``sentences``: positions right after a sentence's last id.
    """
    marks = np.unique(np.concatenate([[0, n], doc_ends, sentences]))
    gaps = np.diff(marks)
    extra = np.maximum(gaps - 1, 0) // step
    inner = np.repeat(marks[:-1], extra) + step * (1 + np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra))
    at = np.unique(np.concatenate([marks[1:], inner]))
    cost = np.full(len(at), SENTENCE_CUT)
    cost[np.isin(at, sentences, assume_unique=False)] = DOCUMENT_CUT
    cost[np.isin(at, doc_ends)] = 0
    return at, cost


def best_cuts(at: np.ndarray, cost: np.ndarray, length: int) -> tuple[list[float], list[int]]:
    """For each candidate the smallest cost of a division that ends there and the candidate before it (-1: none)."""
    best, back = [0.0] * len(at), [-1] * len(at)
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, -1)])  # value best + position, position, candidate
    for j, (p, c) in enumerate(zip(at.tolist(), cost.tolist(), strict=True)):
        low = p - length
        while queue[0][1] < low:
            queue.popleft()
        value, _, i = queue[0]
        found = value - low + c
        best[j], back[j] = found, i
        value = found + p
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, p, j))
    return best, back


def _path(at: np.ndarray, back: list[int], j: int) -> list[int]:
    out = []
    while j >= 0:
        out.append(int(at[j]))
        j = back[j]
    return out[::-1]


def window_cuts(n: int, doc_ends: np.ndarray, sentences: np.ndarray, length: int, final: bool) -> list[int]:
    """Ends of the windows of a stream of n ids; where it goes on, the last ids may be left for later."""
    ends: list[int] = []
    if n >= length + (not final):
        at, cost = candidates(n, doc_ends, sentences, min(STEP, length))
        best, back = best_cuts(at, cost, length)
        near = [j for j in range(len(at)) if at[j] > n - length]
        ends = _path(at, back, min(near, key=lambda k: (best[k], -at[k])))
    while final and (rest := n - (ends[-1] if ends else 0)):
        ends.append(n - rest + (1 << (rest.bit_length() - 1)))
    return ends


class _Packer:
    """The state of one partition's stream."""

    def __init__(self, length: int, part: int, with_ids: bool) -> None:
        self.length, self.base, self.windows, self.with_ids = length, part << 32, 0, with_ids
        self.ids = np.zeros(0, np.uint32)
        self.doc_ids = pa.array([], pa.int64())
        self.left = np.zeros(0, np.int64)  # ids here of each document
        self.done = np.zeros(0, np.int64)  # ids of it before
        self.total = np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, ptr: np.ndarray, doc_ids: pa.Array) -> None:
        n = np.diff(ptr)
        self.ids = np.concatenate([self.ids, ids])
        self.doc_ids = pa.concat_arrays([self.doc_ids, doc_ids])
        self.left = np.concatenate([self.left, n])
        self.done = np.concatenate([self.done, np.zeros(len(n), np.int64)])
        self.total = np.concatenate([self.total, n])

    def cut(self, ends_sentence: np.ndarray, final: bool) -> pa.RecordBatch | None:
        stops = np.cumsum(self.left)
        cuts = window_cuts(len(self.ids), stops, np.flatnonzero(ends_sentence[self.ids]) + 1, self.length, final) \
            if len(self.ids) else []
        if not cuts:
            return None
        cuts = np.array(cuts)
        upto = int(cuts[-1])
        marks = np.unique(np.concatenate([[0], cuts, stops[stops < upto]]))
        a, b = marks[:-1], marks[1:]
        doc = np.searchsorted(stops, a, "right")
        win = np.searchsorted(cuts, a, "right")
        begins = stops - self.left
        raw = memoryview(self.ids[:upto].astype("<u4").tobytes())
        views = [raw[4 * x:4 * y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
        out = pa.RecordBatch.from_arrays([
            self.doc_ids.take(pa.array(doc)), pa.array(self.done[doc] + a - begins[doc]), pa.array(b - a),
            pa.array([zlib.crc32(v) for v in views], pa.int64()), pa.array(self.total[doc]),
            pa.array(self.base + self.windows + win), pa.array(a - np.concatenate([[0], cuts])[win]),
            pa.array(views if self.with_ids else [None] * len(views), pa.binary()),
        ], names=[x.split()[0] for x in PIECES.split(", ")])
        self.windows += len(cuts)
        kept = int(np.searchsorted(stops, upto, "right"))
        self.ids = self.ids[upto:]
        self.doc_ids, self.total = self.doc_ids.slice(kept), self.total[kept:]
        self.left, self.done, begins = self.left[kept:], self.done[kept:], begins[kept:]
        if len(self.left) and begins[0] < upto:
            self.done, self.left = self.done.copy(), self.left.copy()
            self.done[0] += upto - begins[0]
            self.left[0] -= upto - begins[0]
        return out


def pack_documents(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID,
                   with_ids: bool = False) -> DataFrame:
    """Pieces of the windows; ``with_ids`` adds each piece's ids as little-endian 32-bit integers."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path, True)
        ends_sentence = sentence_ends(tok)
        packer = _Packer(length, TaskContext.get().partitionId(), with_ids)
        for batch in text_blocks(batches):
            packer.add(*ended(*tok.encode(batch.column("text")), end_id), batch.column("doc_id"))
            if (out := packer.cut(ends_sentence, False)) is not None:
                yield out
        if (out := packer.cut(ends_sentence, True)) is not None:
            yield out

    return in_order(docs).mapInArrow(pack, PIECES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY)).drop("ids")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path(VOCABULARY)).drop("ids")
