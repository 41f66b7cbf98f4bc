"""Ids of whole texts by the public byte-level BPE tokenizers, a block of texts at a time.

The two vocabularies cut a text into words by fixed classes of characters and then
merge within each word, so a word always gets the same ids. A block's words are
found with array operations, each distinct word is merged once by the tokenizers
library, and the ids are put together by array look-ups. A text with a character
outside the safe alphabet, or with a special token's marker, goes through the
library whole. The ids equal the library's ``encode(..., add_special_tokens=False)``.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

from .common import utf8

SPACE, LETTER, NUMBER, OTHER = range(4)
#: Words kept with their ids in a Python worker; beyond it the store starts afresh.
KEPT_WORDS = 400_000

_LOADED: dict[tuple[str, bool], "TextIds"] = {}


def tokenizer(path: str, lower: bool) -> "TextIds":
    """The tokenizer of a file, loaded once for each Python worker."""
    if (path, lower) not in _LOADED:
        _LOADED[path, lower] = TextIds(path, lower)
    return _LOADED[path, lower]


def _printable() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable character: itself, or one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _classes(limit: int) -> np.ndarray:
    out = np.full(limit, OTHER, np.uint8)
    for kind, pattern in ((SPACE, r"\s"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        match = regex.compile(pattern).fullmatch
        out[[bool(match(chr(c))) for c in range(limit)]] = kind
    return out


class TextIds:
    """``lower``: the vocabulary of lower-case words with white space dropped, else that of cased
    words with a leading space."""

    def __init__(self, path: str, lower: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.lib = Tokenizer.from_file(path)
        self.model = self.lib.model
        self.size = self.lib.get_vocab_size()
        self.lower = lower
        self.lead = 0xC3 if lower else 0xC9
        self.cls = _classes((self.lead & 0x1F) * 64 + 64)
        self.table = _printable()
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.first, self.count = array("I"), array("q"), array("i")

    def _prepared(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes, in lower case if asked for, and which documents need the library."""
        hard = data > self.lead
        mark = (data[:-1] == 0x3C) & (data[1:] == 0x7C)
        bad = np.zeros(len(offs) - 1, bool)
        at = np.concatenate([np.flatnonzero(hard), np.flatnonzero(mark)])
        if len(at):
            bad[np.searchsorted(offs, at, "right") - 1] = True
        if self.lower:
            data = np.where((data >= 65) & (data <= 90), data + 32, data)
            after = np.zeros(len(data), bool)
            after[1:] = data[:-1] == 0xC3
            data = np.where(after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97), data + 32, data)
        return data, bad

    def _cuts(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each byte and where words begin."""
        n = len(data)
        kind = self.cls[np.minimum(data, 127)]
        lead = np.flatnonzero((data >= 0xC2) & (data <= self.lead))
        lead = lead[lead + 1 < n]
        wide = self.cls[((data[lead].astype(np.int32) & 0x1F) << 6) | (data[lead + 1] & 0x3F)]
        kind[lead] = wide
        kind[lead + 1] = wide
        doc = np.zeros(n + 1, bool)
        doc[offs] = True
        cut = doc.copy()
        cut[1:n] |= kind[1:] != kind[:-1]
        if self.lower:
            cut[:n] |= (kind == NUMBER) & ((data < 0x80) | (data >= 0xC0))
        else:
            # a run of spaces before a word leaves its last one to it, or as a word of its own
            end = np.flatnonzero(cut[1:n] & ~doc[1:n] & (kind[:-1] == SPACE) & (kind[1:] != SPACE)) + 1
            last = end - 1 - ((data[end - 1] >= 0x80) & (data[end - 1] < 0xC0))
            cut[last] = True
            cut[end[data[last] == 0x20]] = False
        quote = np.flatnonzero((data == 0x27) & cut[:n])
        quote = quote[quote + 1 < n]
        quote = quote[(kind[quote + 1] == LETTER) & ~doc[quote + 1]]
        if len(quote):
            one = data[quote + 1]
            second = np.minimum(quote + 2, n - 1)
            two = np.where((quote + 2 < n) & ~doc[quote + 2], data[second], 0)
            short = np.isin(one, list(b"stmd"))
            long = ((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108))
            take = short | long
            cut[quote[take] + 1] = False
            cut[quote[take] + 2 + long[take]] = True
        return kind, cut

    def _ids_of(self, words: list[str]) -> np.ndarray:
        known = self.known
        at = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
        if len(known) + int((at < 0).sum()) > KEPT_WORDS:
            self.clear()
            known = self.known
            at[:] = -1
        for k in np.flatnonzero(at < 0).tolist():
            w = words[k]
            ids = [x.id for x in self.model.tokenize(w.encode().decode("latin-1").translate(self.table))]
            at[k] = known[w] = len(self.first)
            self.first.append(len(self.flat))
            self.count.append(len(ids))
            self.flat.extend(ids)
        return at

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, where each text's begin); null is an empty text."""
        data, offs = utf8(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        data, bad = self._prepared(data, offs)
        kind, cut = self._cuts(data, offs)
        start = np.flatnonzero(cut[:-1])
        length = np.diff(np.append(start, len(data)))
        if self.lower:
            word = kind[start] != SPACE
            start, length = start[word], length[word]
            data = data[kind != SPACE]
        if bad.any():
            doc = np.searchsorted(offs, start, "right") - 1
            word = ~bad[doc]
            data = data[np.repeat(word, length)]
            start, length = start[word], length[word]
        bounds = np.zeros(len(start) + 1, np.int32)
        np.cumsum(length, out=bounds[1:])
        coded = pa.StringArray.from_buffers(len(start), pa.py_buffer(bounds),
                                            pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode()
        at = self._ids_of(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
        flat, first = np.array(self.flat, np.uint32), np.array(self.first, np.int64)
        sizes = np.array(self.count, np.int64)[at]
        stop = np.cumsum(sizes)
        total = int(stop[-1]) if len(stop) else 0
        ids = flat[np.repeat(first[at] - (stop - sizes), sizes) + np.arange(total)]
        ptr = np.concatenate([[0], stop])[np.searchsorted(start, offs)]
        if not bad.any():
            return ids, ptr
        parts, counts = [], []
        for d in range(len(offs) - 1):
            one = np.array(self.lib.encode(column[d].as_py(), add_special_tokens=False).ids, np.uint32) \
                if bad[d] else ids[ptr[d]:ptr[d + 1]]
            parts.append(one)
            counts.append(len(one))
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(counts)])


def ended(ids: np.ndarray, ptr: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each text's."""
    n = len(ptr) - 1
    out = np.full(len(ids) + n, end_id, np.uint32)
    to = np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(ptr))
    out[to] = ids
    return out, ptr + np.arange(n + 1)
