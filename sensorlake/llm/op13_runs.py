"""Periodic runs of words by recompression.

The words of a block of texts are numbered and laid end to end, with a number of its own
between two texts. Recompression makes a run-length grammar of that string, level by
level: block compression turns a stretch of one symbol into one symbol, then pair
compression replaces each left symbol with a right one behind it, where a hash of the
symbol says on which side it is. Equal stretches are parsed alike but for their edges.
So the longest common extension of two places is found by climbing the levels while both
places begin a symbol, and by going down once the symbols differ; each level takes a few steps.

A run that is three periods q long holds places i, i + q and i + 2 q with i a multiple of
q. The places of this harmonic grid with as many equal words as the shortest run has grid
places are the candidates, for every q; the extensions of i and i + q to both sides give the run
exactly. Of equal stretches the least period is kept: any other period of a stretch that
is three times as long is a multiple of it.

Cases: null text and text without words has no run and collapses to an empty text; null
ids and repeated rows are read like any other; texts of any length are read whole, a long
one in a block of its own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_blocks, utf8

#: A run is at least so many words, and so many times its period.
LEAST, TIMES = 24, 3
#: Candidates that are extended at once, and words that are copied at once.
LANES = 1 << 17

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
OUT = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class Level:
    """Symbols of a level, a mark before and behind them, and which of them the next level's symbols are made of."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray | None, blocks: bool) -> None:
        n = len(symbols)
        self.padded = np.empty(n + 2, np.int64)
        self.padded[0], self.padded[1:-1], self.padded[-1] = -2, symbols, -1
        self.blocks = blocks
        if starts is None:  # the last level
            self.begins = None
            return
        #: whether a symbol of the next level begins at a place (the end begins one too), and which
        self.begins = np.zeros(n + 1, bool)
        self.begins[starts] = self.begins[n] = True
        self.parent = np.cumsum(self.begins, dtype=np.int64) - 1
        #: the place where each symbol of the next level begins
        self.first = np.append(starts, n)


class Grammar:
    """Run-length grammar of a string of numbers; a symbol stands for one string wherever it occurs on its level."""

    def __init__(self, text: np.ndarray) -> None:
        self.levels: list[Level] = []
        symbols = np.unique(text, return_inverse=True)[1].astype(np.int64)
        turn = 0
        # once no symbol occurs twice, no two places have a symbol in common
        while len(symbols) and int(symbols.max()) + 1 < len(symbols):
            starts = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
            if len(starts) < len(symbols):
                times = np.diff(np.append(starts, len(symbols)))
                symbols = self._next(symbols, starts, times, True)
            left = _left(symbols, turn)
            paired = np.append(left[:-1] & ~left[1:], False)
            if paired.any():
                starts = np.flatnonzero(~np.append(False, paired[:-1]))
                behind = np.where(paired[starts], np.append(symbols, 0)[starts + 1] + 1, 0)
                symbols = self._next(symbols, starts, behind, False)
            turn += 1
        self.levels.append(Level(symbols, None, False))

    def _next(self, symbols: np.ndarray, starts: np.ndarray, more: np.ndarray, blocks: bool) -> np.ndarray:
        """Each different (first symbol, more) becomes a symbol of the next level."""
        self.levels.append(Level(symbols, starts, blocks))
        return np.unique(symbols[starts] * (int(more.max()) + 1) + more, return_inverse=True)[1].astype(np.int64)

    def extension(self, a: np.ndarray, b: np.ndarray, right: bool) -> np.ndarray:
        """How many symbols from the places a and b > a on (or before them, leftwards) are equal."""
        at, x, y = np.arange(len(a)), np.array(a, np.int64), np.array(b, np.int64)
        waiting = []
        for level in self.levels:
            differ = np.zeros(len(at), bool)
            up = np.zeros(len(at), bool)
            # after two equal symbols, both places begin a symbol of the next level or neither has an equal one
            for _ in range(3 if level.begins is not None else 1):
                if level.begins is not None:
                    up = level.begins[x] & level.begins[y]
                go = np.flatnonzero(~(differ | up))
                if not len(go):
                    break
                steps = _steps(level, x[go], y[go], right)
                differ[go] = steps == 0
                x[go] += steps if right else -steps
                y[go] += steps if right else -steps
            if level.begins is not None:
                up = ~differ & level.begins[x] & level.begins[y]
            waiting.append((at[~up], x[~up], y[~up]))
            at, x, y = at[up], x[up], y[up]
            if level.begins is None or not len(at):
                break
            x, y = level.parent[x], level.parent[y]
        at, x, y = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for level, more in zip(reversed(self.levels[:len(waiting)]), reversed(waiting), strict=True):
            if level.begins is not None:
                x, y = level.first[x], level.first[y]
            at, x, y = np.append(at, more[0]), np.append(x, more[1]), np.append(y, more[2])
            go = np.arange(len(at))
            while len(go):
                steps = _steps(level, x[go], y[go], right)
                x[go] += steps if right else -steps
                y[go] += steps if right else -steps
                go = go[steps > 0]
        out = np.zeros(len(a), np.int64)
        out[at] = x - a[at] if right else a[at] - x
        return out


def _steps(level: Level, x: np.ndarray, y: np.ndarray, right: bool) -> np.ndarray:
    """How many symbols the places can move on at once: 0 where the next ones differ, blocks as far as both go."""
    p, q = (x + 1, y + 1) if right else (x, y)
    same = level.padded[p] == level.padded[q]
    steps = same.astype(np.int64)
    if level.blocks and same.any():
        s, t = x[same], y[same]
        if right:
            steps[same] = np.minimum(level.first[level.parent[s] + 1] - s, level.first[level.parent[t] + 1] - t)
        else:
            steps[same] = np.minimum(s - level.first[level.parent[s - 1]], t - level.first[level.parent[t - 1]])
    return steps


def _left(symbols: np.ndarray, turn: int) -> np.ndarray:
    x = (symbols.astype(np.uint64) + np.uint64(turn + 1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(62)) & np.uint64(1) == 1


def grid(text: np.ndarray, longest: int, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chains of candidates: first place, period, and how many multiples of the period on."""
    places, periods, counts = [], [], []
    for q in range(1, longest // times + 1):
        some = text[::q]
        differ = np.flatnonzero(some[1:] != some[:-1])
        ends = np.append(differ, len(some) - 1)
        equal = np.diff(np.append(-1, ends)) - 1  # pairs of neighbours that are equal
        wide = max(least, times * q) // q - 1
        hit = np.flatnonzero(equal >= wide)
        if len(hit):
            places.append((ends[hit] - equal[hit]) * q)
            periods.append(np.full(len(hit), q))
            counts.append(equal[hit] - wide + 1)
    if not places:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(places), np.concatenate(periods), np.concatenate(counts)


def find_runs(text: np.ndarray, longest: int, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(start, length, period) of the runs of a string in which no run is longer than ``longest``."""
    found = np.zeros((0, 3), np.int64)
    place, period, count = grid(text, longest, least, times)
    if not len(place):
        return found
    grammar = Grammar(text)

    def stretches(i: np.ndarray, q: np.ndarray) -> np.ndarray:
        out = []
        for k in range(0, len(i), LANES):
            a, p = i[k:k + LANES], q[k:k + LANES]
            back, on = grammar.extension(a, a + p, False), grammar.extension(a, a + p, True)
            out.append(np.stack([a - back, back + on + p, p], 1))
        return np.concatenate(out)

    def kept(some: np.ndarray) -> np.ndarray:
        return some[some[:, 1] >= np.maximum(least, times * some[:, 2])]

    first = stretches(place, period)
    found = np.concatenate([found, kept(first)])
    # the candidates of the chain that the first one's run covers would give it again
    wide = np.maximum(least, times * period) // period - 1
    behind = first[:, 0] + first[:, 1] - place
    covered = np.where(first[:, 1] >= (wide + 1) * period, np.maximum((behind - 1) // period - wide + 1, 1), 1)
    place, count = place + covered * period, count - covered
    rest = np.flatnonzero(count > 0)
    while len(rest):
        to = max(1, int(np.searchsorted(np.cumsum(count[rest]), LANES, "right")))
        some, rest = rest[:to], rest[to:]
        n = count[some]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        q = np.repeat(period[some], n)
        found = np.concatenate([found, kept(stretches(np.repeat(place[some], n) + step * q, q))])
        if len(found) > LANES:
            found = _least_periods(found)
    return _least_periods(found)


def _least_periods(found: np.ndarray) -> np.ndarray:
    """Each stretch once, with its least period; by start, then period."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    one = np.ones(len(found), bool)
    one[1:] = (found[1:, :2] != found[:-1, :2]).any(1)
    found = found[one]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


class Spaced:
    """The words of a block of texts, parted by white space alone."""

    def __init__(self, column: pa.Array) -> None:
        self.data, offs = utf8(column)
        word = (self.data != 32) & ((self.data < 9) | (self.data > 13))
        before, after = np.empty_like(word), np.empty_like(word)
        before[:1], before[1:] = False, word[:-1]
        after[-1:], after[:-1] = False, word[1:]
        before[offs[:-1][offs[:-1] < len(word)]] = False
        after[offs[1:][offs[1:] > 0] - 1] = False
        self.starts = np.flatnonzero(word & ~before)
        self.sizes = np.flatnonzero(word & ~after) + 1 - self.starts
        self.ptr = np.searchsorted(self.starts, offs)
        places = np.zeros(len(self.starts) + 1, np.int64)
        np.cumsum(self.sizes, out=places[1:])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.starts),
                                                 [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(self.data[word]))])
        self.codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def arranged(self, order: np.ndarray) -> None:
        """The texts' words are replaced by the words with these numbers."""
        self.starts, self.sizes, self.codes = self.starts[order], self.sizes[order], self.codes[order]

    def joined(self, kept: np.ndarray) -> pa.Array:
        """Each text's kept words, joined by one space."""
        counts = np.add.reduceat(np.append(kept, False).astype(np.int64), np.minimum(self.ptr[:-1], len(kept)))
        counts[np.diff(self.ptr) == 0] = 0
        src = np.flatnonzero(kept)
        ends = np.cumsum(self.sizes[src] + 1)
        out = np.full(int(ends[-1]) if len(src) else 0, 32, np.uint8)
        for at in range(0, len(src), LANES):
            some = src[at:at + LANES]
            size = self.sizes[some]
            place = np.repeat(self.starts[some] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
            to = np.repeat(ends[at:at + LANES] - 1 - np.cumsum(size), size) + np.arange(int(size.sum()))
            out[to] = self.data[place]
        # a text ends before the space behind its last word
        last = np.cumsum(counts)
        upto = np.append(0, ends)[last]
        offs = np.zeros(len(counts) + 1, np.int64)
        lengths = np.maximum(np.diff(np.append(0, upto)) - 1, 0)
        np.cumsum(lengths, out=offs[1:])
        spare = np.ones(len(out), bool)
        spare[upto[counts > 0] - 1] = False
        return pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(offs), pa.py_buffer(out[spare])).cast(pa.string())


def block_runs(words: Spaced, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, list[list[dict]], pa.Array]:
    """Words, runs and collapsed text of each text of a block."""
    counts = np.diff(words.ptr)
    n = len(words.codes)
    row = np.repeat(np.arange(len(counts)), counts)
    # a symbol of its own behind each text
    text = np.empty(n + len(counts), np.int64)
    place = np.arange(n) + row
    text[place] = words.codes
    between = words.ptr[1:] + np.arange(len(counts))
    text[between] = n + np.arange(len(counts))
    found = find_runs(text, int(counts.max(initial=0)), least, times)
    of = np.searchsorted(between, found[:, 0])
    covered = np.zeros(len(text) + 1, np.int64)
    np.add.at(covered, found[:, 0] + found[:, 2], 1)
    np.add.at(covered, found[:, 0] + found[:, 1], -1)
    kept = (np.cumsum(covered)[:-1] == 0)[place]
    runs: list[list[dict]] = [[] for _ in range(len(counts))]
    base = words.ptr[:-1] + np.arange(len(counts))
    for r, (start, length, period) in zip(of.tolist(), found.tolist(), strict=True):
        runs[r].append({"start": start - int(base[r]), "length": length, "period": period})
    return counts, runs, words.joined(kept)


def periodic(docs: DataFrame, least: int = LEAST, times: int = TIMES,
             arrange: Callable[[pa.Array, np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """Words, runs (by start, then period) and text without repeated periods, of every row.

    ``arrange`` may put other words of a block in the places of its words: from the doc_ids and from where each text's
    words begin, it gives the number of the word for each place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches):
            words = Spaced(batch.column("text"))
            if arrange is not None:
                words.arranged(arrange(batch.column("doc_id"), words.ptr))
            counts, runs, collapsed = block_runs(words, least, times)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(counts.astype(np.int64)), pa.array(runs, pa.list_(RUN)), collapsed],
                names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, OUT)


def planted(ids: pa.Array, ptr: np.ndarray) -> np.ndarray:
    """The arrangement of the query's contract: in every tenth document, by the id's crc32, words from one on are periodic."""
    order = np.arange(ptr[-1])
    for doc_id, first, n in zip(ids.to_pylist(), ptr.tolist(), np.diff(ptr).tolist(), strict=False):
        if n and doc_id is not None and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            order[first + a:first + n] = first + a + np.arange(n - a) % p
    return order


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic(table(spark, sf_dir, "documents"), arrange=planted)
    # by exact length / period; runs come by start, then period, so the first of equals stays
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda x, y: F.when(
        y["length"] * x["period"] > x["length"] * y["period"], y).otherwise(x))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
