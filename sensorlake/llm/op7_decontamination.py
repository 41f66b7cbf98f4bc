"""Benchmark decontamination with a distributed positional inverted index.

The training texts are stored as index blocks: for each block of a few MB, its
terms in order and, for each term, the positions of its occurrences. A search
slides a window of ten words over every benchmark item, takes the positions of
the window's rarest term over the whole corpus, and intersects them with the
offset-adjusted positions of the next rarer ones, so only starts where every term
stands in its place are left. ``proximity`` finds the items whose window terms all
lie, in any order, within a few more words than the window has.

The windows are made, folded and put in order by Spark: equal rows of items and equal
windows of several items are searched once, and what is found is joined back to the items
that have it. An index block meets the windows in slices of at most about ``SLICE_WORDS``
words, each packed by a task and broadcast while its findings are written.

Cases: null or empty text and text without words has no words and no hit; an item
without words has no window; an item of fewer words than a window is one window;
repeated rows, of documents or items, each count by themselves (items by item_id);
empty tables give empty or clean results; other columns are not read, and a null
item_id is left out of the digest's list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, copies_joined, fitted, fresh, salted_max, stored, table, text_blocks

WINDOW = 10
#: Words of the windows (of eight bytes in the mean, fewer longer ones) that are broadcast at a time.
SLICE_WORDS = 2_000_000
#: Windows that are cut from an item at once.
PIECE = 1000
#: Candidate starts that are checked at once.
CHUNK = 262_144

INDEX = ("block long, doc_ids array<long>, hashes array<long>, doc_ptr binary, terms array<string>, counts array<int>, "
         "positions binary")
FOUND = "block long, i int, doc_id long, hash long, n_words long, hits array<struct<s:int,e:int>>, windows array<binary>"


def build_index(docs: DataFrame) -> DataFrame:
    """Index blocks of (doc_id, text), stored in the shared folder."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in text_blocks(batches):
            words = Words(batch.column("text"))
            order = np.argsort(words.codes, kind="stable").astype(np.int32)
            counts = np.bincount(words.codes, minlength=len(words.vocab)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array([(part << 24) + seq], pa.int64()),
                pa.ListArray.from_arrays([0, batch.num_rows], batch.column("doc_id")),
                pa.ListArray.from_arrays([0, batch.num_rows], batch.column("hash")),
                pa.array([words.ptr.astype(np.int32).tobytes()], pa.binary()),
                pa.ListArray.from_arrays([0, len(words.vocab)], words.vocab),
                pa.ListArray.from_arrays([0, len(counts)], pa.array(counts)),
                pa.array([order.tobytes()], pa.binary()),
            ], names=["block", "doc_ids", "hashes", "doc_ptr", "terms", "counts", "positions"])
            seq += 1

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("hash"))
    return stored(rows.mapInArrow(build, INDEX), "positional-index", wide=True)


def _words_of(column: str):
    low = F.translate(F.coalesce(F.col(column), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(low, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))


def windows_of(benchmark: DataFrame, size: int) -> DataFrame:
    """Distinct (item_id, w, terms): every window of the items, ``w`` a 128-bit name of its terms, stored."""
    items = benchmark.select(F.col("item_id").cast("long"), _words_of("text").alias("words")).filter(F.size("words") > 0).distinct()
    last = F.greatest(F.size("words") - size, F.lit(0))
    # a long item is cut into overlapping pieces first, so no row holds all its windows
    cut = F.transform(F.sequence(F.lit(0), last, F.lit(PIECE)), lambda p: F.slice("words", p + 1, F.lit(PIECE + size - 1)))
    pieces = items.select("item_id", F.explode(cut).alias("words"))
    each = F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0))),
                       lambda i: F.slice("words", i + 1, F.lit(size)))
    rows = pieces.select("item_id", F.explode(each).alias("terms"))
    return stored(rows.select("item_id", F.unhex(F.md5(F.array_join("terms", " "))).alias("w"), "terms").distinct(), "windows")


def from_the_rarest(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(w, terms, order) of each different window whose terms the corpus has; ``order``: places in it, rarest term first."""
    each = windows.groupBy("w").agg(F.first("terms").alias("terms"))
    places = each.select("w", F.size("terms").alias("n_terms"), F.posexplode("terms").alias("at", "term"))
    vocab = salted_max(places, ["term"], [F.lit(1).alias("one")], [F.lit(1).alias("one")], spread="w").select("term", "_salts")
    postings = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("p")) \
        .select(F.col("p.terms").alias("term"), F.col("p.counts").alias("n")) \
        .join(vocab.select("term"), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n"))
    counted = copies_joined(places, ["term"], vocab.join(postings, "term"), spread="w").filter(F.col("n").isNotNull())
    return counted.groupBy("w", "n_terms").agg(F.array_sort(F.collect_list(F.struct("n", "at", "term"))).alias("by")) \
        .filter(F.size("by") == F.col("n_terms")) \
        .select("w", F.transform(F.array_sort(F.transform("by", lambda x: F.struct(x["at"].alias("at"), x["term"].alias("term")))),
                                 lambda x: x["term"]).alias("terms"), F.transform("by", lambda x: x["at"]).alias("order"))


class Windows:
    """Some windows as numbers of a vocabulary, with each one's terms from the rarest up."""

    def __init__(self, rows: pa.Table | None, size: int) -> None:
        n = rows.num_rows if rows is not None else 0
        self.terms = np.full((n, size), -1, np.int32)
        self.order = np.tile(np.arange(size, dtype=np.int8), (n, 1))
        self.length = np.zeros(n, np.int32)
        self.names: list[bytes] = []
        self.vocab: list[str] = []
        if n:
            self.names = rows.column("w").to_pylist()
            lists = rows.column("terms").combine_chunks()
            self.length = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int32)
            coded = lists.flatten().dictionary_encode()
            there = np.arange(size) < self.length[:, None]
            self.terms[there] = coded.indices.to_numpy(zero_copy_only=False)
            self.order[there] = rows.column("order").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            self.vocab = coded.dictionary.to_pylist()


class Block:
    """An index block, with the position lists of a vocabulary's terms."""

    def __init__(self, row: dict, vocab: pa.Array) -> None:
        self.ptr = np.frombuffer(row["doc_ptr"], np.int32)
        counts = row["counts"]
        ends = np.cumsum(counts, dtype=np.int64)
        positions = np.frombuffer(row["positions"], np.int32)
        number = pc.index_in(row["terms"], value_set=vocab)
        at = np.flatnonzero(number.is_valid().to_numpy(zero_copy_only=False))
        number = number.take(pa.array(at)).to_numpy(zero_copy_only=False).astype(np.int64)
        by = np.argsort(number, kind="stable")
        at, number = at[by], number[by]
        self.low = np.zeros(len(vocab) + 1, np.int64)
        self.high = np.zeros(len(vocab) + 1, np.int64)
        sizes = counts[at].astype(np.int64)
        stop = np.cumsum(sizes)
        self.low[number], self.high[number] = stop - sizes, stop
        take = np.repeat(ends[at] - stop, sizes) + np.arange(stop[-1] if len(stop) else 0)
        # sorted by term and position: one search finds a position in a term's list
        self.keys = (np.repeat(number, sizes) << 32) | positions[take]

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of all the terms' occurrences and which of the terms each belongs to."""
        sizes = self.high[terms] - self.low[terms]
        which = np.repeat(np.arange(len(terms)), sizes)
        at = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.low[terms], sizes)
        return self.keys[at] & 0xFFFFFFFF, which

    def has(self, terms: np.ndarray, positions: np.ndarray) -> np.ndarray:
        want = (terms.astype(np.int64) << 32) | positions
        at = np.searchsorted(self.keys, want)
        out = at < len(self.keys)
        out[out] = self.keys[at[out]] == want[out]
        return out

    def follows(self, terms: np.ndarray, first: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Whether a term occurs among the ``room`` words from ``first`` on."""
        low = (terms.astype(np.int64) << 32) | first
        at = np.searchsorted(self.keys, low)
        out = at < len(self.keys)
        out[out] = self.keys[at[out]] < low[out] + room[out]
        return out


def _chunks(block: Block, anchors: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of windows with about CHUNK anchor occurrences each."""
    sizes = np.cumsum(block.high[anchors] - block.low[anchors])
    at = 0
    while at < len(anchors):
        before = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, before + CHUNK, "right")))
        yield np.arange(at, to)
        at = to


def phrase_matches(block: Block, win: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(window, start) of every exact occurrence in the block."""
    here = np.flatnonzero(((win.terms < 0) | (block.high[win.terms] > block.low[win.terms])).all(axis=1))
    anchor = win.order[here, 0].astype(np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for run in _chunks(block, win.terms[here, anchor]):
        w = here[run]
        positions, which = block.lists(win.terms[w, anchor[run]])
        start, w = positions - anchor[run][which], w[which]
        for k in range(1, win.terms.shape[1]):
            if not len(w):
                break
            off = win.order[w, k].astype(np.int64)
            term = win.terms[w, off]
            ok = term < 0
            ok[~ok] = block.has(term[~ok], start[~ok] + off[~ok])
            w, start = w[ok], start[ok]
        ok = start >= 0
        w, start = w[ok], start[ok]
        doc = np.searchsorted(block.ptr, start, "right")
        ok = start + win.length[w] <= block.ptr[doc]
        found.append((w[ok], start[ok]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def proximity_matches(block: Block, win: Windows, slack: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, position of its rarest term) where all its terms lie within ``slack`` words more
    than the window has, in any order, inside one document."""
    here = np.flatnonzero(((win.terms < 0) | (block.high[win.terms] > block.low[win.terms])).all(axis=1))
    anchor = win.order[here, 0].astype(np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for run in _chunks(block, win.terms[here, anchor]):
        w = here[run]
        positions, which = block.lists(win.terms[w, anchor[run]])
        w = w[which]
        span = win.length[w].astype(np.int64) + slack
        hit = np.zeros(len(w), bool)
        doc = np.searchsorted(block.ptr, positions, "right")
        # the rarest term stands somewhere in the span: try each place for the span's first word
        for shift in range(int(span.max(initial=0))):
            first = positions - shift
            ok = ~hit & (shift < span) & (first >= block.ptr[doc - 1])
            room = np.minimum(span, block.ptr[doc] - first)
            for k in range(win.terms.shape[1]):
                term = win.terms[w, k]
                live = ok & (term >= 0)
                ok[live] = block.follows(term[live], first[live], room[live])
            hit |= ok
        found.append((w[hit], positions[hit]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def search(index: DataFrame, benchmark: DataFrame, size: int = WINDOW, slice_words: int = SLICE_WORDS,
           slack: int | None = None) -> DataFrame:
    """Per indexed document (block, i): doc_id, n_words, hit ranges [s, e) and the items that occur.

    ``slack`` None finds exact phrases; a number finds proximity matches, whose
    range is the place of the rarest term.
    """
    windows = windows_of(benchmark, size)
    ordered = stored(from_the_rarest(index, windows), "ordered-windows")
    total = ordered.agg(F.sum(F.size("terms")).alias("words"), F.sum(F.octet_length(F.array_join("terms", ""))).alias("bytes")).first()
    slices = max(1, -(-(total.words or 0) // slice_words), -(-(total.bytes or 0) // (8 * slice_words)))
    sc = index.sparkSession.sparkContext
    found = None
    for k in range(slices):
        mine = ordered.filter(F.pmod(F.xxhash64("w"), F.lit(slices)) == k)
        shared = sc.broadcast(fitted(mine, lambda rows: Windows(rows, size)) or Windows(None, size))
        part = stored(index.select("block", "doc_ids", "hashes", "doc_ptr", "terms", "counts", "positions")
                      .mapInArrow(_searcher(shared, slack, k == 0), FOUND), "found", wide=True)
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    docs = found.groupBy("block", "i").agg(
        F.first("doc_id").alias("doc_id"), F.first("hash").alias("hash"), F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"))
    hit = found.select("block", "i", F.explode("windows").alias("w"))
    spread = F.struct("block", "i").alias("at")
    used = salted_max(hit.select("w", spread), ["w"], [F.lit(1).alias("one")], [F.lit(1).alias("one")], spread="at").select("w", "_salts")
    pairs = copies_joined(hit.select("w", spread), ["w"], windows.select("w", "item_id").join(used, "w"), spread="at")
    items = pairs.select("at.*", "item_id").distinct().groupBy("block", "i") \
        .agg(F.collect_list(F.struct("item_id")).alias("items"))  # a null id is an item too
    return docs.join(items, ["block", "i"], "left") \
        .withColumn("items", F.coalesce(F.transform("items", lambda x: x["item_id"]), F.array().cast("array<long>")))


def _searcher(shared, slack: int | None, clean: bool):
    """Search blocks for broadcast windows; ``clean``: documents without a hit have a row too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        win: Windows = shared.value
        vocab = pa.array(win.vocab, pa.string())
        names = pa.array(win.names, pa.binary())
        for batch in batches:
            for r in range(batch.num_rows):
                one = batch.slice(r, 1)
                row = {"doc_ptr": one.column("doc_ptr")[0].as_py(), "positions": one.column("positions")[0].as_py(),
                       "terms": one.column("terms").flatten(),
                       "counts": one.column("counts").flatten().to_numpy(zero_copy_only=False)}
                block = Block(row, vocab)
                n = len(block.ptr) - 1
                if slack is None:
                    w, s = phrase_matches(block, win)
                    e = s + win.length[w]
                else:
                    w, s = proximity_matches(block, win, slack)
                    e = s + 1
                doc = np.searchsorted(block.ptr, s, "right") - 1
                ranges, rptr = _merged(s, e, doc, block.ptr, n)
                pairs = np.unique(np.stack([doc, w], 1), axis=0) if len(w) else np.zeros((0, 2), np.int64)
                wptr = np.searchsorted(pairs[:, 0], np.arange(n + 1)).astype(np.int32)
                out = pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, one.column("block")[0].as_py(), np.int64)),
                    pa.array(np.arange(n, dtype=np.int32)),
                    one.column("doc_ids").flatten(),
                    one.column("hashes").flatten(),
                    pa.array(np.diff(block.ptr).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(rptr), ranges),
                    pa.ListArray.from_arrays(pa.array(wptr), names.take(pa.array(pairs[:, 1]))),
                ], names=["block", "i", "doc_id", "hash", "n_words", "hits", "windows"])
                yield out if clean else out.filter(pa.array(np.diff(wptr) > 0))
    return run


def _merged(s: np.ndarray, e: np.ndarray, doc: np.ndarray, ptr: np.ndarray, n: int):
    """Overlapping ranges of a document joined; ranges as offsets in the document, where each one's begin."""
    if len(s):
        by = np.argsort(s, kind="stable")
        s, e, doc = s[by], e[by], doc[by]
        reach = np.maximum.accumulate(e)
        fresh = np.ones(len(s), bool)
        fresh[1:] = (s[1:] > reach[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(fresh)
        s, e, doc = s[first], np.maximum.reduceat(e, first), doc[first]
    base = ptr[doc]
    ranges = pa.StructArray.from_arrays([pa.array((s - base).astype(np.int32)), pa.array((e - base).astype(np.int32))],
                                        names=["s", "e"])
    return ranges, np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)


def report(found: DataFrame) -> DataFrame:
    """One row per document of a search's findings."""
    covered = F.aggregate(
        "hits", F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(F.greatest(a["to"], x["e"]).alias("to"),
                              (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(a["to"], x["s"]))).alias("n")),
        lambda a: a["n"])
    listed = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id", "hash", "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256")) \
        .withColumn("contaminated", F.col("n_hit") > 0)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(table(spark, sf_dir, "documents", whole_buffers=False))
    return report(search(index, table(spark, sf_dir, "benchmark"))).drop("hash")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents without any benchmark window."""
    found = search(build_index(docs), table(spark, sf_dir, "benchmark"))
    flagged = report(found).filter("contaminated").select("doc_id", "hash").distinct()
    own = fresh(docs, "text_hash")
    rows = docs.withColumn(own, F.xxhash64("text"))
    same = rows["doc_id"].eqNullSafe(flagged["doc_id"]) & (rows[own] == flagged["hash"])
    return rows.join(flagged, same, "left_anti").drop(own)


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws, row_number() OVER () AS r FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(list_slice(ws, i, i + least(10, len(ws)) - 1), ' ') AS phrase
  FROM (SELECT item_id, ws, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS i FROM b WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, n, i, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS phrase
  FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w CROSS JOIN lens WHERE len(ws) >= n)),
m AS (SELECT r, dw.i, dw.n, item_id FROM dw JOIN bw ON dw.phrase = bw.phrase AND dw.n = bw.n),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM m) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
       FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""
