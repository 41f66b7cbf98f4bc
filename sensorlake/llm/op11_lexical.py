"""Ranked lexical search with a length-stratified index.

A document's score for an item sums w * impact over the item's terms, where the impact
is a function of the term's count tf and the document's length normaliser m alone. The
index groups documents of equal m into strata; in a stratum a term's postings are
grouped by tf, most frequent first, so that each impact is computed once per tf. The
first impact of a term in a stratum bounds what the term can add there, and the sum
over an item's terms bounds the stratum: strata are visited from the highest bound on,
until no bound reaches the k-th best score found.

An index block holds whole strata or, of a stratum with many terms, a piece of it dealt
by document, so a block is bounded (``BLOCK_TERMS``) however many documents share a
length. Items of equal terms are searched once; each set of terms meets each block once
and brings back at most k documents.

Cases: null text and text without a term isn't in the index; rows without doc_id take
no part; repeated rows count each, as documents of their own, and are returned each; a
null item text and items without a term that occurs give no rows; an item_id with several
texts is ranked for each set of terms; repeated items count once, and a null item_id is an id like any
other; empty tables give no rows; texts of any length are indexed whole; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Words, copies_joined, salted_max, stored, table, text_blocks

TOP = 50
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Terms, with repeats, of the documents that an index block holds about.
BLOCK_TERMS = 2 << 20
#: Documents of the first visit to strata; each further one takes twice as many.
FIRST_VISIT = 2048

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCKS = "block int, words array<string>, dfs array<long>, data binary"
FOUND = "set_id string, doc_id long, score long"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def bags(docs: DataFrame) -> DataFrame:
    """doc_id, n, the different terms (joined by spaces) and how often each occurs, of the documents with a term.

    Stored in the shared folder: every text is cut into terms once.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches):
            words = Words(batch.column("text"))
            n, v = words.counts(), max(1, len(words.vocab))
            key, tf = np.unique(np.repeat(np.arange(len(n)), n) * v + words.codes, return_counts=True)
            ptr = np.searchsorted(key, np.arange(len(n) + 1) * v)
            ends = pa.array(ptr, pa.int32())
            each = pa.ListArray.from_arrays(ends, words.vocab.take(pa.array(key % v)))
            times = pa.BinaryArray.from_buffers(pa.binary(), len(n), [None, pa.array(ptr * 4, pa.int32()).buffers()[1],
                                                                     pa.py_buffer(tf.astype("<i4"))])
            some = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n.astype(np.int64)), pc.binary_join(each, " "), times],
                                              names=["doc_id", "n", "words", "times"])
            yield some.filter(pa.array(n > 0))

    rows = docs.select(F.col("doc_id").cast("long"), "text").filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return stored(rows.mapInArrow(count, "doc_id long, n long, words string, times binary"), "bags")


def corpus_size(counted: DataFrame) -> tuple[int, int]:
    """N, the documents with a term, and L, all their terms with repeats."""
    row = counted.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
    return row.documents, row.terms or 0


class Block:
    """Documents by stratum; for each term its strata, and in each the postings by falling tf.

    A head is a term in a stratum, a group is a tf in a head. Blocks are stored as small numbers, each array with the
    fewest bytes: sizes in place of bounds, steps of strata, documents counted from their stratum's first one.
    """

    #: m and documents of each stratum; ids of the documents; heads of each term; from stratum to stratum, and groups, of
    #: each head; tf and documents of each group; the documents
    LAYOUT = ("m", "size", "ids", "heads", "step", "groups", "tf", "count", "place")

    def __init__(self, m: np.ndarray, size: np.ndarray, ids: np.ndarray, heads: np.ndarray, step: np.ndarray,
                 groups: np.ndarray, tf: np.ndarray, count: np.ndarray, place: np.ndarray) -> None:
        self.stored = (m, size, ids, heads, step, groups, tf, count, place)
        self.m, self.size, self.ids = m, size, ids
        self.heads = _bounds(heads)
        self.stratum = np.cumsum(step, dtype=np.int32)
        groups = _bounds(groups)
        of = np.repeat(self.stratum, np.diff(groups))
        # once for each tf of a term in a stratum
        impact = (1_000_000_000 * tf.astype(np.int64) // (1000 * tf.astype(np.int64) + 20 * m[of])).astype(np.int32)
        self.bound = impact[groups[:-1]].astype(np.int64)
        ends = _bounds(count)
        self.begins = ends[groups]
        self.each = np.repeat(impact, count)
        self.postings = np.repeat(_bounds(size)[of].astype(np.int32), count) + place.astype(np.int32)

    @classmethod
    def build(cls, doc: np.ndarray, word: np.ndarray, tf: np.ndarray, ids: np.ndarray, m: np.ndarray, words: int) -> Block:
        """From (document, word, tf) postings, one for each document and word; documents by (m, id)."""
        strata, firsts, of = np.unique(m, return_index=True, return_inverse=True)
        firsts = np.append(firsts, len(m))
        order = np.lexsort((doc, -tf, of[doc], word))
        doc, word, tf = doc[order], word[order], tf[order].astype(np.int64)
        stratum = of[doc]
        new_head = np.ones(len(doc), bool)
        new_head[1:] = (word[1:] != word[:-1]) | (stratum[1:] != stratum[:-1])
        new_group = new_head.copy()
        new_group[1:] |= tf[1:] != tf[:-1]
        at_head, at_group = np.flatnonzero(new_head), np.flatnonzero(new_group)
        return cls(strata, np.diff(firsts), ids, np.diff(np.searchsorted(word[at_head], np.arange(words + 1))),
                   np.diff(stratum[at_head], prepend=0), np.diff(np.append(np.searchsorted(at_group, at_head), len(at_group))),
                   tf[at_group], np.diff(np.append(at_group, len(doc))), doc - firsts[stratum])

    def dump(self) -> bytes:
        parts = [np.asarray(x).astype(np.promote_types(np.min_scalar_type(x.min(initial=0)), np.min_scalar_type(x.max(initial=0))))
                 for x in self.stored]
        head = "".join(f"{x.dtype.str}:{len(x)};" for x in parts).encode()
        return len(head).to_bytes(4, "little") + head + b"".join(x.tobytes() for x in parts)

    @classmethod
    def load(cls, data: bytes) -> Block:
        at = 4 + int.from_bytes(data[:4], "little")
        arrays = []
        for part in bytes(data[4:at]).decode().rstrip(";").split(";"):
            kind, size = part.split(":")
            arrays.append(np.frombuffer(data, kind, int(size), at))
            at += arrays[-1].nbytes
        m, size, ids, *rest = arrays
        return cls(m.astype(np.int64), size.astype(np.int64), ids.astype(np.int64), *rest)

    def dfs(self) -> np.ndarray:
        """Documents of each term."""
        return np.diff(self.begins[self.heads])

    def top(self, asked: list[tuple[int, int]], k: int, first_visit: int = FIRST_VISIT) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best documents for (term, weight) pairs; ties to the smaller id."""
        bound = np.zeros(len(self.m), np.int64)
        for t, w in asked:
            a, b = self.heads[t:t + 2]
            bound[self.stratum[a:b]] += w * self.bound[a:b]
        order = np.argsort(-bound, kind="stable")
        falling = bound[order]
        behind = np.cumsum(self.size[order])
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, visit = 0, first_visit
        while at < len(order):
            edge = int(scores[-1]) if len(scores) == k else 1
            # a stratum whose bound only equals the edge may hold a smaller id
            last = int(np.searchsorted(-falling, -edge, "right"))
            if at >= last:
                break
            to = min(last, int(np.searchsorted(behind, behind[at] + visit, "right")) + 1)
            score = self._scores(asked, order[at:to])
            some = np.flatnonzero(score >= edge)
            ids, scores = _best(np.append(ids, self.ids[some]), np.append(scores, score[some]), k)
            at, visit = max(to, at + 1), visit * 2
        return ids, scores

    def _scores(self, asked: list[tuple[int, int]], strata: np.ndarray) -> np.ndarray:
        """Scores of the documents of some strata, 0 for all others."""
        visited = np.zeros(len(self.m), bool)
        visited[strata] = True
        score = np.zeros(len(self.ids), np.int64)
        for t, w in asked:
            a, b = int(self.heads[t]), int(self.heads[t + 1])
            there = visited[self.stratum[a:b]]
            if there.all():
                some = slice(int(self.begins[a]), int(self.begins[b]))
            else:
                hit = np.flatnonzero(there) + a
                some = _ranges(self.begins[hit], self.begins[hit + 1])
            score[self.postings[some]] += w * self.each[some].astype(np.int64)
        return score


def _bounds(sizes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def _ranges(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    sizes = ends - begins
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(begins - before, sizes)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[scores >= edge], scores[scores >= edge]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def build_index(counted: DataFrame, documents: int, all_terms: int, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Index blocks (block, words, their documents, strata and postings as bytes), stored in the shared folder.

    Of the strata only those with more terms than an eighth of a block are broadcast. There are fewer than
    10 * sqrt(N) strata at all: a stratum more spans at least L / (50 N) terms more, and all sum up to L.
    """
    rows = counted.withColumn("m", F.expr(f"50 + (50 * n * {documents}L) div {all_terms}L"))
    piece = max(1, block_terms // 8)
    large = rows.groupBy("m").agg(F.sum("n").alias("terms")).filter(F.col("terms") > piece) \
        .select("m", F.ceil(F.col("terms") / piece).alias("pieces"))
    dealt = rows.join(F.broadcast(large), "m", "left") \
        .withColumn("piece", F.pmod(F.xxhash64("doc_id"), F.coalesce("pieces", F.lit(1))))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, words, times, ids, ms = [], [], [], [], []
        vocabulary = pa.array([], pa.string())
        held = 0
        for batch in text_blocks(batches, "words"):
            terms = pc.split_pattern(batch.column("words"), " ")
            docs.append(np.repeat(np.arange(held, held + batch.num_rows, dtype=np.int32), pc.list_value_length(terms).to_numpy()))
            # known terms keep their numbers
            coded = pa.concat_arrays([vocabulary, terms.flatten()]).dictionary_encode()
            words.append(coded.indices.to_numpy()[len(vocabulary):])
            vocabulary = coded.dictionary
            times.append(np.frombuffer(b"".join(batch.column("times").to_pylist()), "<i4"))
            ids.append(batch.column("doc_id").to_numpy())
            ms.append(batch.column("m").to_numpy())
            held += batch.num_rows
        if not held:
            return
        ids, ms = np.concatenate(ids), np.concatenate(ms)
        order = np.lexsort((ids, ms))
        place = np.empty(held, np.int32)
        place[order] = np.arange(held, dtype=np.int32)
        block = Block.build(place[np.concatenate(docs)], np.concatenate(words), np.concatenate(times),
                            ids[order], ms[order], len(vocabulary))
        yield pa.RecordBatch.from_arrays([
            pa.array([TaskContext.get().partitionId()], pa.int32()),
            pa.ListArray.from_arrays(pa.array([0, len(vocabulary)], pa.int32()), vocabulary),
            pa.array([block.dfs()], pa.list_(pa.int64())), pa.array([block.dump()], pa.binary())],
            names=["block", "words", "dfs", "data"])

    blocks = max(1, -(-all_terms // block_terms))
    return stored(dealt.repartition(blocks, "m", "piece").select("doc_id", "m", "words", "times").mapInArrow(build, BLOCKS), "strata")


def weighted(sets: DataFrame, index: DataFrame, documents: int) -> DataFrame:
    """(set_id, terms, weights) of the sets' terms that occur in the index."""
    one = sets.select("set_id", F.explode("terms").alias("term"))
    per_term = salted_max(one, ["term"], [F.lit(1).alias("_one")], [F.max("_one").alias("_one")], spread="set_id")
    found = index.select(F.explode(F.arrays_zip("words", "dfs")).alias("x")) \
        .select(F.col("x.words").alias("term"), F.col("x.dfs").alias("df")) \
        .join(per_term.select("term"), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * documents + 2)) / (2 * F.col("df") + 1).cast("double")))
    return copies_joined(one, ["term"], per_term.select("term", "_salts").join(found, "term"), spread="set_id") \
        .filter("df is not null").withColumn("weight", weight).filter("weight > 0") \
        .groupBy("set_id").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("pairs")) \
        .select("set_id", F.col("pairs.term").alias("terms"), F.col("pairs.weight").alias("weights"))


def search(index: DataFrame, asked: DataFrame, k: int = TOP) -> DataFrame:
    """The k best documents (set_id, rank, doc_id, score) for sets of weighted terms."""
    spark = index.sparkSession
    shape = index.agg(F.count("*").alias("n"), F.max("block").alias("last")).first()
    # with few blocks, the sets are dealt to several tasks for each block
    parts = max(1, -(-2 * spark.sparkContext.defaultParallelism // max(1, shape.n)))
    sent = index.select("block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("kind"),
                        F.lit(None).cast("string").alias("set_id"), F.col("words").alias("terms"),
                        F.lit(None).cast("array<long>").alias("weights"), "data")
    # an empty partition left no block: its sets meet nothing there
    dealt = asked.withColumn("blocks", F.sequence(F.lit(0), F.lit(shape.last if shape.n else 0)))
    met = sent.unionByName(dealt.select(
        F.explode("blocks").alias("block"), F.pmod(F.xxhash64("set_id"), F.lit(parts)).cast("int").alias("part"),
        F.lit(1).alias("kind"), "set_id", "terms", "weights", F.lit(None).cast("binary").alias("data")))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block, number = None, None, {}
        for batch in batches:
            out: list[tuple[str, np.ndarray, np.ndarray]] = []
            slim = batch.select(["block", "part", "kind", "set_id"]).to_pylist()
            for r, row in enumerate(slim):
                words = batch.column("terms")[r].as_py()
                if row["kind"] == 0:
                    now, number = (row["block"], row["part"]), {word: i for i, word in enumerate(words)}
                    block = Block.load(batch.column("data")[r].as_buffer())
                elif (row["block"], row["part"]) == now:
                    weights = batch.column("weights")[r].as_py()
                    pairs = [(number[t], w) for t, w in zip(words, weights, strict=True) if t in number]
                    if pairs:
                        out.append((row["set_id"], *block.top(pairs, k)))
            if out:
                sizes = [len(x[1]) for x in out]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(np.array([x[0] for x in out], object), sizes), pa.string()),
                    pa.array(np.concatenate([x[1] for x in out])), pa.array(np.concatenate([x[2] for x in out]))],
                    names=["set_id", "doc_id", "score"])

    found = met.repartitionById(((shape.last or 0) + 1) * parts, (F.col("block") * parts + F.col("part")).cast("int")) \
        .sortWithinPartitions("block", "part", "kind").mapInArrow(answer, FOUND)
    order = Window.partitionBy("set_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("set_id", F.col("rank").cast("int"), "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score of the k best of ``docs`` for each of ``items`` (item_id, text)."""
    counted = bags(docs)
    documents, all_terms = corpus_size(counted)
    index = build_index(counted, documents, max(1, all_terms), block_terms)
    wanted = items.filter(F.col("text").isNotNull()) \
        .select("item_id", F.array_sort(F.array_distinct(terms(F.col("text")))).alias("terms")) \
        .withColumn("set_id", F.sha2(F.array_join("terms", " "), 256)).distinct()
    wanted = stored(wanted, "items")
    spread = F.xxhash64("item_id").alias("_item")
    per_set = salted_max(wanted.select("set_id", "terms", spread), ["set_id"], [F.first("terms").alias("terms")],
                         [F.first("terms").alias("terms")], spread="_item")
    found = search(index, weighted(per_set.select("set_id", "terms"), index, documents), k) \
        .groupBy("set_id").agg(F.collect_list(F.struct("rank", "doc_id", "score")).alias("found"))
    rows = copies_joined(wanted.select("item_id", "set_id", spread), ["set_id"],
                         per_set.select("set_id", "_salts").join(found, "set_id"), spread="_item")
    return rows.select("item_id", F.explode("found").alias("x")).select("item_id", "x.rank", "x.doc_id", "x.score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
s AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(ts)) AS BIGINT) AS l FROM t WHERE len(ts) > 0),
p AS (
  SELECT r, doc_id, m, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT r, doc_id, 100 - 50 + ((50 * CAST(len(ts) AS BIGINT) * s.n) // s.l) AS m, unnest(ts) AS term
        FROM t, s WHERE len(ts) > 0)
  GROUP BY r, doc_id, m, term),
d AS (SELECT term, count(*) AS df FROM p GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * s.n + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM d, s),
i AS (
  SELECT DISTINCT item_id, list_sort(list_distinct(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS ts
  FROM benchmark WHERE text IS NOT NULL),
g AS (
  SELECT i.item_id, i.ts, p.r, p.doc_id, CAST(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * p.m))) AS BIGINT) AS score
  FROM (SELECT item_id, ts, unnest(ts) AS term FROM i) AS i JOIN p USING (term) JOIN w USING (term)
  GROUP BY i.item_id, i.ts, p.r, p.doc_id),
k AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id, ts ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM g WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
"""
