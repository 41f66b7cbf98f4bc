"""Near-duplicate join on word five-grams by an LSH forest.

A text is the set of its runs of five words (``Words``; a text of one to four words
is one run). Each of ``TREES`` tries holds for every text a signature: ``DEEPEST``
ordered bytes, each made from the least run under a hash function of its own. The tries
are kept as sorted lists (``prefixes``): all signatures of a trie in order, range-sorted
over all partitions, and for each two neighbours how many leading bytes they share. The
texts below a trie node are then a stretch of neighbours that share the node's prefix,
so one stored list answers every depth.

Texts of one set are one class. The search starts at the deepest prefixes and shortens
them until the target recall: the similarity of neighbours is estimated by the share of
their signatures' bytes that agree, and counted in bands (``likeness``). A pair of
similarity s shares a prefix of d bytes in some trie with chance 1 - (1 - s^d)^TREES, and
the prefix is shortened until every band in which neighbours were found is met with the
target recall (``shortened``); the neighbours below the shorter prefix are then counted
too, until nothing changes. ``prefix_length``, which meets pairs at the threshold itself
with that recall, is the shortest prefix that can be needed. A pair may be missed with the
chance that is left; one in a band without neighbours, with that of the longer prefix (at
most 0.06 at a similarity of 0.8), unless other links join the two.

Classes that share a prefix of the final length in some trie are linked, and the connected
components of these links are candidate groups. Within a group all pairs are verified by
exact Jaccard similarity, in blocks bounded by classes and bytes, each pair of blocks in a
task of its own, so a group of any size is spread over tasks and no pair of documents is
ever a row. A block pair gives back each class's number of linked documents and its least
linked class; the components of those are the result.

Result, one row per document: ``class_id``, the least doc_id of its component of
linked documents (its own if there is none); ``n_links``, the number of other
documents with a similarity of at least the threshold; ``copy_of``, the least doc_id
of the documents with the same set.

Cases: null text and text without words have no set and no links; rows of one doc_id
with different texts are different documents, equal rows are copies of each other; a
null doc_id is kept as null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, copies_joined, fresh, salted_max, stored, table, text_blocks
from .graph import components

RUN = 5
THRESHOLD = 0.8
TREES = 40
DEEPEST = 12
RECALL = 0.999
#: Classes of a block, and runs of all its classes; a task verifies two blocks against each other.
BLOCK = 512
BLOCK_RUNS = 2_000_000
#: Bands of similarity, from the threshold to 1, in which neighbours are counted.
BANDS = 8
#: An estimate may be so far off: neighbours so much below the threshold count in the first band.
MARGIN = 0.05
SEED = 11

SIGNED = "doc_id long, h long, set binary, size int, tries binary"
SETS = "set binary, runs binary"
VERIFIED = "set binary, links long, least binary"


def chance(depth: int, similarity: float, trees: int = TREES) -> float:
    """How likely a pair shares a prefix of ``depth`` in at least one trie."""
    return 1 - (1 - similarity ** depth) ** trees


def prefix_length(trees: int = TREES, threshold: float = THRESHOLD, recall: float = RECALL,
                  deepest: int = DEEPEST) -> int:
    """The longest prefix at which pairs at the threshold meet often enough."""
    depth = deepest
    while depth > 1 and chance(depth, threshold, trees) < recall:
        depth -= 1
    return depth


def shortened(depth: int, near: list[int], trees: int = TREES, threshold: float = THRESHOLD,
              recall: float = RECALL) -> int:
    """The longest prefix, of ``depth`` at most, that meets the pairs of each band often enough.

    ``near``: neighbours in each band; a band's pairs are taken to be as unlike as it allows.
    """
    seen = [k for k, n in enumerate(near) if n]
    if not seen:
        return depth
    return prefix_length(trees, threshold + (1 - threshold) * seen[0] / len(near), recall, depth)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def runs(column: pa.Array, size: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of each text's distinct runs, in ascending order, and where each text's begin."""
    words = Words(column)
    n = len(column)
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.vocab.cast(pa.binary()).to_pylist()),
                         np.uint64, len(words.vocab))
    word = hashed[words.codes]
    counts = words.counts()
    total = len(word)
    run = np.zeros(total, np.uint64)
    left = np.repeat(words.ptr[1:], counts) - np.arange(total)  # words from here to the text's end
    for k in range(size):
        part = np.zeros(total, np.uint64)
        part[:max(0, total - k)] = word[k:]
        # a short text's only run has fewer words
        run = np.where(k < left, _mixed(run + part * np.uint64(2 * k + 3) + np.uint64(k + 1)), run)
    whole = (left >= size) | ((np.repeat(counts, counts) < size) & (left == np.repeat(counts, counts)))
    doc = np.repeat(np.arange(n), counts)[whole]
    run = run[whole]
    order = np.lexsort((run, doc))
    doc, run = doc[order], run[order]
    fresh = np.ones(len(run), bool)
    fresh[1:] = (run[1:] != run[:-1]) | (doc[1:] != doc[:-1])
    doc, run = doc[fresh], run[fresh]
    return run, np.searchsorted(doc, np.arange(n + 1))


def set_names(run: np.ndarray, ptr: np.ndarray) -> list[bytes | None]:
    """128-bit name of each set, None for the empty one."""
    raw = memoryview(run.astype("<u8").tobytes())
    return [xxhash.xxh3_128_digest(raw[8 * a:8 * b]) if b > a else None
            for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True)]


def signatures(run: np.ndarray, ptr: np.ndarray, trees: int, depth: int, seed: int = SEED) -> np.ndarray:
    """For each set and trie the signature's ``depth`` bytes, in order (sets must not be empty)."""
    rng = np.random.default_rng(seed)
    flip = rng.integers(0, 1 << 32, (trees, depth), np.uint32)
    times = rng.integers(0, 1 << 31, (trees, depth), np.uint32) * np.uint32(2) + np.uint32(1)
    short = (_mixed(run) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(ptr) - 1, trees, depth), np.uint8)
    work = np.empty_like(short)
    for t in range(trees):
        for d in range(depth):
            np.bitwise_xor(short, flip[t, d], out=work)
            np.multiply(work, times[t, d], out=work)
            out[:, t, d] = _mixed(np.minimum.reduceat(work, ptr[:-1]).astype(np.uint64)) >> np.uint64(56)
    return out


def signed(docs: DataFrame, trees: int, depth: int) -> DataFrame:
    """doc_id, a hash of the text, the set's name and size and the tries' signatures of every document, stored."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, max_bytes=2 << 20):
            run, ptr = runs(batch.column("text"))
            size = np.diff(ptr)
            some = np.flatnonzero(size > 0)
            tries: list[bytes | None] = [None] * batch.num_rows
            if len(some):
                made = signatures(run, np.append(ptr[some], ptr[-1]), trees, depth)
                for k, one in zip(some.tolist(), made, strict=True):
                    tries[k] = one.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), pa.array(set_names(run, ptr), pa.binary()),
                 pa.array(size.astype(np.int32)), pa.array(tries, pa.binary())],
                names=["doc_id", "h", "set", "size", "tries"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), "text")
    return stored(rows.mapInArrow(sign, SIGNED), "signatures")


def shared(key: np.ndarray, tree: np.ndarray) -> np.ndarray:
    """Leading bytes that each signature but the first shares with the one before it (another trie's: none)."""
    differs = key[1:] != key[:-1]
    depth = np.where(differs.any(1), differs.argmax(1), key.shape[1])
    return np.where(tree[1:] == tree[:-1], depth, 0)


def prefixes(classes: DataFrame, trees: int, depth: int, shortest: int) -> DataFrame:
    """Links (u, v, shared) between neighbours in the sorted tries that share ``shortest`` bytes or more, stored.

    The signatures are sorted over all partitions. Each partition gives the links within
    it and its two end rows; the ends, in the same order, give those from one partition
    to the next.
    """

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            here = pa.Table.from_batches([batch])
            first = last is None
            if not first:
                here = pa.concat_tables([last, here])
            last = here.slice(here.num_rows - 1)
            names = here.column("set").combine_chunks()
            key = np.frombuffer(b"".join(here.column("key").to_pylist()), np.uint8).reshape(-1, depth)
            common = shared(key, here.column("tree").to_numpy())
            take = np.flatnonzero(common >= shortest)
            yield _links(names.take(pa.array(take + 1)), names.take(pa.array(take)), common[take])
            if first:
                yield _ends(here.slice(0, 1))
        if last is not None:
            yield _ends(last)

    at = F.col("tree") * depth + 1
    rows = classes.select("set", "tries", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")) \
        .select("tree", F.substr("tries", at, F.lit(depth)).alias("key"), "set")
    kind = "u binary, v binary, shared int, tree int, key binary"
    found = stored(rows.repartitionByRange("tree", "key", "set").sortWithinPartitions("tree", "key", "set")
                   .mapInArrow(link, kind), "prefixes")
    # two rows for each partition
    ends = found.filter(F.col("key").isNotNull()).select("tree", "key", F.col("u").alias("set"))
    across = ends.coalesce(1).sortWithinPartitions("tree", "key", "set").mapInArrow(link, kind)
    return found.unionByName(across).filter(F.col("key").isNull()).select("u", "v", "shared")


def _links(u: pa.Array, v: pa.Array, common: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(u))
    return pa.RecordBatch.from_arrays([u, v, pa.array(common.astype(np.int32)), none.cast(pa.int32()), none.cast(pa.binary())],
                                      names=["u", "v", "shared", "tree", "key"])


def _ends(row: pa.Table) -> pa.RecordBatch:
    kinds = {"u": pa.binary(), "v": pa.binary(), "shared": pa.int32(), "tree": pa.int32(), "key": pa.binary()}
    values = {"u": row.column("set")[0].as_py(), "v": None, "shared": None,
              "tree": row.column("tree")[0].as_py(), "key": row.column("key")[0].as_py()}
    return pa.RecordBatch.from_arrays([pa.array([values[c]], t) for c, t in kinds.items()], names=list(kinds))


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set, runs) of the documents (doc_id, h) in ``wanted``."""

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, max_bytes=2 << 20):
            run, ptr = runs(batch.column("text"))
            raw = run.astype("<u8").tobytes()
            yield pa.RecordBatch.from_arrays([
                pa.array(set_names(run, ptr), pa.binary()),
                pa.array([raw[8 * a:8 * b] for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True)], pa.binary())],
                names=["set", "runs"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), "text")
    same = rows["doc_id"].eqNullSafe(wanted["doc_id"]) & (rows["h"] == wanted["h"])
    return rows.join(wanted, same, "left_semi").select("text").mapInArrow(again, SETS).dropDuplicates(["set"])


def common_runs(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Matrix of the numbers of runs that each two sets share."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, of, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    many = counts[of] > 1
    owner, of = owner[many], (np.cumsum(counts > 1) - 1)[of[many]]
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(of, kind="stable")
    owner, of = owner[order], of[order]
    for a in range(0, int(of[-1]) + 1 if len(of) else 0, width):
        lo, hi = np.searchsorted(of, [a, a + width])
        part = np.zeros((len(sets), min(width, int(of[hi - 1]) - a + 1)), np.float32)
        part[owner[lo:hi], of[lo:hi] - a] = 1
        out += part @ part.T
    return out


def verified(group: list[tuple[int, bytes, int, bytes]], across: bool,
             threshold: float) -> list[tuple[bytes, int, bytes]]:
    """(set, documents linked to it, least set of its component) of one block, or ``across`` two blocks.

    ``group``: (block, set, documents of the class, runs).
    """
    block = np.array([g[0] for g in group])
    names = [g[1] for g in group]
    copies = np.array([g[2] for g in group], np.int64)
    sets = [np.frombuffer(g[3], "<u8") for g in group]
    sizes = np.array([len(s) for s in sets], np.float64)
    both = common_runs(sets).astype(np.float64)
    # equality at the threshold counts: compare whole numbers, with room for the product's rounding
    linked = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-9
    np.fill_diagonal(linked, False)
    if across:
        linked &= block[:, None] != block[None, :]
    order = sorted(range(len(names)), key=names.__getitem__)
    place = np.empty(len(names), np.int64)
    place[order] = np.arange(len(names))
    label = place.copy()
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], len(names)).min(1))
        if (low == label).all():
            break
        label = low
    links = linked @ copies
    return [(names[k], int(links[k]), names[order[label[k]]]) for k in range(len(names))]


def likeness(classes: DataFrame, links: DataFrame, threshold: float) -> dict[int, list[int]]:
    """For each shared length the neighbours in each band, by the share of their signatures' bytes that agree."""

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, other = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                          for c in ("one", "other"))
            # different values have equal bytes once in 256
            alike = ((one == other).mean(axis=1) * 256 - 1) / 255
            band = np.floor((alike - threshold) / max(1 - threshold, 1e-9) * BANDS + 1e-9)
            band = np.where(alike < threshold - MARGIN, -1, np.clip(band, 0, BANDS - 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("shared"), pa.array(band)], names=["shared", "band"])

    pairs = links.filter("u != v").groupBy(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")) \
        .agg(F.max("shared").alias("shared"))
    sides = pairs.join(classes.select(F.col("set").alias("u"), F.col("tries").alias("one")), "u") \
        .join(classes.select(F.col("set").alias("v"), F.col("tries").alias("other")), "v")
    counts: dict[int, list[int]] = {}
    for r in sides.select("shared", "one", "other").mapInArrow(agree, "shared int, band int").filter("band >= 0") \
            .groupBy("shared", "band").count().collect():
        counts.setdefault(r["shared"], [0] * BANDS)[r["band"]] += r["count"]
    return counts


def adapted(counts: dict[int, list[int]], trees: int, threshold: float, recall: float, deepest: int) -> list[int]:
    """The prefix lengths from the deepest to that at which the target recall is reached."""
    depths = [deepest]
    while True:
        near = [sum(n[k] for d, n in counts.items() if d >= depths[-1]) for k in range(BANDS)]
        depth = shortened(depths[-1], near, trees, threshold, recall)
        if depth == depths[-1]:
            return depths
        depths.append(depth)


def matches(docs: DataFrame, classes: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL,
            block: int = BLOCK, block_runs: int = BLOCK_RUNS, deepest: int = DEEPEST) -> tuple[DataFrame, list[int]]:
    """The verified groups' rows (VERIFIED), stored, and the prefix lengths that were tried."""
    links = prefixes(classes, trees, deepest, prefix_length(trees, threshold, recall, deepest))
    depths = adapted(likeness(classes, links, threshold), trees, threshold, recall, deepest)
    groups = stored(components(links.filter(F.col("shared") >= depths[-1]).select("u", "v")), "groups")
    groups = groups.withColumnRenamed("node", "set").join(classes.select("set", "first", "n", "size"), "set")
    size = salted_max(groups, ["label"], [F.count("*").alias("k"), F.sum("size").alias("all_runs")],
                      [F.sum("k").alias("k"), F.sum("all_runs").alias("all_runs")], spread="set")
    members = stored(copies_joined(groups, ["label"], size, spread="set")
                     .withColumn("blocks", F.greatest(F.ceil(F.col("k") / block), F.ceil(F.col("all_runs") / block_runs)).cast("int"))
                     .withColumn("b", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")), "members")
    runs_of = sets_of(docs, members.select(F.col("first.doc_id").alias("doc_id"), F.col("first.h").alias("h")))
    # a block meets itself and every other block of its group once
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                        lambda o: F.struct(F.least("b", o).alias("i"), F.greatest("b", o).alias("j")))
    sent = members.join(runs_of, "set").select("label", "b", "set", "n", "runs", F.explode(meets).alias("p"))
    sent = sent.select("label", "p.i", "p.j", "b", "set", "n", "runs")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, out = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["label"], row["i"], row["j"])
                if key != now:
                    if group:
                        out += verified(group, now[1] != now[2], threshold)
                    now, group = key, []
                group.append((row["b"], row["set"], row["n"], row["runs"]))
            if len(out) > 5000:
                yield _verified_batch(out)
                out = []
        if group:
            out += verified(group, now[1] != now[2], threshold)
        if out:
            yield _verified_batch(out)

    found = stored(sent.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j")
                   .mapInArrow(verify, VERIFIED), "verified")
    return found, depths


def classes_of(rows: DataFrame) -> DataFrame:
    """One row for each set of ``signed`` rows: its least document, number of documents, size and signatures, stored."""
    first = F.struct("doc_id", "h")
    return stored(salted_max(
        rows.filter(F.col("set").isNotNull()), ["set"],
        [F.min(first).alias("first"), F.count("*").alias("n"), F.max("size").alias("size"), F.first("tries").alias("tries")],
        [F.min("first").alias("first"), F.sum("n").alias("n"), F.max("size").alias("size"), F.first("tries").alias("tries")],
        spread="doc_id"), "classes")


def join(docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL,
         block: int = BLOCK, block_runs: int = BLOCK_RUNS) -> DataFrame:
    """One row per document: doc_id, h (hash of the text), class_id, n_links, copy_of, and ``kept``: whether it is
    the one that stands for its component."""
    rows = signed(docs, trees, DEEPEST)
    classes = classes_of(rows)
    found, _ = matches(docs, classes, threshold, trees, recall, block, block_runs)
    links = found.groupBy("set").agg(F.sum("links").alias("links"))
    label = components(found.select(F.col("set").alias("u"), F.col("least").alias("v")))
    known = classes.select("set", "first", "n", "_salts").join(links, "set", "left") \
        .join(label.withColumnRenamed("node", "set"), "set", "left") \
        .withColumn("label", F.coalesce("label", "set"))
    # the least document of each component
    least = salted_max(known, ["label"], [F.min("first").alias("least")], [F.min("least").alias("least")], spread="set")
    answer = copies_joined(known.withColumnRenamed("_salts", "_own"), ["label"], least, spread="set") \
        .select("set", "first", "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                F.col("_own").alias("_salts"))
    back = copies_joined(rows.select("doc_id", "h", "set"), ["set"], answer, spread="doc_id")
    own = F.struct("doc_id", "h")
    return back.select(
        "doc_id", "h", F.when(F.col("least").isNull(), F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("copy_of"),
        (F.col("least").isNull() | own.eqNullSafe(F.col("least"))).alias("kept"))


def _verified_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"set": pa.binary(), "links": pa.int64(), "least": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds.values())],
                                      names=list(kinds))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "copy_of")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component: that with the least doc_id; of equal rows one."""
    kept = stored(join(docs).filter("kept").groupBy("doc_id", "h").agg(F.count("*").alias("copies")), "kept")
    own = fresh(docs, "text_hash")
    rows = docs.withColumn(own, F.xxhash64("text"))
    same = lambda k: rows["doc_id"].eqNullSafe(k["doc_id"]) & (rows[own] == k["h"])
    single, again = kept.filter("copies = 1"), kept.filter("copies > 1")
    out = rows.join(single, same(single), "left_semi").drop(own)
    # equal ids and texts are one document: the least by the other columns that can be ordered
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    least = F.struct(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind])
    more = rows.join(again, same(again), "left_semi").groupBy("doc_id", own).agg(F.min_by(whole, least).alias("_row")).select("_row.*")
    return out.unionByName(more)
