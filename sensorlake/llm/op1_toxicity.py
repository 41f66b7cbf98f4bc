"""Toxic spans with a linear-chain conditional random field.

Labelled tokens come from labelled documents: in a bounded training sample, a word
or word beginning that is frequent in toxic documents and absent from the others marks
its tokens in toxic documents; a toxic document without any such token has its most
suspicious one marked. A two-label chain with features of the word, its beginnings,
its ending and its neighbours is fitted by gradient ascent on the exact conditional
likelihood. Forward-backward over all tokens of a text gives each token's marginal;
a document's score is its largest, and runs of tokens from 0.5 on are its offending
spans, with character offsets.

The sample: at most ``SAMPLE`` toxic and as many other labelled documents, those with
the smallest hashes of all that have words; of a text over ``SAMPLE_BYTES`` bytes a
passage of at most so many bytes, at a place given by its hash.

Cases: null or empty text and text without words has score 0; conflicting labels of
one id count as toxic; null labels are left out; without a toxic label in the sample
every score is 0; null ids, repeated rows and very long texts are scored like any
other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, crc_mod, excerpt, fitted, smallest, table, text_blocks

SAMPLE = 2500
SAMPLE_BYTES = 32 << 10
#: Tokens on each side of a passage's middle.
AROUND = 8
SUPPORT = 3
#: Evidence (see ``marked``) of a sure mark, and of one where a document has none.
SURE, LIKELY = 14, 5
OUT = ("doc_id long, held_out boolean, score double, predicted int, "
       "spans array<struct<start:int,end:int,score:double>>")

#: Passages of each kind for a round of training.
PASSAGES = 5000
#: A feature of the word, and of a neighbour, counts if the passages have it so often.
OFTEN, OFTEN_BESIDE = 4, 200
#: Precision of the weights' Gaussian prior.
PRIOR = 0.5

_MIX = np.uint64(0x9E3779B97F4A7C15)
KINDS = ("word", "p3", "p4", "p5", "p6", "p7", "p8", "s3", "previous", "next")


def _mixed(x: np.ndarray, kind: int) -> np.ndarray:
    x = (x ^ np.uint64(kind * 0x51ED2701 + 1)) * _MIX
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_keys(vocab: pa.StringArray) -> dict[str, np.ndarray]:
    """64-bit feature keys of distinct words; beginnings that a word is too short for are 0."""
    n = len(vocab)
    offs = np.frombuffer(vocab.buffers()[1], np.int32)[vocab.offset:vocab.offset + n + 1].astype(np.int64) \
        if n else np.zeros(1, np.int64)
    data = np.frombuffer(vocab.buffers()[2], np.uint8) if n else np.zeros(0, np.uint8)
    size = np.diff(offs)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])

    def taken(at: np.ndarray, count: np.ndarray) -> np.ndarray:
        out = np.zeros(n, np.uint64)
        for k in range(8):
            live = k < count
            out[live] |= padded[at[live] + k].astype(np.uint64) << np.uint64(8 * k)
        return out

    whole = size.astype(np.uint64) * _MIX
    for k in range(0, int(size.max(initial=0)), 8):
        live = size > k
        part = taken(offs[:-1] + np.where(live, k, 0), np.where(live, np.minimum(size - k, 8), 0))
        whole = np.where(live, _mixed(whole ^ part, 99), whole)
    keys = {"word": _mixed(whole, 0), "previous": _mixed(whole, 8), "next": _mixed(whole, 9)}
    for kind, k in ((1, 3), (2, 4), (3, 5), (4, 6), (5, 7), (6, 8)):
        keys[KINDS[kind]] = np.where(size > k, _mixed(taken(offs[:-1], np.minimum(size, k)), kind), np.uint64(0))
    back = np.minimum(size, 3)
    keys["s3"] = np.where(size > 3, _mixed(taken(offs[1:] - back, back), 7), np.uint64(0))
    return keys


@dataclass
class Model:
    keys: np.ndarray
    weights: np.ndarray
    bias: float
    #: log potentials of toxic after toxic and of toxic after clean (also at the start); the others are 0
    move: np.ndarray

    def emissions(self, words: Words) -> np.ndarray:
        """Score of the toxic label against the other at each token."""
        keys = word_keys(words.vocab)
        own = np.full(len(words.vocab), self.bias)
        for kind in KINDS[:-2]:
            own += self._of(keys[kind])
        out = own[words.codes]
        first = np.zeros(len(out), bool)
        first[words.ptr[:-1][words.ptr[:-1] < len(out)]] = True
        before = self._of(keys["previous"])[words.codes]
        after = self._of(keys["next"])[words.codes]
        out[1:] += np.where(first[1:], 0, before[:-1])
        out[:-1] += np.where(first[1:], 0, after[1:])
        return out

    def _of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.weights[at], 0.0)


def marginals(emit: np.ndarray, first: np.ndarray, move: np.ndarray, chains: int = 1024) -> np.ndarray:
    """Probability of the toxic label at each token of sequences laid end to end.

    ``first`` marks the first token of each sequence. With two labels a message is one
    odds r, and a step maps it by (a r + b) / (c r + d): the maps of equal chunks are
    composed side by side, joined one after the other, and then applied.
    """
    n = len(emit)
    if not n:
        return np.zeros(0)
    stay, turn = np.exp(move)
    e = np.exp(np.clip(emit, -40, 40))
    # forward odds r_t = e_t (stay r + turn) / (r + 1); a first token follows a clean one
    ahead = _odds(e, first, np.array([[stay, turn], [1, 1]]), turn, chains)
    # backward ratio s_t = (stay e s + 1) / (turn e s + 1), over the next token's e and s
    last = np.zeros(n, bool)
    last[:-1] = first[1:]
    last[-1] = True
    back = _odds(e[::-1], last[::-1], np.array([[stay, 1], [turn, 1]]), 1.0, chains, before=True)[::-1]
    odds = ahead * back
    return odds / (1 + odds)


def _odds(e: np.ndarray, first: np.ndarray, m: np.ndarray, start: float, chains: int, before: bool = False) -> np.ndarray:
    """Fold x -> e * M(x) (or, ``before``, x -> M(e' x) with the element before's e') along the array."""
    n = len(e)
    width = -(-n // chains)
    full = chains * width
    pad = lambda x, v: np.concatenate([x, np.full(full - n, v, x.dtype)]).reshape(chains, width)
    e2, f2 = pad(e, 1.0), pad(first, True)
    if before:
        prior = np.concatenate([[1.0], e[:-1]])
        e2 = pad(prior, 1.0)
    (a, b), (c, d) = m
    # the map of each chunk as a 2 x 2 matrix, scaled to stay finite
    A, B = np.ones(chains), np.zeros(chains)
    C, D = np.zeros(chains), np.ones(chains)
    for t in range(width):
        x, f = e2[:, t], f2[:, t]
        if before:
            ga, gb, gc, gd = a * x, b, c * x, d
        else:
            ga, gb, gc, gd = a * x, b * x, c, d
        A, C = ga * A + gb * C, gc * A + gd * C
        B, D = ga * B + gb * D, gc * B + gd * D
        if f.any():
            s = start if before else start * x[f]
            A[f], B[f], C[f], D[f] = 0.0, s, 0.0, 1.0
        big = np.maximum(np.maximum(A, B), np.maximum(C, D))
        A, B, C, D = A / big, B / big, C / big, D / big
    state = np.empty(chains)
    now = start
    for k in range(chains):
        state[k] = now
        now = (A[k] * now + B[k]) / (C[k] * now + D[k])
    out = np.empty((chains, width))
    r = state
    for t in range(width):
        x = e2[:, t]
        if before:
            y = x * r
            r = (a * y + b) / (c * y + d)
            r = np.where(f2[:, t], start, r)
        else:
            r = x * (a * r + b) / (c * r + d)
            r = np.where(f2[:, t], start * x, r)
        r = np.clip(r, 1e-30, 1e30)
        out[:, t] = r
    return out.reshape(-1)[:n]


def families(words: Words, bands: int = 8, seed: int = 5) -> np.ndarray:
    """A number for each text of the sample, the same for near copies: two of its least hashed
    five-word runs, in one of several bands, are equal."""
    n = len(words.ptr) - 1
    word = word_keys(words.vocab)["word"][words.codes]
    run = np.zeros(len(word), np.uint64)
    for k in range(5):
        run += _mixed(np.roll(word, -k), k)
    rng = np.random.default_rng(seed)
    some = np.flatnonzero(words.counts() > 0)
    least = np.stack([np.minimum.reduceat(_mixed(run ^ np.uint64(x), 9), words.ptr[:-1][some])
                      for x in rng.integers(1, 1 << 60, 2 * bands)]) if len(some) else np.zeros((2 * bands, 0), np.uint64)
    group = np.arange(n)
    while True:
        before = group.copy()
        for b in range(bands):
            _, of = np.unique(_mixed(least[2 * b], 1) ^ least[2 * b + 1], return_inverse=True)
            low = np.full(of.max(initial=-1) + 1, n)
            np.minimum.at(low, of, group[some])
            group[some] = low[of]
        if (group == before).all():
            return group


def marked(words: Words, toxic: np.ndarray) -> np.ndarray:
    """Token labels from document labels: 1 for the tokens that only toxic documents have."""
    doc = np.repeat(np.arange(len(toxic)), words.counts())
    keys = word_keys(words.vocab)
    best = np.full(len(words.vocab), -np.inf)
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    for kind in ("word", "p4", "p5", "p6", "p7", "p8"):
        vocab_keys = keys[kind]
        distinct, of = np.unique(vocab_keys, return_inverse=True)
        pair = np.unique(of[words.codes].astype(np.int64) * len(toxic) + doc)
        key, where = pair // len(toxic), pair % len(toxic)
        seen1 = np.bincount(key[toxic[where]], minlength=len(distinct))
        seen0 = np.bincount(key[~toxic[where]], minlength=len(distinct))
        seen = np.maximum(seen1 + seen0, 1)
        share, usual = seen1 / seen, n1 / (n1 + n0)
        # evidence against chance: texts with it times the divergence of its toxic share
        with np.errstate(divide="ignore", invalid="ignore"):
            rest = np.where(share < 1, (1 - share) * np.log((1 - share) / (1 - usual)), 0.0)
            value = seen * (share * np.log(np.maximum(share, 1e-9) / usual) + rest)
        value = np.where((seen1 >= SUPPORT) & (share >= 0.8) & (distinct != 0), value, -np.inf)
        best = np.maximum(best, value[of])
    value = best[words.codes]
    label = (value > SURE) & toxic[doc]
    for k in np.flatnonzero(toxic):
        a, b = words.ptr[k], words.ptr[k + 1]
        if b > a and not label[a:b].any() and value[a:b].max() > LIKELY:
            label[a + int(value[a:b].argmax())] = True
    return label


def fit(words: Words, label: np.ndarray, rounds: int = 3, seed: int = 3) -> Model:
    """Maximum likelihood over passages around marked tokens and clean ones.

    After each round the clean tokens that the chain takes for toxic join the passages.
    """
    rng = np.random.default_rng(seed)
    doc = np.repeat(np.arange(len(words.ptr) - 1), words.counts())
    first = np.zeros(len(doc), bool)
    first[words.ptr[:-1][words.ptr[:-1] < len(doc)]] = True
    toxic = rng.permutation(np.flatnonzero(label))[:PASSAGES]
    centre = np.concatenate([toxic, rng.integers(0, len(doc), 2 * PASSAGES)])
    model = _fitted(words, label, doc, centre)
    for _ in range(rounds - 1):
        p = marginals(model.emissions(words), first, model.move)
        wrong = rng.permutation(np.flatnonzero((p >= 0.05) & ~label))[:PASSAGES]
        missed = rng.permutation(np.flatnonzero((p < 0.5) & label))[:PASSAGES]
        centre = np.concatenate([centre, wrong, missed])
        model = _fitted(words, label, doc, centre)
    return model


def _fitted(words: Words, label: np.ndarray, doc: np.ndarray, centre: np.ndarray, steps: int = 50) -> Model:
    # passages as rows of equal width; tokens outside the document are masked
    at = centre[:, None] + np.arange(-AROUND, AROUND + 1)
    inside = (at >= 0) & (at < len(doc))
    at = np.clip(at, 0, len(doc) - 1)
    inside &= doc[at] == doc[centre][:, None]
    keys = word_keys(words.vocab)
    columns = [keys[k][words.codes[at]] for k in KINDS[:-2]]
    columns += [_moved(keys["previous"][words.codes[at]], inside, 1), _moved(keys["next"][words.codes[at]], inside, -1)]
    columns = [np.where(inside, c, np.uint64(0)) for c in columns]
    # one kind after the other: sorting all kinds at once takes several times their size
    distinct = np.unique(np.concatenate([np.unique(c) for c in columns]))
    of = np.stack([np.searchsorted(distinct, c).astype(np.int32) for c in columns], -1)
    counts = np.bincount(of.reshape(-1), minlength=len(distinct))
    # features too rare to tell anything share one place without weight
    least = np.full(len(distinct), OFTEN)
    beside = np.zeros(len(distinct), bool)
    beside[of[..., -2:]] = True
    least[beside] = OFTEN_BESIDE
    kept = (counts >= least) & (distinct != 0)
    place = np.where(kept, np.cumsum(kept), 0).astype(np.int32)
    of, distinct = place[of], distinct[kept]
    y = label[at] & inside
    w, g2 = np.zeros(len(distinct) + 1), np.full(len(distinct) + 1, 1e-6)
    bias, move, gm = -3.0, np.array([0.0, -3.0]), np.full(3, 1e-6)
    pairs = inside[:, 1:] & inside[:, :-1]
    seen_stay = (pairs & y[:, :-1] & y[:, 1:]).sum()
    seen_turn = (pairs & ~y[:, :-1] & y[:, 1:]).sum() + (_heads(inside) & y).sum()
    for _ in range(steps):
        node, stay, turn = _expected(w[of].sum(-1) + bias, inside, move)
        gap = np.where(inside, y - node, 0.0)
        grad = np.bincount(of.reshape(-1), weights=np.repeat(gap.reshape(-1), of.shape[-1]), minlength=len(w)) - PRIOR * w
        grad[0] = 0
        head = np.array([gap.sum(), seen_stay - stay, seen_turn - turn])
        g2 += grad * grad
        gm += head * head
        w += 0.5 * grad / np.sqrt(g2)
        step = 0.3 * head / np.sqrt(gm)
        bias, move = bias + step[0], move + step[1:]
    return Model(distinct, w[1:], float(bias), move)


def _moved(x: np.ndarray, inside: np.ndarray, step: int) -> np.ndarray:
    """The neighbour's value at each place, 0 where there is none in the passage."""
    out = np.zeros_like(x)
    if step > 0:
        out[:, 1:] = np.where(inside[:, :-1], x[:, :-1], 0)
    else:
        out[:, :-1] = np.where(inside[:, 1:], x[:, 1:], 0)
    return out


def _expected(emit: np.ndarray, inside: np.ndarray, move: np.ndarray):
    """Marginals of passages, and the expected numbers of toxic tokens after toxic and after clean ones."""
    stay, turn = np.exp(move)
    e = np.exp(np.clip(emit, -40, 40))
    n, width = emit.shape
    r, s = np.empty_like(e), np.ones_like(e)
    for t in range(width):
        prior = np.full(n, turn)
        if t:
            prior = np.where(inside[:, t - 1], (stay * r[:, t - 1] + turn) / (r[:, t - 1] + 1), turn)
        r[:, t] = np.clip(e[:, t] * prior, 1e-30, 1e30)
    for t in range(width - 2, -1, -1):
        y = e[:, t + 1] * s[:, t + 1]
        s[:, t] = np.where(inside[:, t + 1], (stay * y + 1) / (turn * y + 1), 1.0)
    odds = r * s
    node = np.where(inside, odds / (1 + odds), 0.0)
    pairs = inside[:, :-1] & inside[:, 1:]
    x, y = r[:, :-1], e[:, 1:] * s[:, 1:]
    total = x * stay * y + x + turn * y + 1
    after_toxic = np.where(pairs, x * stay * y / total, 0).sum()
    after_clean = np.where(pairs, turn * y / total, 0).sum() + np.where(_heads(inside), node, 0).sum()
    return node, after_toxic, after_clean


def _heads(inside: np.ndarray) -> np.ndarray:
    """The first place of each passage that lies in its document."""
    out = inside.copy()
    out[:, 1:] &= ~inside[:, :-1]
    return out


def sample(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE) -> DataFrame:
    known = labels.filter((crc_mod("doc_id", 5) != 0) & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select("doc_id", "text").filter(F.col("text").rlike(r"[0-9A-Za-z]|[^\x00-\x7F]"))
    # only documents that are there are chosen from
    known = known.join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = smallest(known.withColumn("h", F.xxhash64("doc_id")), per_label, "h", ["toxic"]).drop("h")
    # two labels of at most SAMPLE rows
    # of an id with several texts, the same one in every run
    return rows.join(F.broadcast(chosen), "doc_id").withColumn("text", excerpt(F.col("text"), F.xxhash64("text"), SAMPLE_BYTES)) \
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))


def train(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE) -> Model | None:
    def learn(table: pa.Table) -> Model | None:
        found = sorted(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), table.column("toxic").to_pylist(),
                           strict=True))
        toxic = np.array([r[2] == 1 for r in found], bool)
        if not toxic.any():
            return None
        words = Words(pa.array([r[1] for r in found], pa.string()))
        # near copies would make any word of theirs look like evidence
        one = np.unique(families(words) * 2 + toxic, return_index=True)[1]
        words, toxic = Words(pa.array([found[k][1] for k in one], pa.string())), toxic[one]
        label = marked(words, toxic)
        return fit(words, label) if label.any() else None

    return fitted(sample(docs, labels, per_label).select("doc_id", "text", "toxic"), learn)


def tag(docs: DataFrame, model: Model | None) -> DataFrame:
    """Score and spans of every row."""
    rows = docs.select(F.col("doc_id").cast("long"), (crc_mod("doc_id", 5) == 0).alias("held_out"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches):
            words, p, score = scored(shared.value, batch.column("text"))
            spans = [_spans(words, p, k) if score[k] >= 0.5 else [] for k in range(batch.num_rows)]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("held_out"), pa.array(score),
                pa.array((score >= 0.5).astype(np.int32)), pa.array(spans, kind)],
                names=["doc_id", "held_out", "score", "predicted", "spans"])

    return rows.mapInArrow(run, OUT)


def scored(model: Model | None, texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of a block of texts, their marginals and each text's score."""
    words = Words(texts)
    p, score = np.zeros(len(words.codes)), np.zeros(len(texts))
    if model is not None and len(p):
        first = np.zeros(len(p), bool)
        first[words.ptr[:-1][words.ptr[:-1] < len(p)]] = True
        p = marginals(model.emissions(words), first, model.move)
        some = words.counts() > 0
        score[some] = np.maximum.reduceat(p, words.ptr[:-1][some])
    return words, p, score


def _spans(words: Words, p: np.ndarray, k: int) -> list[dict]:
    a, b = int(words.ptr[k]), int(words.ptr[k + 1])
    on = np.flatnonzero(p[a:b] >= 0.5) + a
    groups = np.split(on, np.flatnonzero(np.diff(on) > 1) + 1)
    raw = words.low[words.offs[k]:words.offs[k + 1]]
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    base = int(words.offs[k])
    return [{"start": int(chars[words.starts[g[0]] - base]), "end": int(chars[words.ends[g[-1]] - base]),
             "score": float(p[g].max())} for g in groups]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tag(docs, train(docs, table(spark, sf_dir, "labels")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject the documents that are toxic."""
    shared = spark.sparkContext.broadcast(train(docs, table(spark, sf_dir, "labels")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches):
            _, _, score = scored(shared.value, batch.column("text"))
            yield batch.filter(pa.array(score < 0.5))

    return docs.mapInArrow(run, docs.schema)
