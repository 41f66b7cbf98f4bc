"""Language identification with error-correcting output codes.

Every language has a codeword; for each bit a linear classifier over hashed byte
n-grams (one to three bytes) predicts on which side a text lies. Decoding sums over
the bits the logistic loss of the prediction against each language's codeword,
weighted by how reliable the bit was in training, and takes the language with the
smallest loss. Its share of exp(-loss) over all languages is the score; a text whose
two best languages are close is flagged as ambiguous.

The classifiers are fitted on a bounded sample: of each language at most
``SAMPLE`` different texts, those with the smallest hashes, and one short passage of
each; of more than ``TOTAL / SAMPLE`` languages evenly fewer, but one at least, so that
there may be any number. Of a text over ``SAMPLE_BYTES`` bytes the sample has a passage of at most so many
bytes, at a place given by the text's hash (``excerpt``). All texts are scored whole.

Cases: null text and text without a letter is ``und`` with score 0; without any
labelled text everything is ``und``; with one language every text with a letter is
of it; null ids, repeated rows and very long texts are scored like any other;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _LOWER, crc_mod, excerpt, fitted, fresh, smallest, stored, table, text_blocks, utf8

BINS = 8192
SAMPLE = 400
SAMPLE_BYTES = 32 << 10
#: Training rows whose n-gram vectors are held densely at once.
ROWS = 2048
#: Texts of the sample; more languages than ``TOTAL / SAMPLE`` share them evenly.
TOTAL = 256 * SAMPLE
AMBIGUOUS = 0.2
UNKNOWN = "und"
#: Share of the decoding that the best language has at least where the stage keeps a document.
DECIDED = 0.5
OUT = "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"
#: Texts whose n-grams are counted at once.
TEXTS = 256


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n codewords of -1 and 1: exhaustive for up to seven, else random ones far apart."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 7:
        bits = np.arange(1, 1 << (n - 1))
        rest = (bits[None, :] >> np.arange(n - 1)[:, None]) & 1
        return np.concatenate([np.ones((1, len(bits))), 1 - 2.0 * rest])
    rng = np.random.default_rng(seed)
    best, apart = None, -1
    # all pairs are compared, so very many languages have fewer draws to choose from
    for _ in range(max(1, min(50, 50 * 1024 ** 2 // n ** 2))):
        code = rng.choice([-1.0, 1.0], (n, int(np.ceil(10 * np.log2(n)))))
        code[:, np.abs(code.sum(0)) == n] = np.where(np.arange(n) % 2, 1.0, -1.0)[:, None]
        least = np.inf
        for a in range(0, n, 1024):
            some = (code.shape[1] - code[a:a + 1024] @ code.T) / 2
            some[np.arange(len(some)), a + np.arange(len(some))] = np.inf
            least = min(least, some.min())
        if least > apart:
            best, apart = code, least
    return best


def features(data: np.ndarray, offs: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Square roots of the shares of each text's hashed n-grams: rows of length 1."""
    n = len(offs) - 1
    low = _LOWER[data].astype(np.uint32)
    out = np.zeros((n, bins), np.float32)
    if not len(low):
        return out
    row = np.repeat(np.arange(n, dtype=np.int64) * bins, np.diff(offs))
    ends = np.repeat(offs[1:], np.diff(offs))
    key, total = np.zeros(len(low), np.uint32), np.zeros(n * bins, np.int64)
    shift = np.uint32(32 - int(bins).bit_length() + 1)
    for order in range(3):
        size = len(low) - order
        if size <= 0:
            break
        key = key[:size] * np.uint32(257) + low[order:] + np.uint32(1)
        inside = np.arange(size) + order < ends[:size]
        hashed = (key * np.uint32(2654435761)) >> shift
        total += np.bincount((row[:size] + hashed)[inside], minlength=n * bins)
    out[:] = np.sqrt(total.reshape(n, bins))
    norm = np.sqrt((out * out).sum(1, keepdims=True))
    return out / np.maximum(norm, 1e-9)


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray
    weights: np.ndarray  # bins x bits
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its score and whether the second is close."""
        if len(self.langs) == 1:
            return np.zeros(len(x), np.int64), np.ones(len(x)), np.zeros(len(x), bool)
        margin = x @ self.weights + self.bias
        # log(1 + exp(-c m)) is a part without c, the same for all languages, less c m / 2
        gain = (margin * self.trust) @ self.code.T / 2
        share = np.exp(gain - gain.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        top = np.partition(share, -2, 1)[:, -2:]
        return share.argmax(1), top[:, 1], top[:, 1] - top[:, 0] < AMBIGUOUS


class Sparse:
    """Rows of a matrix as places and values; ``blocks`` gives them densely, some at a time."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], columns: int) -> None:
        self.rows, self.shape = rows, (len(rows), columns)
        self.one = self._dense(0) if len(rows) <= ROWS else None

    def _dense(self, at: int) -> np.ndarray:
        some = self.rows[at:at + ROWS]
        out = np.zeros((len(some), self.shape[1]), np.float32)
        for k, (places, values) in enumerate(some):
            out[k, places] = values
        return out

    def blocks(self) -> Iterator[tuple[slice, np.ndarray]]:
        for at in range(0, len(self.rows), ROWS):
            yield slice(at, at + ROWS), self._dense(at) if self.one is None else self.one


def fit(x: np.ndarray | Sparse, y: np.ndarray, langs: list[str], steps: int = 120, rate: float = 40.0,
        decay: float = 1e-4) -> Model:
    """Logistic regression for each bit, by accelerated gradient descent."""
    code = codewords(len(langs))
    counts = np.bincount(y, minlength=len(langs))
    w = np.zeros((x.shape[1], code.shape[1]), np.float32)
    b = np.zeros(code.shape[1])
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    blocks = x.blocks if isinstance(x, Sparse) else lambda: [(slice(None), x)]
    for _ in range(steps if code.shape[1] else 0):
        ahead, ahead_b, gw, gb = w + 0.9 * vw, b + 0.9 * vb, np.zeros_like(w), np.zeros_like(b)
        for rows, part in blocks():
            target, weight = code[y[rows]], (1 / counts[y[rows]])[:, None] / len(langs)
            margin = part @ ahead + ahead_b
            pull = (weight * target / (1 + np.exp(np.clip(target * margin, -30, 30)))).astype(np.float32)
            gw, gb = gw + part.T @ pull, gb + pull.sum(0)
        vw = 0.9 * vw + rate * (gw - decay * w)
        vb = 0.9 * vb + rate * 0.1 * gb
        w, b = w + vw, b + vb
    right = sum((((part @ w + b) * code[y[rows]] > 0).sum(0) for rows, part in blocks()), np.zeros(len(b))) / len(y)
    trust = np.log((right + 0.01) / (1 - right + 0.01))
    return Model(langs, code, w, b, np.maximum(trust, 0.1) / max(np.maximum(trust, 0.1).max(initial=0.1), 0.1))


def sample(docs: DataFrame, per_language: int = SAMPLE) -> DataFrame:
    """Training texts and languages of the documents outside the held-out fold."""
    rows = docs.select("doc_id", "text", "lang").filter(
        (crc_mod("doc_id", 4) != 2) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    keyed = rows.select("doc_id", "lang", F.xxhash64("text").alias("h"))
    kinds = keyed.groupBy("lang", "h").agg(F.min("doc_id").alias("doc_id"))
    languages = rows.select("lang").distinct().count()
    share = max(1, min(per_language, TOTAL // max(1, languages)))
    # stored, so that its size is known: broadcast only if it is small
    chosen = stored(smallest(kinds, share, "h", ["lang"]), "language-sample")
    return rows.withColumn("h", F.xxhash64("text")).join(chosen, ["doc_id", "lang", "h"], "left_semi") \
        .withColumn("text", excerpt(F.col("text"), F.col("h"), SAMPLE_BYTES))


def train(docs: DataFrame, per_language: int = SAMPLE) -> Model | None:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column("lang"), batch.column("text")
            for k in range(batch.num_rows):
                data, offs = utf8(texts.slice(k, 1))
                # the text and a short passage from its middle
                mid = len(data) // 2
                for a, b in ((0, len(data)), (max(0, mid - 40), mid + 40)):
                    x = features(data[a:b], np.array([0, len(data[a:b])]))[0]
                    at = np.flatnonzero(x)
                    yield pa.RecordBatch.from_arrays([
                        langs.slice(k, 1), pa.array([at.astype("<u2").tobytes()]), pa.array([x[at].tobytes()])],
                        names=["lang", "at", "x"])

    def learn(found: pa.Table) -> Model:
        rows = sorted(zip(found.column("lang").to_pylist(), found.column("at").to_pylist(), found.column("x").to_pylist(), strict=True),
                      key=lambda r: (r[0], r[2], r[1]))
        langs = sorted({r[0] for r in rows})
        number = {lang: k for k, lang in enumerate(langs)}
        x = Sparse([(np.frombuffer(at, "<u2"), np.frombuffer(values, np.float32)) for _, at, values in rows], BINS)
        return fit(x, np.array([number[r[0]] for r in rows]), langs)

    counted = sample(docs, per_language).select("lang", "text").mapInArrow(count, "lang string, at binary, x binary")
    return fitted(counted, learn)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Predicted language of every row."""
    rows = docs.select(F.col("doc_id").cast("long"), (crc_mod("doc_id", 4) == 2).alias("held_out"), "text",
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("spoken"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, max_bytes=1 << 20):
            names, score, close = predicted(shared.value, batch.column("text"), batch.column("spoken"))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()),
                pa.array(score), pa.array(close)], names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    return rows.mapInArrow(run, OUT)


def predicted(model: Model | None, texts: pa.Array, spoken: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, score and ambiguity of each text; ``spoken``: whether it has a letter."""
    n = len(texts)
    spoken = spoken.to_numpy(zero_copy_only=False)
    names, score, close = np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n, bool)
    # the shares of many languages are held for fewer texts
    step = max(1, min(TEXTS, (4 << 20) // max(1, len(model.langs)))) if model is not None else TEXTS
    for at in range(0, n if model is not None else 0, step):
        some = np.flatnonzero(spoken[at:at + step]) + at
        if len(some):
            best, share, near = model.decode(features(*utf8(texts.take(pa.array(some)))))
            names[some], score[some], close[some] = np.array(model.langs, object)[best], share, near
    return names, score, close


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))


def decided(names: np.ndarray, score: np.ndarray, close: np.ndarray, spoken: np.ndarray, languages: frozenset[str] | None = None) -> np.ndarray:
    """Whether a text is clearly in one language (of ``languages``, if given): a letter, at least half of the decoded
    share for the best language, and no second one close to it."""
    clear = spoken & ~close & (score >= DECIDED)
    return clear if languages is None else clear & np.isin(names.astype(str), sorted(languages))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str, languages: frozenset[str] | None = None) -> DataFrame:
    """Reject the documents that aren't clearly in one of ``languages`` (any learned one if None): null texts, texts without a
    letter, and those whose decoding is ambiguous or undecided. Without a model, texts with a letter are kept."""
    shared = spark.sparkContext.broadcast(train(docs))
    letter = fresh(docs, "has_letter")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, max_bytes=1 << 20):
            spoken = batch.column(letter)
            kept = spoken
            if shared.value is not None:
                names, score, close = predicted(shared.value, batch.column("text"), spoken)
                kept = pa.array(decided(names, score, close, spoken.to_numpy(zero_copy_only=False), languages))
            yield batch.drop_columns([letter]).filter(kept)

    spoken = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.withColumn(letter, spoken).mapInArrow(run, docs.schema)
