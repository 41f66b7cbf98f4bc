"""Token ids in fixed-width bit packing, written and read back as segments.

Every id takes the fewest bits that the vocabulary needs. A segment is a
self-contained piece of a token file: a header, the offset of each block of
``BLOCK_IDS`` ids, and the blocks, each of whole bytes. One block, or any id, is read
without the others, and a block is unpacked with numpy operations. Segments lie in
the shared folder as rows of a Parquet table (file, segment, documents, bytes), so
Spark's own commit decides which attempt of a task counts; the segments of a file
in order are its bytes. Files are in ascending doc_id order.

Cases: null text is empty and has only the end id; rows of the same doc_id follow
each other by a hash of the text; a null doc_id comes first; a document longer than
a segment has a segment of its own; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, table, text_blocks
from .tokens import ended, tokenizer

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
BLOCK_IDS = 4096
#: Text of a segment; its ids take about as many bytes.
SEGMENT_BYTES = 2 << 20
HEAD = struct.Struct("<4sBxxxIIQ")  # magic, bits, ids in a block, blocks, ids
MAGIC = b"SLT1"

SEGMENTS = ("file int, segment int, first long, n_ids long, doc_ids array<long>, doc_ptr binary, data binary")
DOCS = "file int, doc_id long, at long, n_tokens long, ids_crc32 long"


def width(vocabulary: int) -> int:
    """The fewest bits that hold the ids 0 to vocabulary - 1."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    """A segment of the file format."""
    blocks = -(-len(ids) // block_ids)
    out, sizes = [], []
    for b in range(blocks):
        out.append(_packed(ids[b * block_ids:(b + 1) * block_ids], bits))
        sizes.append(len(out[-1]))
    begin = HEAD.size + 8 * blocks
    offsets = begin + np.concatenate([[0], np.cumsum(sizes)[:-1]]) if blocks else np.zeros(0)
    return HEAD.pack(MAGIC, bits, block_ids, blocks, len(ids)) + offsets.astype("<u8").tobytes() + b"".join(out)


def _packed(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    rows = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(rows.reshape(-1), bitorder="little").tobytes()


def _unpacked(data: np.ndarray, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return data[:n * bits // 8].view(f"<u{bits // 8}").astype(np.uint32)
    rows = np.zeros((n, 32), np.uint8)
    rows[:, :bits] = np.unpackbits(data, count=n * bits, bitorder="little").reshape(n, bits)
    return np.packbits(rows, axis=1, bitorder="little").reshape(-1).view("<u4")


class Segment:
    """A segment's ids, by block or by range."""

    def __init__(self, data: bytes | memoryview | pa.Buffer) -> None:
        self.data = np.frombuffer(data, np.uint8)
        magic, self.bits, self.block_ids, blocks, self.n = HEAD.unpack(self.data[:HEAD.size].tobytes())
        if magic != MAGIC:
            raise ValueError("not a token segment")
        self.offsets = self.data[HEAD.size:HEAD.size + 8 * blocks].view("<u8").astype(np.int64)

    def block(self, k: int) -> np.ndarray:
        n = min(self.block_ids, self.n - k * self.block_ids)
        at = self.offsets[k]
        return _unpacked(self.data[at:at + (n * self.bits + 7) // 8], self.bits, n)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop - 1; reads only the blocks that hold them."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        got = np.concatenate([self.block(k) for k in range(first, last + 1)])
        return got[start - first * self.block_ids:stop - first * self.block_ids]


def in_order(docs: DataFrame) -> DataFrame:
    """doc_id and text in ascending order over the partitions; the row number only parts equal rows."""
    keys = ["doc_id", "_h", "_row"]
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("_h"),
                       F.monotonically_increasing_id().alias("_row"))
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")


def write_token_files(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Encode and store; ``path`` is the tokenizer's file on every machine. Returns the segments as read back."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, file = tokenizer(path, False), TaskContext.get().partitionId()
        bits, first = width(tok.size), 0
        for seq, batch in enumerate(text_blocks(batches, max_bytes=SEGMENT_BYTES)):
            ids, ptr = ended(*tok.encode(batch.column("text")), end_id)
            yield pa.RecordBatch.from_arrays([
                pa.array([file], pa.int32()), pa.array([seq], pa.int32()),
                pa.array([first], pa.int64()), pa.array([len(ids)], pa.int64()),
                pa.ListArray.from_arrays([0, batch.num_rows], batch.column("doc_id")),
                pa.array([ptr.astype("<i8").tobytes()], pa.binary()),
                pa.array([pack(ids, bits)], pa.binary()),
            ], names=["file", "segment", "first", "n_ids", "doc_ids", "doc_ptr", "data"])
            first += len(ids)

    return stored(in_order(docs).mapInArrow(encode, SEGMENTS), "tokens")


def read_token_files(segments: DataFrame) -> DataFrame:
    """One row per document from the stored segments."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                seg = Segment(batch.column("data")[r].as_buffer())
                ptr = np.frombuffer(batch.column("doc_ptr")[r].as_buffer(), "<i8")
                raw = memoryview(seg.ids(0, seg.n).astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True)]
                n = len(crc)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, batch.column("file")[r].as_py(), np.int32)),
                    batch.slice(r, 1).column("doc_ids").flatten(),
                    pa.array(ptr[:-1] + batch.column("first")[r].as_py()),
                    pa.array(np.diff(ptr)), pa.array(crc, pa.int64()),
                ], names=["file", "doc_id", "at", "n_tokens", "ids_crc32"])

    docs = segments.select("file", "first", "doc_ids", "doc_ptr", "data").mapInArrow(decode, DOCS)
    sizes = segments.groupBy("file").agg(F.sum("n_ids").alias("n"))
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each file, and a file for each partition of the write: small at any input
    base = sizes.select("file", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    return docs.join(F.broadcast(base), "file").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), path))
