"""Token-id output in bit planes.

Documents are put in ascending id order by a range partitioning, encoded, and cut into shards. A shard is a run of whole
documents of about SHARD_IDS ids, kept as one binary value of a Parquet table that Spark writes and commits, so that
files are complete or absent on any file system and a lost executor's part is written again.

Layout of a shard, all numbers little-endian:

    "BPL1" | plane bits (1 or 8) | bytes per id (2 or 4) | 2 zero bytes | block size u32 | documents u32 | ids u64
    document ids i64 each | flags u8 each (1: id is NULL) | ids per document u32 each      (one zstandard frame, size u32 before it)
    chunk index: for each block and plane the end of its frame, u32, counted from the first frame
    frames: for each block of ids its planes, each compressed with zstandard

A block's ids are transposed: plane b holds bit b (or byte b) of all its ids. The index gives any block without
reading others.

Defined cases. NULL text is empty and gives the end id alone. NULL ids come first, equal ids in the order of a hash of
their text; rows equal in both may come in any order. An empty table gives an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from leaguelake.llm.common import batches_of, mapped, starts_of
from leaguelake.llm.tokens import Encoder, tokenizer_json
from leaguelake.session import scratch_path

MAGIC = b"BPL1"
HEAD = "<4sBBxxIIQ"
BLOCK = 1 << 16
SHARD_IDS = 1 << 18
END_ID = 1
LEVEL = 3


def _planes(ids: np.ndarray, bits: int) -> np.ndarray:
    """Planes of a block, one to a row."""
    octets = ids.view(np.uint8).reshape(len(ids), ids.itemsize)
    if bits == 8:
        return np.ascontiguousarray(octets.T)
    return np.packbits(np.ascontiguousarray(np.unpackbits(octets, axis=1, bitorder="little").T), axis=1, bitorder="little")


def _ids(planes: list[bytes], n: int, dtype: np.dtype, bits: int) -> np.ndarray:
    rows = np.stack([np.frombuffer(p, np.uint8) for p in planes])
    if bits == 1:
        rows = np.packbits(np.unpackbits(rows, axis=1, count=n, bitorder="little"), axis=0, bitorder="little")
    return np.ascontiguousarray(rows.T).view(dtype).ravel()


def write_shard(doc_ids: list[int | None], ids: list[bytes], dtype: np.dtype, bits: int = 1, block: int = BLOCK) -> bytes:
    """Binary shard of documents given as id bytes."""
    pack = zstandard.ZstdCompressor(level=LEVEL).compress
    flat = np.frombuffer(b"".join(ids), dtype)
    lengths = np.array([len(x) // dtype.itemsize for x in ids], "<u4")
    table = pack(
        np.array([x or 0 for x in doc_ids], "<i8").tobytes() + np.array([x is None for x in doc_ids], np.uint8).tobytes() + lengths.tobytes()
    )
    frames = [pack(plane.tobytes()) for at in range(0, len(flat), block) for plane in _planes(flat[at : at + block], bits)]
    index = np.cumsum([len(f) for f in frames], dtype="<u4") if frames else np.zeros(0, "<u4")
    head = struct.pack(HEAD, MAGIC, bits, dtype.itemsize, block, len(doc_ids), len(flat))
    return b"".join([head, struct.pack("<I", len(table)), table, index.astype("<u4").tobytes(), *frames])


class Shard:
    """Reader of one shard."""

    def __init__(self, content: bytes) -> None:
        magic, self.bits, size, self.block, n_docs, self.n_ids = struct.unpack_from(HEAD, content)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        self.content, self.dtype = memoryview(content), np.dtype(f"<u{size}")
        (n_table,) = struct.unpack_from("<I", content, struct.calcsize(HEAD))
        at = struct.calcsize(HEAD) + 4
        table = zstandard.ZstdDecompressor().decompress(self.content[at : at + n_table])
        self.doc_ids = np.frombuffer(table, "<i8", n_docs)
        self.is_null = np.frombuffer(table, np.uint8, n_docs, 8 * n_docs).astype(bool)
        self.lengths = np.frombuffer(table, "<u4", n_docs, 9 * n_docs)
        self.planes = size * 8 // self.bits
        blocks = -(-self.n_ids // self.block)
        self.ends = np.frombuffer(content, "<u4", blocks * self.planes, at + n_table)
        self.frames = at + n_table + 4 * len(self.ends)

    def _block(self, i: int) -> np.ndarray:
        unpack = zstandard.ZstdDecompressor().decompress
        n = min(self.block, self.n_ids - i * self.block)
        ends = [0 if k < 0 else int(self.ends[k]) for k in range(i * self.planes - 1, (i + 1) * self.planes)]
        planes = [unpack(self.content[self.frames + a : self.frames + b]) for a, b in zip(ends, ends[1:])]
        return _ids(planes, n, self.dtype, self.bits)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop``; only their blocks are unpacked."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, self.dtype)
        first = start // self.block
        parts = [self._block(i) for i in range(first, -(-stop // self.block))]
        return np.concatenate(parts)[start - first * self.block : stop - first * self.block]


SHARD_COLUMNS = "part int, seq int, n_docs bigint, n_ids bigint, shard binary"


def _encode_rows(sent, end_id: int, bits: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        encoder = Encoder.here(sent.value)
        end = np.array([end_id], encoder.dtype).tobytes()
        doc_ids: list[int | None] = []
        held_ids: list[bytes] = []
        size = 0

        def flushed() -> pa.RecordBatch:
            n = sum(map(len, held_ids)) // encoder.dtype.itemsize
            shard = write_shard(doc_ids, held_ids, encoder.dtype, bits)
            return pa.record_batch(
                {
                    "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_docs": pa.array([len(doc_ids)], pa.int64()),
                    "n_ids": pa.array([n], pa.int64()), "shard": pa.array([shard], pa.binary()),
                }
            )

        for _, (own, texts) in batches_of(rows, "doc_id", "text"):
            for doc_id, ids in zip(own, encoder.encode([t or "" for t in texts])):
                doc_ids.append(doc_id)
                held_ids.append(ids + end)
                size += len(ids) + len(end)
                if size >= SHARD_IDS * encoder.dtype.itemsize:
                    yield flushed()
                    doc_ids, held_ids, size, seq = [], [], 0, seq + 1
        if doc_ids:
            yield flushed()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, bits: int = 1) -> None:
    """Encode all documents and write their ids to ``path``; ``tokenizer`` is a tokenizer file."""
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer_json(tokenizer))
    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
    )
    mapped(ordered.select("doc_id", "text"), _encode_rows(sent, end_id, bits), SHARD_COLUMNS).write.parquet(path)


def _decode_rows(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for start, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            shard = Shard(content.as_py())
            ids = shard.ids().astype("<u4")
            cuts = starts_of(shard.lengths)
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]
            yield pa.record_batch(
                {
                    "doc_id": pa.array(shard.doc_ids, pa.int64(), mask=shard.is_null), "start": pa.array(cuts[:-1] + start, pa.int64()),
                    "n_tokens": pa.array(shard.lengths.astype(np.int64)), "ids_crc32": pa.array(crc, pa.int64()),
                }
            )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the written shards.

    Starts come from the sums of whole partitions, one row each, and the sums of the shards within a partition.
    """
    shards = spark.read.parquet(path)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    earlier = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("part", "seq", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("within")).join(offsets, "part")
    placed = shards.select("part", "seq", "shard").join(
        starts.select("part", "seq", (F.col("within") + F.col("offset")).cast("bigint").alias("start")), ["part", "seq"]
    )
    return mapped(placed.select("start", "shard"), _decode_rows, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_output(docs: DataFrame, tokenizer: str | None = None, bits: int = 1) -> DataFrame:
    """Write the ids of all documents to a new place in the shared folder and read them back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer, bits=bits)
    return read_tokens(spark, path)
