"""Fixed-width bit packing of token ids.

A block holds whole documents: a header, the document offsets, and the ids one after the other, each in
the fewest bits that hold every id of the vocabulary::

    magic    4 bytes  TKB1
    width    u16      bits of an id
    n_docs   u32
    n_ids    u64
    offsets  (n_docs + 1) u64: where each document's ids begin, in ids; the last is n_ids
    payload  n_ids * width bits, little-endian within and across bytes, zero-padded to a byte

An id's place is ``offset * width`` bits, so one document is read without its neighbours. Blocks are
rows of a Parquet table, with shard, place in the shard and first id's place as columns.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import pieces, ship_code, written
from tidemark.llm.tokens import encoder

MAGIC = b"TKB1"
HEAD = struct.Struct("<4sHIQ")
BLOCK_BYTES = 1 << 21  # of text, but whole documents
BLOCKS = "shard int, block int, start long, n_ids long, doc_ids array<long>, data binary"


def width_of(vocabulary: int) -> int:
    """Bits of the largest id."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    if len(ids) and int(ids.max()) >> width:
        raise ValueError("an id needs more bits than the vocabulary's width")
    if width == 16:
        return ids.astype("<u2").tobytes()
    if width == 32:
        return ids.astype("<u4").tobytes()
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little")
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def unpack_bits(payload: bytes, width: int, first: int, last: int) -> np.ndarray:
    """Ids ``first`` to ``last`` (exclusive) of a payload."""
    if first == last:
        return np.zeros(0, dtype=np.uint32)
    low, high = first * width // 8, -(-last * width // 8)
    held = np.frombuffer(payload, dtype=np.uint8, offset=low, count=high - low)
    if width == 16:
        return held.view("<u2").astype(np.uint32)
    if width == 32:
        return held.view("<u4").astype(np.uint32)
    bits = np.unpackbits(held, bitorder="little")[first * width - low * 8:][:(last - first) * width]
    wide = np.zeros((last - first, 32), dtype=np.uint8)
    wide[:, :width] = bits.reshape(-1, width)
    return np.packbits(wide, axis=1, bitorder="little").reshape(-1).view("<u4").astype(np.uint32)


def pack_block(ids: np.ndarray, lengths: np.ndarray, width: int) -> bytes:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
    return HEAD.pack(MAGIC, width, len(lengths), len(ids)) + offsets.tobytes() + pack_bits(ids, width)


def read_block(data: bytes, which: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, lengths)`` of a block, or of its document number ``which`` alone."""
    magic, width, n_docs, n_ids = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a packed block")
    offsets = np.frombuffer(data, "<u8", n_docs + 1, HEAD.size).astype(np.int64)
    payload = memoryview(data)[HEAD.size + 8 * (n_docs + 1):]
    if which is None:
        return unpack_bits(payload, width, 0, n_ids), np.diff(offsets)
    first, last = int(offsets[which]), int(offsets[which + 1])
    return unpack_bits(payload, width, first, last), np.array([last - first])


def _append(ids: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Every document's ids with the end id after them."""
    out = np.full(len(ids) + len(lengths), end, dtype=np.uint32)
    keep = np.ones(len(out), dtype=bool)
    keep[np.cumsum(lengths + 1) - 1] = False
    out[keep] = ids
    return out, lengths + 1


def _encode(path: str, width: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, shard = encoder(path), TaskContext.get().partitionId()
        start, block = 0, 0

        def packed(docs: list, texts: list[bytes]) -> pa.RecordBatch:
            nonlocal start, block
            ids, lengths = _append(*of.encode(texts), end)
            row = {"shard": shard, "block": block, "start": start, "n_ids": len(ids), "doc_ids": docs,
                   "data": pack_block(ids, lengths, width)}
            start, block = start + len(ids), block + 1
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("shard", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
                ("doc_ids", pa.list_(pa.int64())), ("data", pa.binary())]))

        for batch in batches:
            docs = batch.column(0).to_pylist()
            for first, texts in pieces(batch.column(1), BLOCK_BYTES):
                yield packed(docs[first:first + len(texts)], texts)
    return run


def write_blocks(docs: DataFrame, path: str, end: int, vocabulary: int, doc: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """The texts as packed blocks in a Parquet table of the shared folder, in ascending order of id.

    Only the texts are shuffled, by ranges of (id, text digest), so that one id with very many rows is
    spread over shards too. A null id comes first, a null text is an empty one, rows of the same id
    follow each other by digest. ``start`` counts the ids before a block within its shard.
    """
    ship_code(docs.sparkSession)
    rows = docs.select(F.col(doc).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       F.xxhash64(text).alias("digest"))
    ordered = (rows.repartitionByRange("doc", "digest").sortWithinPartitions("doc", "digest")
               .select("doc", "text"))
    return written(ordered.mapInArrow(_encode(path, width_of(vocabulary), end), BLOCKS), "packed")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids, lengths = read_block(row["data"])
            raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(lengths) * 4
            begin = ends - lengths * 4
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(row["doc_ids"], pa.int64()), "shard": pa.array([row["shard"]] * len(lengths), pa.int32()),
                "start": pa.array(row["start"] + begin // 4, pa.int64()), "n_tokens": pa.array(lengths, pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(raw[a:b]) for a, b in zip(begin, ends)], pa.int64())})


def read_documents(blocks: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, read back from packed blocks.

    The shards' totals, one row each, give the ids before a shard; blocks know the rest.
    """
    ship_code(blocks.sparkSession)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = totals.select("shard", (F.sum("n_ids").over(Window.orderBy("shard")) - F.col("n_ids")).alias("before"))
    docs = blocks.mapInArrow(_digests, "doc_id long, shard int, start long, n_tokens long, ids_crc32 long")
    return docs.join(before, "shard").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(blocks: DataFrame) -> DataFrame:
    """``(doc_id, ids)``: the unpacked ids themselves."""
    ship_code(blocks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, lengths = read_block(row["data"])
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.ListArray.from_arrays(offsets, ids.astype(np.int64))],
                    names=["doc_id", "ids"])
    return blocks.mapInArrow(run, "doc_id long, ids array<long>")
