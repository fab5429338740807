"""Token files of patched frame-of-reference blocks.

A segment holds whole documents in ascending id order. Its ids are cut into blocks; each block
stores its minimum, and the rest above it packed at the width that a percentile of them needs;
larger ones keep their place and their high bits in the block's exception list. The start of
every block is indexed, so that any of them can be read alone.

Segment layout (little-endian): magic, ids, documents, block size (4 x u32); document lengths
(u32 each); block starts (u32 each, and the end); blocks. Block: minimum u32, count u16,
width u8, exceptions u16; packed bits; exception places u16 each; exception high parts u32 each.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodseries.llm.common import partitions, shared_folder
from prodseries.llm.tokens import encoder

MAGIC = 0x31524F46
BLOCK = 1024
PERCENTILE = 90
# Ids after which a segment is closed (at a document's end).
SEGMENT = 1 << 18
END_ID = 1
_HEAD = struct.Struct("<IIII")
_BLOCK = struct.Struct("<IHBH")


def packed_block(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    low = int(ids.min())
    above = (ids - np.uint32(low)).astype(np.uint32)
    rank = max(0, -(-len(ids) * percentile // 100) - 1)
    width = int(np.partition(above, rank)[rank]).bit_length()
    bits = (above[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    places = np.flatnonzero(above >> np.uint32(min(width, 31)) if width < 32 else above * 0)
    high = (above[places].astype(np.uint64) >> np.uint64(width)).astype("<u4")
    return b"".join(
        (
            _BLOCK.pack(low, len(ids), width, len(places)),
            np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes(),
            places.astype("<u2").tobytes(),
            high.tobytes(),
        )
    )


def unpacked_block(data: bytes, at: int) -> np.ndarray:
    low, count, width, patches = _BLOCK.unpack_from(data, at)
    at += _BLOCK.size
    n_bytes = (count * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(data, np.uint8, n_bytes, at), count=count * width, bitorder="little")
    above = bits.reshape(count, width).astype(np.uint64) @ (np.uint64(1) << np.arange(width, dtype=np.uint64))
    at += n_bytes
    places = np.frombuffer(data, "<u2", patches, at)
    high = np.frombuffer(data, "<u4", patches, at + 2 * patches)
    above[places] += high.astype(np.uint64) << np.uint64(width)
    return (above + np.uint64(low)).astype(np.uint32)


def written_segment(ids: np.ndarray, lengths: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> bytes:
    blocks = [packed_block(ids[i : i + block], percentile) for i in range(0, len(ids), block)]
    head = _HEAD.size + 4 * len(lengths) + 4 * (len(blocks) + 1)
    starts = head + np.concatenate(([0], np.cumsum([len(b) for b in blocks], dtype=np.int64)))
    return b"".join(
        (
            _HEAD.pack(MAGIC, len(ids), len(lengths), block),
            lengths.astype("<u4").tobytes(),
            starts.astype("<u4").tobytes(),
            *blocks,
        )
    )


def read_segment(data: bytes, first: int = 0, count: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids ``first`` to ``first + count`` (all by default), by the block index, and the lengths
    of the segment's documents."""
    magic, n, n_docs, block = _HEAD.unpack_from(data, 0)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    lengths = np.frombuffer(data, "<u4", n_docs, _HEAD.size)
    n_blocks = -(-n // block)
    starts = np.frombuffer(data, "<u4", n_blocks + 1, _HEAD.size + 4 * n_docs)
    last = n if count is None else min(n, first + count)
    wanted = range(first // block, -(-last // block)) if last > first else range(0)
    ids = np.concatenate([np.zeros(0, np.uint32), *(unpacked_block(data, int(starts[k])) for k in wanted)])
    skip = first - wanted.start * block if len(wanted) else 0
    return ids[skip : skip + last - first], lengths


def write_token_files(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                      percentile: int = PERCENTILE) -> None:
    """Write all documents, in ascending id order over the numbered parts of a table of
    segments: part, segment, before (ids of the part's earlier segments), n_ids, doc_ids, data.

    Null texts have the end id alone; null ids come first; rows that repeat an id follow each
    other in the order of their text's hash; an empty table gives a table without segments;
    other columns are not read. A segment is a value of a Spark table, so writing commits as
    one and survives lost executors on any file system.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = ["doc_id", "h"]
    dealt = (
        base.withColumn("h", F.xxhash64("text"))
        .repartitionByRange(partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .select("part", "doc_id", "text")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(tokenizer)
        part, segment, before = 0, 0, 0
        held: list[np.ndarray] = []
        names: list[int | None] = []
        size = 0

        def closed() -> pa.RecordBatch:
            ids = np.concatenate(held)
            data = written_segment(ids, np.array([len(x) for x in held]), percentile=percentile)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([segment], pa.int64()), pa.array([before], pa.int64()),
                    pa.array([len(ids)], pa.int64()), pa.array([list(names)], pa.list_(pa.int64())), pa.array([data], pa.binary()),
                ],
                names=["part", "segment", "before", "n_ids", "doc_ids", "data"],
            )

        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                some = batch.slice(a, 256)
                part = some.column(0)[0].as_py()
                ids, counts = made.encode(some.column(2).to_pylist())
                ends = np.cumsum(counts)
                for doc, n, e in zip(some.column(1).to_pylist(), counts.tolist(), ends.tolist(), strict=True):
                    held.append(np.append(ids[e - n : e], np.uint32(END_ID)))
                    names.append(doc)
                    size += n + 1
                    if size >= SEGMENT:
                        yield closed()
                        segment, before, size = segment + 1, before + size, 0
                        held.clear()
                        names.clear()
        if held:
            yield closed()

    schema = "part int, segment long, before long, n_ids long, doc_ids array<long>, data binary"
    dealt.mapInArrow(encode, schema).write.option("compression", "uncompressed").parquet(path)


def read_token_files(spark, path: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32, ids (binary, 32-bit little-endian)."""
    segments = spark.read.parquet(path)
    # One row per part, of which there are as many as the configured shuffle width.
    sizes = sorted(tuple(r) for r in segments.groupBy("part").agg(F.sum("n_ids")).collect())
    starts, at = [], 0
    for part, n in sizes:
        starts.append((part, at))
        at += n
    offsets = spark.createDataFrame(starts, "part int, part_start long")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, names, data in zip(*(batch.column(c).to_pylist() for c in ("first", "doc_ids", "data")), strict=True):
                ids, lengths = read_segment(data)
                ends = np.cumsum(lengths, dtype=np.int64)
                rows = [ids[e - n : e].astype("<u4").tobytes() for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64()), pa.array(first + ends - lengths), pa.array(lengths.astype(np.int64)),
                        pa.array([zlib.crc32(r) for r in rows], pa.int64()), pa.array(rows, pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    placed = segments.join(F.broadcast(offsets), "part").select(
        (F.col("part_start") + F.col("before")).alias("first"), "doc_ids", "data"
    )
    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def token_folder(spark) -> str:
    """A new folder for token files beside the session's other shared tables."""
    import uuid

    return f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
