"""Packing along a space-filling curve.

Every document's tokens give a hashed vector that is projected to a few dimensions; documents
are range-sorted by the Hilbert key of that point, so that neighbours on the curve have similar
wording, and laid end to end. The line is cut every ``width`` tokens. What is left at the very
end is cut into powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from prodseries.llm.common import partitions, written
from prodseries.llm.tokens import encoder, released

DIMENSIONS, BITS = 4, 12
HASH_BITS = 12
END_ID = 1

_PROJECTION = np.random.default_rng(20240919).standard_normal((1 << HASH_BITS, DIMENSIONS)).astype(np.float32)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of integer points, one row each (coordinates below 2^bits).

    From the top bit down, each quadrant is brought to the standard orientation by exchanging
    or inverting the lower bits; a Gray code over the coordinates' bits then gives the position.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for d in range(dims):
            high = (x[d] >> level) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap if d else 0
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip = np.where((x[-1] >> level) & 1 == 1, flip ^ ((1 << level) - 1), flip)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> level) & 1)
    return key


def document_points(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Grid points of documents: ids hashed to rows of a random projection, summed and scaled."""
    row = (ids * np.uint32(2654435761)) >> np.uint32(32 - HASH_BITS)
    sums = np.zeros((len(counts), DIMENSIONS))
    some = np.flatnonzero(counts)
    if len(some):
        sums[some] = np.add.reduceat(_PROJECTION[row], (np.cumsum(counts) - counts)[some], axis=0)
    scaled = sums / np.sqrt(np.maximum(counts, 1))[:, None]
    return np.minimum(((1 << BITS) / (1 + np.exp(-0.5 * scaled))).astype(np.int64), (1 << BITS) - 1)


def packed_ids(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


def tokenized(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, key, n, ids): ids with the end id, as little-endian unsigned numbers of 16 bits
    where the vocabulary allows it, else of 32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(tokenizer)
        kind = "<u2" if len(made.ends_word) <= 1 << 16 else "<u4"
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                ids, counts = made.encode(part.column(1).to_pylist())
                keys = hilbert_keys(document_points(ids, counts))
                ends = np.cumsum(counts)
                rows = [np.append(ids[e - n : e], np.uint32(END_ID)).astype(kind).tobytes() for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(keys), pa.array(counts + 1), pa.array(rows, pa.binary())],
                    names=["doc_id", "key", "n", "ids"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, key long, n long, ids binary")


def tail_cuts(total: int, width: int) -> list[int]:
    """Starts of the sequences after the last full one: powers of two that add up to the rest."""
    at, cuts = total - total % width, []
    while at < total:
        cuts.append(at)
        at += 1 << ((total - at).bit_length() - 1)
    return cuts


def packed(docs: DataFrame, tokenizer: str, width: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of sequences: doc_id, start, length, doc_tokens, sequence_id, offset, ids (binary,
    32-bit little-endian).

    Each token of each input row, with one end id per row, lies in exactly one piece; offsets
    are gapless from 0 within a sequence. Null and empty texts are their end id alone; repeated
    rows and null ids are packed like others; an empty table gives an empty result; other
    columns are not read.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    held = written(tokenized(base, tokenizer).withColumn("row", F.monotonically_increasing_id()), "tokens")

    # The order needs only keys and counts; equal keys go by document, so ties spread as well.
    curve = written(
        held.select("key", "doc_id", "row", "n")
        .repartitionByRange(partitions(spark), "key", "doc_id", "row")
        .withColumn("part", F.spark_partition_id()),
        "curve",
    )
    sums = sorted(tuple(r) for r in curve.groupBy("part").agg(F.sum("n")).collect())
    starts, total = [], 0
    for part, n in sums:
        starts.append((part, total))
        total += n
    offsets = spark.createDataFrame(starts, "part int, part_start long")
    along = Window.partitionBy("part").orderBy("key", "doc_id", "row").rowsBetween(Window.unboundedPreceding, 0)
    places = curve.join(F.broadcast(offsets), "part").select(
        "row", (F.col("part_start") + F.sum("n").over(along) - F.col("n")).alias("place")
    )
    tail = np.array(tail_cuts(total, width), dtype=np.int64)
    full = total // width

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        released()
        for batch in batches:
            out: list[tuple] = []
            for doc, n, raw, place in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "ids", "place")), strict=True):
                ids = np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * n else "<u4")
                inner = np.arange(place - place % width, min(place + n, full * width), width)
                marks = np.unique(np.concatenate((inner, tail, [place, place + n])))
                marks = marks[(marks >= place) & (marks <= place + n)]
                for a, b in zip(marks[:-1].tolist(), marks[1:].tolist(), strict=True):
                    if a < full * width:
                        sequence, offset = divmod(a, width)
                    else:
                        k = int(np.searchsorted(tail, a, side="right")) - 1
                        sequence, offset = full + k, a - int(tail[k])
                    out.append((doc, a - place, b - a, n, sequence, offset, packed_ids(ids[a - place : b - place])))
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in columns[:6]), pa.array(columns[6], pa.binary())],
                    names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )

    return held.select("row", "doc_id", "n", "ids").join(places, "row").select("doc_id", "n", "ids", "place").mapInArrow(
        cut, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    )
