"""Removal of repeated runs of lines.

Boundaries that a rolling hash over line hashes chooses by content lose repeats: a run whose lines
they cut apart has no whole chunk in it. With chunks of two lines on average, 61% of the lines of
shared passages of eight lines stayed, and 27% of those of 200. So a boundary is taken at every
line: the hash of two neighbouring lines, rolled on by one, is a chunk, and chunks overlap. Chunks whose
hashes repeat anywhere in the corpus are compared byte by byte with their first occurrence
(smallest document, then place), and the lines of equal ones are removed. A run of lines that an
earlier place has is a run of such chunks, so it goes whole, however short it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodseries.llm.common import BROADCAST_BYTES, written
from prodseries.llm.hashing import OTHER_BASE, spans_hash


def chunk_lines(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the lines of a text (and the end, as if a line break followed), the first and
    last line of each chunk (n x 2, ascending), and two hashes per chunk (n x 2).

    Two empty lines have nothing to compare: the second (first) is a chunk with all lines back
    (on) to the nearest one that has a character.
    """
    buf = np.frombuffer(data + b"\n", dtype=np.uint8)
    ends = np.flatnonzero(buf == 10)
    at = np.concatenate(([0], ends + 1))
    some = np.diff(at) > 1
    line = np.arange(len(some))
    pair = some[:-1] | some[1:]
    first = line[:-1][pair]
    chunks = np.stack([first, first + 1], axis=1)
    if not pair.all():
        empty = line[:-1][~pair]
        before = np.maximum.accumulate(np.where(some, line, -1))[empty]
        after = np.minimum.accumulate(np.where(some, line, len(line))[::-1])[::-1][empty]
        back = np.stack([before, empty + 1], axis=1)[before >= 0]
        on = np.stack([empty, after], axis=1)[after < len(line)]
        chunks = np.concatenate([chunks, back, on])
        chunks = chunks[np.lexsort((chunks[:, 1], chunks[:, 0]))]
    a, b = at[chunks[:, 0]], at[chunks[:, 1] + 1] - 1
    return at, chunks, np.stack([spans_hash(buf, a, b), spans_hash(buf, a, b, OTHER_BASE)], axis=1).view(np.int64)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _content(data: bytes, at: np.ndarray, first: int, last: int) -> bytes:
    """The bytes of a chunk; of more than two lines all but one are empty, and are only counted."""
    if last - first == 1:
        return data[at[first] : at[last + 1] - 1]
    one, side = (first, b">") if at[first + 1] - at[first] > 1 else (last, b"<")
    return b"%d%s\n" % (last - first, side) + data[at[one] : at[one + 1] - 1] + b"\n\n"


def multi_line_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, row, chunk, h1, h2) of every chunk."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                rows, numbers, hashes = [], [], []
                for i, text in enumerate(part.column(2).to_pylist()):
                    data = _bytes(text)
                    h = chunk_lines(data)[2]
                    rows.append(np.full(len(h), i))
                    numbers.append(np.arange(len(h)))
                    hashes.append(h)
                take, h = pa.array(np.concatenate(rows)), np.concatenate(hashes)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array(np.concatenate(numbers).astype(np.int32)), pa.array(h[:, 0]), pa.array(h[:, 1])],
                    names=["doc_id", "row", "chunk", "h1", "h2"],
                )

    return docs.select("doc_id", "row", "text").mapInArrow(cut, "doc_id long, row long, chunk int, h1 long, h2 long")


def chunk_bytes(docs: DataFrame) -> DataFrame:
    """(doc_id, row, chunk, data) of the chunks named in the column ``chunks``."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                rows, numbers, out = [], [], []
                for i, (text, chunks) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)):
                    data = _bytes(text)
                    at, spans, _ = chunk_lines(data)
                    for c in chunks:
                        rows.append(i)
                        numbers.append(c)
                        out.append(_content(data, at, *spans[c].tolist()))
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array(numbers, pa.int32()), pa.array(out, pa.binary())],
                    names=["doc_id", "row", "chunk", "data"],
                )

    return docs.select("doc_id", "row", "text", "chunks").mapInArrow(take, "doc_id long, row long, chunk int, data binary")


def _by_row(docs: DataFrame, chunks: DataFrame, rows: int, how: str) -> DataFrame:
    """Join per-document lists of chunk numbers to the documents; the lists are broadcast only
    while they are counted as small."""
    lists = chunks.groupBy("row").agg(F.collect_set("chunk").alias("chunks"))
    return docs.join(F.broadcast(lists) if rows * 64 <= BROADCAST_BYTES else lists, "row", how)


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(row, chunk) of every chunk that equals an earlier one, byte by byte. ``docs``: doc_id,
    row (a number of the document's id and text) and text.

    Of equal lines in a row, a chunk shares a line with the one before it; as its repeat it
    would take a line of the first occurrence, and is none."""
    cut = written(multi_line_chunks(docs), "chunks")
    place = F.struct("doc_id", "row", "chunk")
    first = cut.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    same = written(cut.join(first, ["h1", "h2"]).select("row", "chunk", "first"), "same-hash")
    # The first occurrences are among the rows of ``same`` themselves.
    data = written(chunk_bytes(_by_row(docs.dropDuplicates(["row"]), same, same.count(), "inner")).drop("doc_id"), "chunk-bytes")
    firsts = data.select(F.col("row").alias("first_row"), F.col("chunk").alias("first_chunk"), F.col("data").alias("first_data"))
    later = same.filter((F.col("row") != F.col("first.row")) | (F.col("chunk") > F.col("first.chunk") + 1)).select(
        "row", "chunk", F.col("first.row").alias("first_row"), F.col("first.chunk").alias("first_chunk")
    )
    compared = later.join(data, ["row", "chunk"]).join(firsts, ["first_row", "first_chunk"])
    return written(compared.filter(F.col("data") == F.col("first_data")).select("row", "chunk"), "repeated")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lines_col: str = "n_lines", removed_col: str = "n_removed") -> DataFrame:
    """All rows and columns, with ``text_col`` cleared of repeated runs of two lines or more, and
    the numbers of lines before and of lines removed added; they replace columns of those names.

    A line goes if it is in a run of lines that the given texts have at an earlier place, by id
    and line, and that does not overlap it. Removed lines take their line breaks with them. Null
    texts stay null; runs without a character stay; a text that loses every line is empty.
    Rows that repeat an id and text are one document; null ids come first. Empty table: empty.
    """
    row = F.xxhash64(F.col(id_col), F.col(text_col))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), row.alias("row"), F.col(text_col).alias("text"))
    gone = repeated_chunks(base)
    names = docs.columns
    held = docs.select(row.alias("row"), F.struct(*[docs[c] for c in names]).alias("all"), docs[text_col].alias("text"))
    joined = _by_row(held, gone, gone.count(), "left").select("text", "chunks", "all")
    text_type = docs.schema[text_col].dataType

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                texts, lines, removed = [], [], []
                for text, chunks in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    lines.append(0 if text is None else text.count("\n") + 1)
                    removed.append(0)
                    if chunks:
                        data = _bytes(text)
                        at, spans, _ = chunk_lines(data)
                        keep = np.ones(len(at) - 1, dtype=bool)
                        for first, last in spans[chunks].tolist():
                            keep[first : last + 1] = False
                        text = b"\n".join(data[at[i] : at[i + 1] - 1] for i in np.flatnonzero(keep).tolist()).decode("utf-8", "surrogatepass")
                        removed[-1] = int((~keep).sum())
                    texts.append(text)
                yield pa.RecordBatch.from_arrays(
                    [part.column(2), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(removed, pa.int64())],
                    names=["all", "text", "n_lines_", "n_removed_"],
                )

    schema = joined.select("all", F.col("text").cast(text_type), F.lit(0).cast("long").alias("n_lines_"), F.lit(0).cast("long").alias("n_removed_")).schema
    cleaned = joined.mapInArrow(drop, schema)
    return cleaned.select(
        *[F.col("text").alias(c) if c == text_col else F.col("all")[c].alias(c) for c in names if c not in (lines_col, removed_col)],
        F.col("n_lines_").alias(lines_col),
        F.col("n_removed_").alias(removed_col),
    )


def removed_by_brute_force(texts: dict[int, str]) -> dict[int, str]:
    """The same result on a small corpus held in memory, over all runs of lines, for tests."""
    seen: dict[tuple[bytes, ...], tuple[int, int]] = {}
    out = {}
    for doc in sorted(texts):
        lines = _bytes(texts[doc]).split(b"\n")
        gone: set[int] = set()
        for i in range(len(lines)):
            for j in range(i + 2, len(lines) + 1):
                run = tuple(lines[i:j])
                there, start = seen.setdefault(run, (doc, i))
                if any(run) and (there != doc or start + len(run) <= i):
                    gone.update(range(i, j))
        out[doc] = b"\n".join(x for i, x in enumerate(lines) if i not in gone).decode()
    return out
