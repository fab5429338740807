"""Exact substring deduplication by suffix arrays.

Bytes covered by a string of WIDTH bytes that also starts in a smaller document go. Documents
are dealt to shards of a few megabytes, copies of one text to the same one, where they fold into
their smallest document (a text whose copies are too many for a shard is spread over several).
Every string has an anchor, the position of its
smallest k-gram hash, which equal strings share wherever they stand; an anchor's fingerprint
seen in two documents or more marks the strings around it as candidates (a filter that loses
none). Each shard builds a suffix array over its candidates, and common prefixes of WIDTH or
more tell which strings a smaller document of the shard has. What the shard does not settle
itself, it publishes as sorted runs by fingerprint. Runs of all shards are merged by binary
search, compared byte by byte; where differing contexts share a fingerprint, a suffix array over
them settles their strings. The answer goes back to the shard.

A string in a third of all documents is published once per shard. A fingerprint with very many
different surroundings is published string by string and dealt by each string's own hash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodseries.llm.common import maybe_broadcast, partitions, text_bytes, total, written
from prodseries.llm.hashing import BASE, BYTE, mixed, ordered_spans_hash, powers
from prodseries.llm.suffix_arrays import repeat_classes

WIDTH = 50
GRAM = 24
# Positions of an anchor per string.
REACH = WIDTH - GRAM + 1
# Text of a shard, and of what one bucket of fingerprints stands for.
SHARD_BYTES, BUCKET_BYTES = 2 << 20, 32 << 20
# Fingerprints have so many bits: they only choose candidates.
PRINT_BITS, PRINT_BYTES = 48, 6
# Contexts that one suffix array of the merge takes at a time.
MERGE_BYTES = 1 << 19
# A fingerprint in more documents than this is published string by string.
HOT_DOCUMENTS = 20_000
# Bytes hashed at a time.
SLICE = 1 << 19
_U64 = np.uint64


class Anchors:
    """Runs of strings with one anchor: document, first and last start, anchor, fingerprint."""

    def __init__(self, texts: list[bytes]) -> None:
        parts = [[] for _ in range(5)]
        for i, j, cut in _slices(texts):
            for held, more in zip(parts, _anchors(texts, i, j, cut), strict=True):
                held.append(more)
        self.doc, self.first, self.last, self.anchor = (np.concatenate([*p, np.zeros(0, np.int64)]) for p in parts[:4])
        self.print = np.concatenate([*parts[4], np.zeros(0, np.uint64)])


def _slices(texts: list[bytes]):
    """Document ranges of about a slice, as (first, end, offset); a longer text comes in
    overlapping stretches, so that every string lies in exactly one."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > SLICE:
            yield start, i, None
            start, held = i, 0
        if len(t) > SLICE:
            if start < i:
                yield start, i, None
            for cut in range(0, len(t) - WIDTH + 1, SLICE):
                yield i, i + 1, cut
            start, held = i + 1, 0
        else:
            held += len(t)
    if start < len(texts):
        yield start, len(texts), None


def _anchors(texts: list[bytes], i: int, j: int, cut: int | None):
    if cut is None:
        some, base = [t for t in texts[i:j]], 0
    else:
        some, base = [texts[i][cut : cut + SLICE + WIDTH - 1]], cut
    sizes = np.array([len(t) for t in some], dtype=np.int64)
    buf = np.frombuffer(b"".join(some), dtype=np.uint8)
    n = len(buf)
    none = np.zeros(0, np.int64)
    if n < WIDTH:
        return none, none, none, none, np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(BYTE[buf] * powers(BASE, n), out=sums[1:])
    gram = mixed((sums[GRAM:] - sums[:-GRAM]) * powers(pow(BASE, -1, 1 << 64), n - GRAM + 1))
    # Leftmost of the smallest hashes: 40 bits of hash above 24 bits of position.
    low = (gram & ~_U64((1 << 24) - 1)) | np.arange(len(gram), dtype=np.uint64)
    span = 1
    while 2 * span <= REACH:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = REACH - span
    least = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
    anchor = (least & _U64((1 << 24) - 1)).astype(np.int64)
    # Strings that lie in one document.
    starts = np.cumsum(sizes) - sizes
    inside = np.zeros(n + 1, dtype=np.int8)
    long = sizes >= WIDTH
    inside[starts[long]] += 1
    np.add.at(inside, (starts + sizes - WIDTH + 1)[long], -1)
    valid = np.cumsum(inside[: n - WIDTH + 1], dtype=np.int8).view(bool)
    turn = valid.copy()
    turn[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    first = np.flatnonzero(turn)
    stop = valid.copy()
    stop[:-1] &= (anchor[1:] != anchor[:-1]) | ~valid[1:]
    last = np.flatnonzero(stop)
    at = anchor[first]
    doc = np.searchsorted(starts, first, side="right") - 1
    shift = base - starts[doc]
    return doc + i, first + shift, last + shift, at + shift, gram[at] >> _U64(64 - PRINT_BITS)


def _packed(prints: np.ndarray) -> bytes:
    return np.ascontiguousarray(prints.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :PRINT_BYTES]).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // PRINT_BYTES, 8), dtype=np.uint8)
    out[:, :PRINT_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, PRINT_BYTES)
    return out.view("<u8").ravel()


def _small(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _large(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=kind)


def _documents(table: pa.Table) -> tuple[list, list[bytes], np.ndarray, dict[bytes, int]]:
    """Ids, texts as bytes, the rows that stand for a text (one with its smallest id), by id,
    and the smallest id of each text that a string fits in."""
    ids = table["doc_id"].to_pylist()
    texts = [(t or "").encode("utf-8", "surrogatepass") for t in table["text"].to_pylist()]
    first: dict[bytes, int] = {}
    order = []
    for i in sorted((i for i, d in enumerate(ids) if d is not None and len(texts[i]) >= WIDTH), key=lambda i: ids[i]):
        if texts[i] not in first:
            first[texts[i]] = ids[i]
            order.append(i)
    return ids, texts, np.array(order, dtype=np.int64), first


def _by_bucket(values: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that brings buckets together, the buckets, and where each starts (and the end)."""
    bucket = (mixed(values) % _U64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    names, starts = np.unique(bucket[order], return_index=True)
    return order, names, np.append(starts, len(values))


def fingerprints(table: pa.Table, buckets: int) -> pa.Table:
    """Distinct fingerprints of a shard by bucket, with the number of its documents (to 255)."""
    shard = table["shard"][0].as_py()
    _, texts, order, _ = _documents(table)
    found = Anchors([texts[i] for i in order.tolist()])
    by = np.argsort(found.print, kind="stable")
    prints, doc = found.print[by], found.doc[by]
    new = np.ones(len(by), dtype=bool)
    new[1:] = prints[1:] != prints[:-1]
    other = new.copy()
    other[1:] |= doc[1:] != doc[:-1]
    heads = np.flatnonzero(new)
    times = np.add.reduceat(other.astype(np.int64), heads) if len(heads) else np.zeros(0, np.int64)
    prints, times = prints[heads], np.minimum(times, 255).astype(np.uint8)
    order, names, at = _by_bucket(prints, buckets)
    prints, times = prints[order], times[order]
    return pa.table(
        {
            "bucket": pa.array(names, pa.int32()),
            "shard": pa.array([shard] * len(names), pa.int64()),
            "prints": pa.array([_packed(prints[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
            "times": pa.array([times[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()),
        }
    )


def repeated_fingerprints(table: pa.Table, hot: int) -> pa.Table:
    """For each shard, which of its fingerprints are in two documents or more, and very many."""
    shards = table["shard"].to_pylist()
    runs = [_unpacked(b) for b in table["prints"].to_pylist()]
    times = np.concatenate([np.frombuffer(b, dtype=np.uint8) for b in table["times"].to_pylist()]).astype(np.int64)
    names, back = np.unique(np.concatenate(runs), return_inverse=True)
    documents = np.bincount(back, times, len(names))
    state = ((documents > 1).astype(np.uint8) + (documents > hot).astype(np.uint8))[back]
    out, at = [], 0
    for shard, run in zip(shards, runs, strict=True):
        s = state[at : at + len(run)]
        at += len(run)
        out.append((shard, _packed(run[s > 0]), _packed(run[s > 1])))
    return pa.table(
        {"shard": pa.array([o[0] for o in out], pa.int64()), "seen": pa.array([o[1] for o in out], pa.binary()), "hot": pa.array([o[2] for o in out], pa.binary())}
    )


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, start + length), one after another."""
    done = np.cumsum(lengths)
    return np.repeat(starts - (done - lengths), lengths) + np.arange(done[-1] if len(done) else 0)


def _in(values: np.ndarray, names: np.ndarray) -> np.ndarray:
    if not len(names):
        return np.zeros(len(values), dtype=bool)
    return names[np.minimum(np.searchsorted(names, values), len(names) - 1)] == values


_RUN = ["prints", "docs", "starts", "counts", "data"]


def _rows(bucket, shard, kind, columns: list[list[bytes]]) -> pa.Table:
    return pa.table(
        {
            "bucket": pa.array(bucket, pa.int32()), "shard": pa.array(shard, pa.int64()), "kind": pa.array(kind, pa.int32()),
            **{name: pa.array(c, pa.binary()) for name, c in zip(_RUN, columns, strict=True)},
        }
    )


RUN_SCHEMA = "bucket int, shard long, kind int, " + ", ".join(f"{c} binary" for c in _RUN)


def shard_runs(table: pa.Table, seen: pa.Table, buckets: int) -> pa.Table:
    """What a shard settles itself (kind 0: documents, starts, lengths of spans), and the runs
    it publishes (kind 1), by bucket and sorted by fingerprint and content."""
    if not table.num_rows or not seen.num_rows:
        return _rows([], [], [], [[]] * 5)
    shard = table["shard"][0].as_py()
    ids, texts, order, _ = _documents(table)
    texts = [texts[i] for i in order.tolist()]
    names = np.array([ids[i] for i in order.tolist()], dtype=np.int64)
    known, hot = (np.sort(_unpacked(b"".join(seen[c].to_pylist()))) for c in ("seen", "hot"))
    found = Anchors(texts)
    wanted = np.flatnonzero(_in(found.print, known))
    if not len(wanted):
        return _rows([], [], [], [[]] * 5)
    doc, first, last, prints = (x[wanted] for x in (found.doc, found.first, found.last, found.print))

    # Candidates that follow each other are one segment of the text to be sorted.
    apart = np.ones(len(doc), dtype=bool)
    apart[1:] = (doc[1:] != doc[:-1]) | (first[1:] != last[:-1] + 1)
    heads = np.flatnonzero(apart)
    tails = np.append(heads[1:], len(doc)) - 1
    parts = [texts[d][a : b + WIDTH] for d, a, b in zip(doc[heads].tolist(), first[heads].tolist(), last[tails].tolist(), strict=True)]
    buf = np.frombuffer(b"\0".join(parts) + b"\0", dtype=np.uint8)
    sizes = np.array([len(p) + 1 for p in parts], dtype=np.int64)
    segment = np.cumsum(apart) - 1
    at = (np.cumsum(sizes) - sizes)[segment] + first - first[heads][segment]  # of each run in buf
    count = last - first + 1
    windows = _ranges(at, count)
    owner = np.repeat(np.arange(len(doc)), count)
    classes = repeat_classes(buf, windows, WIDTH)

    # A string is settled if a smaller document of the shard has it.
    who = names[doc[owner]]
    least = np.full(int(classes.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, classes, who)
    settled = least[classes] < who
    out = [_span_rows(shard, names, doc[owner], _ranges(first, count), settled)]

    # The rest is published, as stretches of strings with one anchor; hot ones one by one.
    one = np.repeat(_in(prints, hot), count)
    start = ~settled
    start[1:] &= settled[:-1] | (owner[1:] != owner[:-1]) | one[1:]
    end = ~settled
    end[:-1] &= settled[1:] | (owner[1:] != owner[:-1]) | one[:-1]
    a, b = np.flatnonzero(start), np.flatnonzero(end)
    if len(a):
        run, lengths = owner[a], b - a + 1
        left = windows[a]
        right = windows[b] + WIDTH
        content = ordered_spans_hash(buf, left, right)
        tag = np.where(one[a], content | _U64(1), prints[run] << _U64(1))
        by, buckets_, cut = _by_bucket(tag, buckets)
        starts = first[run] + (a - (np.cumsum(count) - count)[run])
        columns: list[list[bytes]] = [[] for _ in _RUN]
        for x, y in zip(cut[:-1], cut[1:], strict=True):
            some = by[x:y]
            some = some[np.lexsort((content[some], tag[some]))]
            columns[0].append(_small(tag[some]))
            columns[1].append(_small(names[doc[run[some]]]))
            columns[2].append(_small(starts[some].astype(np.int64)))
            columns[3].append(_small(lengths[some].astype(np.int32)))
            columns[4].append(_small(buf[_ranges(left[some], right[some] - left[some])]))
        out.append(_rows(buckets_, [shard] * len(buckets_), [1] * len(buckets_), columns))
    return pa.concat_tables(out)


def _span_rows(shard: int, names: np.ndarray, doc: np.ndarray, start: np.ndarray, hit: np.ndarray) -> pa.Table:
    """Maximal stretches of hit strings, in text order, as one row of spans."""
    doc, start = doc[hit], start[hit]
    if not len(doc):
        return _rows([], [], [], [[]] * 5)
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
    heads = np.flatnonzero(new)
    lengths = np.diff(np.append(heads, len(doc))) + WIDTH - 1
    return _rows([shard & 0x7FFFFFFF], [shard], [0], [[b""], [_small(names[doc[heads]])], [_small(start[heads].astype(np.int64))], [_small(lengths.astype(np.int32))], [b""]])


def merged_runs(runs: list[np.ndarray]) -> np.ndarray:
    """Sorted distinct keys of sorted runs, merged in pairs: where each key of one run stands in
    the other is found by binary search, and keys the other lacks are put there."""
    while len(runs) > 1:
        pairs = []
        for left, right in zip(runs[::2], runs[1::2], strict=False):
            at = np.searchsorted(left, right)
            lacks = left[np.minimum(at, len(left) - 1)] != right if len(left) else np.ones(len(right), dtype=bool)
            pairs.append(np.insert(left, at[lacks], right[lacks]))
        runs = pairs + ([runs[-1]] if len(runs) % 2 else [])
    return runs[0]


def _settled_strings(buf, at, sizes, counts, docs, starts, shard, whole, rows, members) -> tuple:
    """Spans of ``members`` whose strings a smaller document has, by a suffix array over the
    contexts ``rows`` that stand for them."""
    parts = buf[_ranges(at[rows], sizes[rows])]
    place = np.cumsum(counts[rows]) - counts[rows]
    windows = _ranges(np.cumsum(sizes[rows]) - sizes[rows], counts[rows])
    classes = repeat_classes(parts, windows, WIDTH)
    least = np.full(int(classes.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, classes, np.repeat(docs[rows], counts[rows]))
    by = np.argsort(rows)
    local = place[by[np.searchsorted(rows[by], whole[members])]]
    owner = np.repeat(np.arange(len(members)), counts[members])
    inner = _ranges(np.zeros(len(members), np.int64), counts[members])
    hit = least[classes[local[owner] + inner]] < docs[members[owner]]
    owner, inner = owner[hit], inner[hit]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (inner[1:] != inner[:-1] + 1)
    heads = np.flatnonzero(new)
    lengths = np.diff(np.append(heads, len(owner))) + WIDTH - 1
    o = members[owner[heads]]
    return shard[o], docs[o], starts[o] + inner[heads], lengths


def merged_bucket(table: pa.Table) -> pa.Table:
    """Spans of strings that a smaller document of another shard has, by shard."""
    kind = np.asarray(table["kind"])
    spans = table.filter(pa.array(kind == 0)).select(["shard", "docs", "starts", "counts"])
    table = table.filter(pa.array(kind == 1))
    if not table.num_rows:
        return spans
    kinds = (("prints", np.uint64), ("docs", np.int64), ("starts", np.int64), ("counts", np.int32))
    cells = {c: [_large(b, t) for b in table[c].to_pylist()] for c, t in kinds}
    tag, docs, starts, counts = (np.concatenate(cells[c]) for c, _ in kinds)
    counts = counts.astype(np.int64)
    shard = np.repeat(np.array(table["shard"].to_pylist(), dtype=np.int64), [len(x) for x in cells["docs"]])
    buf = np.concatenate([_large(b, np.uint8) for b in table["data"].to_pylist()])
    sizes = counts + WIDTH - 1
    at = np.cumsum(sizes) - sizes

    # Equal contexts fold into one: found by binary search in the merged runs, then compared.
    key = mixed(tag ^ ordered_spans_hash(buf, at, at + sizes))
    cuts = np.cumsum([len(x) for x in cells["docs"]])[:-1]
    place = np.searchsorted(merged_runs([np.unique(r) for r in np.split(key, cuts)]), key)
    by = np.lexsort((docs, place))
    head = np.ones(len(by), dtype=bool)
    head[1:] = place[by[1:]] != place[by[:-1]]
    whole = np.empty(len(key), dtype=np.int64)
    whole[by] = by[np.flatnonzero(head)][np.cumsum(head) - 1]  # the context's smallest document's row
    same = sizes == sizes[whole]
    checked = np.flatnonzero(same & (whole != np.arange(len(whole))))
    bad = np.zeros(len(key), dtype=bool)
    for x in range(0, len(checked), 1 << 14):
        some = checked[x : x + (1 << 14)]
        differ = buf[_ranges(at[some], sizes[some])] != buf[_ranges(at[whole[some]], sizes[some])]
        bad[some] = np.add.reduceat(differ.astype(np.int64), np.cumsum(sizes[some]) - sizes[some]) > 0
    whole = np.where(same & ~bad, whole, np.arange(len(whole)))

    # Fingerprints with one context are settled by its smallest document; others string by string.
    rows = np.unique(whole)
    _, back, times = np.unique(tag[rows], return_inverse=True, return_counts=True)
    alone = np.zeros(len(key), dtype=bool)
    alone[rows] = times[back] == 1
    simple = np.flatnonzero(alone[whole] & (docs[whole] < docs))
    out = [(shard[simple], docs[simple], starts[simple], sizes[simple])]

    # Equal strings have one fingerprint, so whole fingerprints are taken, a bounded lot at a time.
    rest = rows[~alone[rows]]
    rest = rest[np.argsort(tag[rest], kind="stable")]
    folds = np.flatnonzero(~alone[whole])
    folds = folds[np.argsort(tag[folds], kind="stable")]
    if len(rest):
        heads = np.flatnonzero(np.append(True, tag[rest[1:]] != tag[rest[:-1]]))
        lot = np.cumsum(sizes[rest])[heads] // MERGE_BYTES
        cuts = heads[np.append(True, lot[1:] != lot[:-1])]
        for x, y in zip(cuts.tolist(), np.append(cuts[1:], len(rest)).tolist(), strict=True):
            some = rest[x:y]
            low = np.searchsorted(tag[folds], tag[some[0]], side="left")
            high = np.searchsorted(tag[folds], tag[some[-1]], side="right")
            out.append(_settled_strings(buf, at, sizes, counts, docs, starts, shard, whole, some, folds[low:high]))
    shard, docs, starts, sizes = (np.concatenate(x) for x in zip(*out, strict=True))
    by = np.argsort(shard, kind="stable")
    names, cut = np.unique(shard[by], return_index=True)
    cells = [np.split(x[by].astype(t), cut[1:]) for x, t in ((docs, np.int64), (starts, np.int64), (sizes, np.int32))]
    found = pa.table(
        {"shard": pa.array(names, pa.int64()), **{c: pa.array([_small(x) for x in v][: len(names)], pa.binary()) for c, v in zip(("docs", "starts", "counts"), cells, strict=True)}}
    )
    return pa.concat_tables([spans, found])


def cleared(table: pa.Table, spans: pa.Table) -> pa.Table:
    """Remove the spans' bytes from a shard's documents."""
    ids, texts, _, first = _documents(table)
    kinds = (("docs", np.int64), ("starts", np.int64), ("counts", np.int32))
    docs, starts, sizes = (
        np.concatenate([np.zeros(0, t), *(_large(b, t) for b in spans[c].to_pylist())]) for c, t in kinds
    )
    by = np.argsort(docs, kind="stable")
    docs, starts, ends = docs[by], starts[by], starts[by] + sizes[by]
    columns: list[list] = [[] for _ in range(7)]
    for doc, text in zip(ids, texts, strict=True):
        left, right, kept = np.zeros(0, np.int64), np.zeros(0, np.int64), text
        if doc is not None and first.get(text, doc) < doc:
            left, right, kept = np.array([0]), np.array([len(text)]), b""
        elif doc is not None:
            a, b = np.searchsorted(docs, [doc, doc + 1])
            if b > a:
                # A repeated id with a shorter text has none of the spans of the longer one's end.
                depth = np.zeros(len(text) + 1, dtype=np.int64)
                np.add.at(depth, np.minimum(starts[a:b], len(text)), 1)
                np.add.at(depth, np.minimum(ends[a:b], len(text)), -1)
                gone = np.cumsum(depth[:-1]) > 0
                edge = np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))
                left, right = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
        for held, value in zip(
            columns, (doc, len(text), len(text) - len(kept), len(left), hashlib.sha256(kept).hexdigest(), np.stack([left, right], axis=1).ravel().tolist(), kept), strict=True
        ):
            held.append(value)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary()]
    return pa.table({n: pa.array(c, k) for n, c, k in zip(RESULT, columns, kinds, strict=True)})


RESULT = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
RESULT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>, kept binary"


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shard_bytes: int = SHARD_BYTES, hot_documents: int = HOT_DOCUMENTS) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (starts and ends of the
    removed bytes, in turn) and kept (the remaining bytes).

    Texts are UTF-8 bytes; null is empty. Texts under WIDTH bytes lose nothing. Only a smaller
    id removes: repeated rows of one id leave each other alone (an id is expected to name one
    text), and a row with a null id neither loses bytes nor makes others lose them. Empty
    table: empty result; other columns are not read.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = total(base, text_bytes(F.col("text")))
    width = partitions(docs.sparkSession)
    shards = max(width, -(-size // shard_bytes))
    buckets = max(width, -(-size // BUCKET_BYTES))
    # Copies of a text share a shard, unless they would fill a good part of it.
    copies = base.groupBy(F.xxhash64("text").alias("text_hash")).agg(F.sum(text_bytes(F.col("text"))).alias("held"))
    many = written(copies.filter(F.col("held") > shard_bytes // 4), "hot-texts")
    spread = base.withColumn("text_hash", F.xxhash64("text")).join(maybe_broadcast(many, 32), "text_hash", "left")
    part = F.pmod(F.xxhash64("doc_id"), F.ceil(F.coalesce("held", F.lit(0)) / (shard_bytes // 4)) + 1)
    # Used three times; the planner deals it once.
    dealt = spread.select(
        "doc_id", "text", F.pmod(F.xxhash64("text_hash", part.cast("long")), F.lit(shards)).alias("shard")
    ).repartition(width, "shard")

    prints = dealt.groupBy("shard").applyInArrow(
        lambda t: fingerprints(t, buckets), "bucket int, shard long, prints binary, times binary"
    )
    seen = prints.groupBy("bucket").applyInArrow(
        lambda t: repeated_fingerprints(t, hot_documents), "shard long, seen binary, hot binary"
    ).repartition(width, "shard")
    runs = dealt.groupBy("shard").cogroup(seen.groupBy("shard")).applyInArrow(
        lambda a, b: shard_runs(a, b, buckets), RUN_SCHEMA
    )
    spans = runs.groupBy("bucket").applyInArrow(
        merged_bucket, "shard long, docs binary, starts binary, counts binary"
    ).repartition(width, "shard")
    return dealt.groupBy("shard").cogroup(spans.groupBy("shard")).applyInArrow(cleared, RESULT_SCHEMA)


def removed_by_brute_force(texts: dict[int, bytes], width: int = WIDTH) -> dict[int, np.ndarray]:
    """Which bytes of each text go, on a small corpus held in memory, for tests."""
    least: dict[bytes, int] = {}
    for doc, t in texts.items():
        for i in range(len(t) - width + 1):
            s = t[i : i + width]
            least[s] = min(doc, least.get(s, doc))
    out = {}
    for doc, t in texts.items():
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - width + 1):
            if least[t[i : i + width]] < doc:
                gone[i : i + width] = True
        out[doc] = gone
    return out
