"""Removal of long repeats of words, found by recompression.

A text's words are shortened round by round: runs of one symbol get one name, then symbols are
told apart by a bit of their name's hash, and each left one followed by a right one gets the
pair's name. Names are hashes of what they stand for, so every task gives equal things equal
names, and equal stretches of words get the same symbols inside, whatever is around them: a
symbol is settled by the words of its extent alone, a few words more than its own. Spark rounds
count the names over the whole corpus:

1. Each window of words has a longest symbol whose extent lies in it (of equals the least hash).
   Windows whose symbol no second document has repeat nowhere and are done with.
2. Symbols of a window's length or more are kept with their smallest document. One that a
   smaller document has reveals a repeat of all its words at once.
3. Windows left over, at the edges of such repeats, are compared as wholes with those of all
   other documents, by 96 bits of hash.

Documents are dealt to shards of a few megabytes, copies of one text to the same one (a text with
too many copies to several). A name goes out once for each shard that has it, packed with others.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodseries.llm.common import maybe_broadcast, partitions, text_bytes, total, written
from prodseries.llm.hashing import BASE, OTHER_BASE, in_slices, joined, mixed, ordered_spans_hash, powers, word_spans
from prodseries.llm.substring_dedup import _by_bucket, _in, _large, _packed, _ranges, _small, _unpacked

WIDTH = 13
# Rounds whose symbols can lie in a window with their extent, and until symbols are long.
SHORT_ROUNDS, ROUNDS = 4, 12
# Windows without a symbol of more words than this go by their own hash.
WEAK = 2
SHARD_BYTES, BUCKET_BYTES = 2 << 20, 32 << 20
# Words that are parsed at a time; longer texts come in stretches that overlap by a window.
LOT = 1 << 17
_U64 = np.uint64
_FAR = 1 << 40


class Symbols(NamedTuple):
    """Names, the text each is in, first and last word, extent, and which are new in a round."""

    name: np.ndarray
    owner: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    left: np.ndarray
    right: np.ndarray
    new: np.ndarray


def words_as_symbols(words: np.ndarray, owner: np.ndarray) -> Symbols:
    at = np.arange(len(words))
    return Symbols(words, owner, at, at + 1, at, at + 1, np.ones(len(words), dtype=bool))


def _neighbours(s: Symbols) -> tuple[np.ndarray, np.ndarray]:
    """Extents of the symbols before and behind each; without bound at a text's ends."""
    joint = s.owner[1:] == s.owner[:-1]
    before, behind = np.full(len(s.name), -_FAR), np.full(len(s.name), _FAR)
    before[1:][joint] = s.left[:-1][joint]
    behind[:-1][joint] = s.right[1:][joint]
    return before, behind


def runs_named(s: Symbols) -> Symbols:
    """Each maximal run of one symbol under one name; that a run ends is seen by its neighbours."""
    before, behind = _neighbours(s)
    head = np.ones(len(s.name), dtype=bool)
    head[1:] = (s.name[1:] != s.name[:-1]) | (s.owner[1:] != s.owner[:-1])
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(s.name)) - 1
    times = (last - first + 1).astype(np.uint64)
    several = times > 1
    name = np.where(several, mixed(s.name[first] * _U64(7) + times * _U64(0x9E3779B97F4A7C15)), s.name[first])
    return Symbols(name, s.owner[first], s.start[first], s.stop[last], before[first], behind[last], several)


def pairs_named(s: Symbols, number: int) -> Symbols:
    """Each left symbol followed by a right one under their pair's name. A pair needs no look
    around; that a symbol stays alone is seen by the one it could have joined."""
    before, behind = _neighbours(s)
    right = (mixed(s.name + _U64(number)) >> _U64(63)).astype(bool)
    opens = np.zeros(len(s.name), dtype=bool)
    opens[:-1] = ~right[:-1] & right[1:] & (s.owner[1:] == s.owner[:-1])
    kept = np.ones(len(s.name), dtype=bool)
    kept[1:] = ~opens[:-1]
    i = np.flatnonzero(kept)
    pair = opens[i]
    j = np.where(pair, i + 1, i)
    name = np.where(pair, mixed(s.name[i] * _U64(3) + mixed(s.name[j] + _U64(0xD1B54A32D192ED03))), s.name[i])
    return Symbols(
        name, s.owner[i], s.start[i], s.stop[j],
        np.where(right[i], before[i], s.left[i]), np.where(pair, s.right[j], np.where(right[i], s.right[i], behind[i])),
        pair | s.new[i],
    )


class Lot(NamedTuple):
    """Texts (or stretches of one) parsed together: the document and first word of each, the
    words' hashes, which text a word is in, and where each text starts (and the end)."""

    doc: np.ndarray
    first: np.ndarray
    words: np.ndarray
    owner: np.ndarray
    cuts: np.ndarray

    def windows(self) -> np.ndarray:
        """First words of the windows that lie in a text."""
        inside = np.zeros(len(self.words), dtype=bool)
        sizes = np.diff(self.cuts) - WIDTH + 1
        inside[_ranges(self.cuts[:-1], np.maximum(sizes, 0))] = True
        return np.flatnonzero(inside)

    def place(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents, and places in them, of words."""
        own = self.owner[at]
        return self.doc[own], self.first[own] + at - self.cuts[own]


def lots(texts: list[bytes]):
    """All texts of a window's length or more, about LOT words at a time."""
    held: list[tuple[int, int, np.ndarray]] = []
    size = 0

    def lot() -> Lot:
        sizes = np.array([len(w) for _, _, w in held], dtype=np.int64)
        doc, first = (np.array([h[i] for h in held], dtype=np.int64) for i in (0, 1))
        cuts = np.concatenate(([0], np.cumsum(sizes)))
        return Lot(doc, first, np.concatenate([w for _, _, w in held]), np.repeat(np.arange(len(held)), sizes), cuts)

    for a, b in in_slices(texts, len):
        buf, at = joined(texts[a:b])
        starts, ends = word_spans(buf)
        words = ordered_spans_hash(buf, starts, ends)
        for i, (x, y) in enumerate(zip(*(lambda f: (f[:-1], f[1:]))(np.searchsorted(starts, at).tolist()), strict=True)):
            for s in range(x, y - WIDTH + 1, LOT):
                held.append((a + i, s - x, words[s : min(s + LOT + WIDTH - 1, y)]))
                size += len(held[-1][2])
                if size >= LOT:
                    yield lot()
                    held, size = [], 0
    if held:
        yield lot()


def _sums(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


class Hashes:
    """Hashes of any stretch of a lot's words: equal stretches, equal hash."""

    def __init__(self, words: np.ndarray) -> None:
        self.n = len(words)
        self.one, self.two = _sums(words, BASE), _sums(mixed(words + _U64(0x2545F4914F6CDD1D)), OTHER_BASE)

    def long(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.one[stop] - self.one[start]) * powers(pow(BASE, -1, 1 << 64), self.n + 1)[start] + (stop - start).astype(np.uint64))

    def short(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Another 32 bits."""
        return (mixed((self.two[stop] - self.two[start]) * powers(pow(OTHER_BASE, -1, 1 << 64), self.n + 1)[start]) >> _U64(32)).astype(np.uint32)


def parsed(lot: Lot) -> tuple[np.ndarray, Symbols, Hashes]:
    """The 64-bit mark of every word's window (of its longest settled symbol), and the symbols of
    a window's length or more that hold none of that length."""
    best = np.full(len(lot.words), ~_U64(0))
    bottom, top = lot.cuts[lot.owner], lot.cuts[lot.owner + 1] - WIDTH
    symbols = words_as_symbols(lot.words, lot.owner)
    done: list[Symbols] = []
    for number in range(ROUNDS + 1):
        if not len(symbols.name):
            break
        if number:
            # A run is settled only by both its neighbours, so runs wait until extents are of no use.
            symbols = pairs_named(runs_named(symbols) if number > SHORT_ROUNDS else symbols, number)
            long = symbols.stop - symbols.start >= WIDTH
            if long.any():
                # Long symbols are cut out, so that no later one holds them.
                done.append(Symbols(*[x[long] for x in symbols]))
                symbols = Symbols(*[x[~long] for x in symbols])
                symbols = symbols._replace(owner=_parted(symbols.owner, long))
        if number <= SHORT_ROUNDS:
            fresh = np.flatnonzero(symbols.new & (symbols.right - symbols.left <= WIDTH))
            left, right = symbols.left[fresh], symbols.right[fresh]
            length = (symbols.stop - symbols.start)[fresh].astype(np.uint64)
            mark = ((_U64(15) - length) << _U64(60)) | (mixed(symbols.name[fresh]) >> _U64(4))
            low, high = np.maximum(bottom[left], right - WIDTH), np.minimum(top[left], left)
            for back in range(WIDTH):
                at = left - back
                ok = (at >= low) & (at <= high)
                at = at[ok]
                best[at] = np.minimum(best[at], mark[ok])
        symbols = symbols._replace(new=np.zeros(len(symbols.name), dtype=bool))
    hashes = Hashes(lot.words)
    weak = np.flatnonzero((best >> _U64(60)) >= _U64(15 - WEAK))
    weak = weak[weak <= top[weak]]
    best[weak] = hashes.long(weak, weak + WIDTH) | (_U64(15) << _U64(60))
    merged = Symbols(*[np.concatenate(x) for x in zip(*done, strict=True)]) if done else Symbols(*[x[:0] for x in symbols])
    return best, merged, hashes


def _parted(owner: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Owners by which symbols on both sides of a cut are apart; only their equality counts."""
    return (owner + np.cumsum(cut)[~cut]) if len(owner) else owner


class Shard:
    """A shard's documents: one row of each text with its smallest id, in order of ids."""

    def __init__(self, table: pa.Table) -> None:
        self.shard = table["shard"][0].as_py()
        self.ids = table["doc_id"].to_pylist()
        self.texts = [(t or "").encode("utf-8", "surrogatepass") for t in table["text"].to_pylist()]
        self.least: dict[bytes, int] = {}
        order = []
        for i in sorted((i for i, d in enumerate(self.ids) if d is not None and len(self.texts[i]) >= 2 * WIDTH - 1), key=lambda i: self.ids[i]):
            if self.texts[i] not in self.least:
                self.least[self.texts[i]] = self.ids[i]
                order.append(i)
        self.names = np.array([self.ids[i] for i in order], dtype=np.int64)
        self.parts = [self.texts[i] for i in order]

    def windows(self):
        """Per lot: the lot, its hashes, first words of windows, their marks and long symbols."""
        for lot in lots(self.parts):
            marks, long, hashes = parsed(lot)
            at = lot.windows()
            yield lot, hashes, at, _print(marks[at]), long


def _print(marks: np.ndarray) -> np.ndarray:
    return mixed(marks) >> _U64(16)


def _least(a: np.ndarray, b: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key (a, b), where each key's rows start in it, and each row's key's smallest document."""
    by = np.lexsort((b, a))
    head = np.ones(len(by), dtype=bool)
    head[1:] = (a[by[1:]] != a[by[:-1]]) | (b[by[1:]] != b[by[:-1]])
    heads = np.flatnonzero(head)
    out = np.empty(len(by), dtype=np.int64)
    if len(by):
        out[by] = np.minimum.reduceat(docs[by], heads)[np.cumsum(head) - 1]
    return by, heads, out


NAMES_SCHEMA = "bucket int, shard long, prints binary, times binary, names binary, rest binary, docs binary"


def names(table: pa.Table, buckets: int) -> pa.Table:
    """Of a shard, by bucket: distinct prints of window marks with the number of their documents
    (to 2), and names of long symbols with their smallest document."""
    shard = Shard(table)
    empty = np.zeros(0, np.int64)
    prints, docs, long, rest, holders = [empty.astype(np.uint64)], [empty], [empty.astype(np.uint64)], [empty.astype(np.uint32)], [empty]
    for lot, hashes, at, marks, symbols in shard.windows():
        found, back = np.unique(marks, return_inverse=True)
        who = lot.place(at)[0]
        low, high = np.full(len(found), np.iinfo(np.int64).max), np.full(len(found), -1)
        np.minimum.at(low, back, who)
        np.maximum.at(high, back, who)
        prints += [found, found[high > low]]
        docs += [low, high[high > low]]
        long.append(hashes.long(symbols.start, symbols.stop))
        rest.append(hashes.short(symbols.start, symbols.stop))
        holders.append(shard.names[lot.place(symbols.start)[0]])
    print_, doc = np.concatenate(prints), np.concatenate(docs)
    print_, back = np.unique(print_, return_inverse=True)
    low, high = np.full(len(print_), np.iinfo(np.int64).max), np.full(len(print_), -1)
    np.minimum.at(low, back, doc)
    np.maximum.at(high, back, doc)
    times = (1 + (high > low)).astype(np.uint8)
    name, other, holder = np.concatenate(long), np.concatenate(rest), np.concatenate(holders)
    by, heads, least = _least(name, other, holder)
    one = by[heads]
    name, other, holder = name[one], other[one], least[one]

    by, owns, at = _by_bucket(print_, buckets)
    print_, times = print_[by], times[by]
    by, long_owns, long_at = _by_bucket(name, buckets)
    name, other, holder = name[by], other[by], holder[by]
    cells: dict[int, list] = {}
    for bucket, x, y in zip(owns.tolist(), at[:-1], at[1:], strict=True):
        cells[bucket] = [_packed(print_[x:y]), _small(times[x:y]), b"", b"", b""]
    for bucket, x, y in zip(long_owns.tolist(), long_at[:-1], long_at[1:], strict=True):
        cells.setdefault(bucket, [b"", b"", b"", b"", b""])[2:] = [name[x:y].tobytes(), other[x:y].tobytes(), _small(holder[x:y])]
    columns = list(zip(*cells.values(), strict=True)) or [()] * 5
    return pa.table(
        {
            "bucket": pa.array(cells, pa.int32()), "shard": pa.array([shard.shard] * len(cells), pa.int64()),
            **{n: pa.array(c, pa.binary()) for n, c in zip(("prints", "times", "names", "rest", "docs"), columns, strict=True)},
        }
    )


def _opened(data: bytes, kind) -> np.ndarray:
    return _large(data, kind) if data else np.zeros(0, kind)


def repeated_names(table: pa.Table) -> pa.Table:
    """For each shard: its prints that two documents or more have, and its long names that a
    smaller document has."""
    shards = table["shard"].to_pylist()
    runs = [_unpacked(b) for b in table["prints"].to_pylist()]
    times = np.concatenate([_opened(b, np.uint8) for b in table["times"].to_pylist()]).astype(np.int64)
    found, back = np.unique(np.concatenate(runs), return_inverse=True)
    seen = (np.bincount(back, times, len(found)) > 1)[back]
    long = [np.frombuffer(b, np.uint64) for b in table["names"].to_pylist()]
    name, rest = np.concatenate(long), np.concatenate([np.frombuffer(b, np.uint32) for b in table["rest"].to_pylist()])
    docs = np.concatenate([_opened(b, np.int64) for b in table["docs"].to_pylist()])
    hit = _least(name, rest, docs)[2] < docs
    out, at, there = [], 0, 0
    for shard, run, own in zip(shards, runs, long, strict=True):
        out.append((shard, _packed(run[seen[at : at + len(run)]]), own[hit[there : there + len(own)]].tobytes()))
        at, there = at + len(run), there + len(own)
    return pa.table(
        {"shard": pa.array([o[0] for o in out], pa.int64()), "seen": pa.array([o[1] for o in out], pa.binary()), "long": pa.array([o[2] for o in out], pa.binary())}
    )


_CELLS = ["names", "rest", "docs", "starts"]
WINDOWS_SCHEMA = "bucket int, shard long, kind int, " + ", ".join(f"{c} binary" for c in _CELLS)


def _rows(bucket, shard, kind: int, columns: list) -> pa.Table:
    return pa.table(
        {
            "bucket": pa.array(bucket, pa.int32()), "shard": pa.array(shard, pa.int64()), "kind": pa.array([kind] * len(bucket), pa.int32()),
            **{n: pa.array(c, pa.binary()) for n, c in zip(_CELLS, columns, strict=True)},
        }
    )


def _spans(docs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of documents as maximal stretches of words: document, first word, number."""
    by = np.lexsort((starts, docs))
    docs, starts = docs[by], starts[by]
    head = np.ones(len(by), dtype=bool)
    head[1:] = (docs[1:] != docs[:-1]) | (starts[1:] > starts[:-1] + WIDTH)
    heads = np.flatnonzero(head)
    ends = starts[np.append(heads[1:], len(by)) - 1] + WIDTH if len(by) else starts
    return docs[heads], starts[heads], ends - starts[heads]


def _span_cells(docs: np.ndarray, starts: np.ndarray) -> list[bytes]:
    doc, start, size = _spans(docs, starts)
    return [b"", _small(size.astype(np.int32)), _small(doc), _small(start.astype(np.int64))]


def shard_windows(table: pa.Table, seen: pa.Table, buckets: int) -> pa.Table:
    """What a shard settles itself (kind 0: spans), and the windows it publishes (kind 1)."""
    none = _rows([], [], 0, [[]] * 4)
    if not table.num_rows or not seen.num_rows:
        return none
    shard = Shard(table)
    known = np.sort(_unpacked(b"".join(seen["seen"].to_pylist())))
    smaller = np.sort(np.frombuffer(b"".join(seen["long"].to_pylist()), np.uint64))
    # Smallest document of the shard for each long symbol of its own.
    held = []
    for lot, hashes, at, marks, symbols in shard.windows():
        wanted = _in(marks, known)
        name, rest = hashes.long(symbols.start, symbols.stop), hashes.short(symbols.start, symbols.stop)
        at = at[wanted]
        held.append((lot, at, hashes.long(at, at + WIDTH), hashes.short(at, at + WIDTH), symbols, name, rest, shard.names[lot.place(symbols.start)[0]]))
    if not held:
        return none
    least = _least(*(np.concatenate([h[i] for h in held]) for i in (5, 6, 7)))[2]
    parts: list[list[np.ndarray]] = [[], [], [], [], []]
    done = 0
    for lot, at, a, b, symbols, name, _, holder in held:
        hit = _in(name, smaller) | (least[done : done + len(name)] < holder)
        done += len(name)
        # Windows inside a long symbol that a smaller document has are settled.
        depth = np.zeros(len(lot.words) + 1, dtype=np.int64)
        np.add.at(depth, symbols.start[hit], 1)
        np.add.at(depth, symbols.stop[hit] - WIDTH + 1, -1)
        inside = np.cumsum(depth[:-1]) > 0
        own = np.flatnonzero(inside)
        settled = np.concatenate([own, at[~inside[at]]])
        doc, place = lot.place(settled)
        free = ~inside[at]
        zero = np.zeros(len(own), np.uint64)
        for part, more in zip(parts, (shard.names[doc], place, np.concatenate([zero, a[free]]), np.concatenate([zero.astype(np.uint32), b[free]]), np.arange(len(settled)) < len(own)), strict=True):
            part.append(more)
    docs, starts, a, b, inside = (np.concatenate(p) for p in parts)
    free = np.flatnonzero(~inside)
    settled = inside.copy()
    settled[free] = _least(a[free], b[free], docs[free])[2] < docs[free]
    out = [_rows([shard.shard & 0x7FFFFFFF], [shard.shard], 0, [[c] for c in _span_cells(docs[settled], starts[settled])])]
    docs, starts, a, b = (x[~settled] for x in (docs, starts, a, b))
    by, owns, cut = _by_bucket(a, buckets)
    columns: list[list[bytes]] = [[] for _ in _CELLS]
    for x, y in zip(cut[:-1], cut[1:], strict=True):
        some = by[x:y]
        some = some[np.lexsort((starts[some], docs[some]))]
        for column, cell in zip(columns, (a[some].tobytes(), b[some].tobytes(), _small(docs[some]), _small(starts[some].astype(np.int32))), strict=True):
            column.append(cell)
    out.append(_rows(owns, [shard.shard] * len(owns), 1, columns))
    return pa.concat_tables(out)


SPANS_SCHEMA = "shard long, docs binary, starts binary, sizes binary"


def merged_windows(table: pa.Table) -> pa.Table:
    """Spans of windows that a smaller document has, by shard."""
    kind = np.asarray(table["kind"])
    own = table.filter(pa.array(kind == 0))
    out = [[own["shard"].to_pylist(), own["docs"].to_pylist(), own["starts"].to_pylist(), own["rest"].to_pylist()]]
    table = table.filter(pa.array(kind == 1))
    if table.num_rows:
        shards = table["shard"].to_pylist()
        docs = [_large(d, np.int64) for d in table["docs"].to_pylist()]
        starts = np.concatenate([_large(s, np.int32) for s in table["starts"].to_pylist()]).astype(np.int64)
        a = np.concatenate([np.frombuffer(x, np.uint64) for x in table["names"].to_pylist()])
        b = np.concatenate([np.frombuffer(x, np.uint32) for x in table["rest"].to_pylist()])
        doc = np.concatenate(docs)
        hit = _least(a, b, doc)[2] < doc
        at = 0
        for shard, n in zip(shards, map(len, docs), strict=True):
            some = at + np.flatnonzero(hit[at : at + n])
            at += n
            if len(some):
                cells = _span_cells(doc[some], starts[some])
                for column, cell in zip(out[0], (shard, cells[2], cells[3], cells[1]), strict=True):
                    column.append(cell)
    shard, docs, starts, sizes = out[0]
    return pa.table({"shard": pa.array(shard, pa.int64()), **{n: pa.array(c, pa.binary()) for n, c in (("docs", docs), ("starts", starts), ("sizes", sizes))}})


RESULT_SCHEMA = "doc_id long, n_words long, n_removed long, spans array<long>, kept string"


def cleared(table: pa.Table, spans: pa.Table) -> pa.Table:
    """A shard's rows without the spans' words."""
    if not table.num_rows:
        return pa.table({n: pa.array([], t) for n, t in zip(_RESULT, _RESULT_TYPES, strict=True)})
    shard = Shard(table)
    docs, starts, sizes = (
        np.concatenate([np.zeros(0, t), *(_large(x, t) for x in spans[c].to_pylist())]).astype(np.int64)
        for c, t in (("docs", np.int64), ("starts", np.int64), ("sizes", np.int32))
    )
    by = np.argsort(docs, kind="stable")
    docs, starts, ends = docs[by], starts[by], (starts + sizes)[by]
    rows: list[tuple] = []
    for doc, text in zip(shard.ids, shard.texts, strict=True):
        buf = np.frombuffer(text + b"\n", dtype=np.uint8)
        first, last = word_spans(buf)
        n = len(first)
        gone = np.zeros(n, dtype=bool)
        if doc is not None and shard.least.get(text, doc) < doc:
            gone[:] = n >= WIDTH
        elif doc is not None:
            x, y = np.searchsorted(docs, [doc, doc + 1])
            if y > x:
                # A repeated id with a shorter text has none of the spans of the longer one's end.
                depth = np.zeros(n + 1, dtype=np.int64)
                np.add.at(depth, np.minimum(starts[x:y], n), 1)
                np.add.at(depth, np.minimum(ends[x:y], n), -1)
                gone = np.cumsum(depth[:-1]) > 0
        edge = np.diff(np.concatenate(([False], gone, [False])).astype(np.int8))
        cuts = np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1).ravel().tolist()
        stay = np.flatnonzero(~gone)
        kept = b" ".join([text[i:j] for i, j in zip(first[stay].tolist(), last[stay].tolist(), strict=True)])
        rows.append((doc, n, n - len(stay), cuts, kept.decode("utf-8", "replace")))
    return pa.table({n: pa.array(c, t) for n, c, t in zip(_RESULT, zip(*rows, strict=True), _RESULT_TYPES, strict=True)})


_RESULT = ["doc_id", "n_words", "n_removed", "spans", "kept"]
_RESULT_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string()]


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, spans (first words and ends of what goes, in turn)
    and kept (the words that stay, joined by spaces).

    Words are runs without ASCII white space. A word goes if it lies in WIDTH words that a text
    with a smaller id has too, as given. Null and empty texts have no words; texts under WIDTH
    words lose nothing. Repeated rows of one id leave each other alone (an id is expected to
    name one text), and a row with a null id neither loses words nor makes others lose them.
    Empty table: empty result; other columns are not read.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = total(base, text_bytes(F.col("text")))
    width = partitions(docs.sparkSession)
    shards = max(width, -(-size // shard_bytes))
    buckets = max(width, -(-size // BUCKET_BYTES))
    # Copies of a text share a shard, unless they would fill a good part of it.
    copies = base.groupBy(F.xxhash64("text").alias("text_hash")).agg(F.sum(text_bytes(F.col("text"))).alias("held"))
    many = maybe_broadcast(written(copies.filter(F.col("held") > shard_bytes // 4), "hot-texts"), 32)
    spread = base.withColumn("text_hash", F.xxhash64("text")).join(many, "text_hash", "left")
    part = F.pmod(F.xxhash64("doc_id"), F.ceil(F.coalesce("held", F.lit(0)) / (shard_bytes // 4)) + 1)
    # Used three times; the planner deals it once.
    dealt = spread.select("doc_id", "text", F.pmod(F.xxhash64("text_hash", part.cast("long")), F.lit(shards)).alias("shard")).repartition(width, "shard")

    found = dealt.groupBy("shard").applyInArrow(lambda t: names(t, buckets), NAMES_SCHEMA)
    seen = found.groupBy("bucket").applyInArrow(repeated_names, "shard long, seen binary, long binary").repartition(width, "shard")
    windows = dealt.groupBy("shard").cogroup(seen.groupBy("shard")).applyInArrow(lambda a, b: shard_windows(a, b, buckets), WINDOWS_SCHEMA)
    spans = windows.groupBy("bucket").applyInArrow(merged_windows, SPANS_SCHEMA).repartition(width, "shard")
    return dealt.groupBy("shard").cogroup(spans.groupBy("shard")).applyInArrow(cleared, RESULT_SCHEMA)

