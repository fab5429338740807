"""Near duplicates by b-bit MinHash.

Each document's set of word shingles gives minima under many hash functions. Bands of full
minima bring candidates together; the low bits of the minima, packed into a few longs, give a
similarity estimate, corrected for chance collisions, by bit counts; candidates that may reach
the threshold are confirmed on the full sets.

Within a bucket of candidates the smallest document is compared with every other one, so a
bucket gives a row for each member, not for each pair. Members that are still apart once these
links are joined into groups are compared with the members of other groups, in blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodseries.llm.common import free_name, maybe_broadcast, row_key, written
from prodseries.llm.hashing import in_slices, joined, mixed, spans_hash, word_spans

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
LOW_BITS = 2
LANES = 64 // LOW_BITS
# A pair at the threshold is estimated below it by this much once in some ten million times
# (5.3 standard deviations of the corrected estimate with 160 two-bit lanes).
ESTIMATE_SLACK = 0.2
# Minima of a few shingles are not as independent: candidates of which one has no more than
# these are confirmed without an estimate.
SMALL_SET = 64
# Members, and shingles of theirs, of a block; larger buckets are compared in pairs of blocks.
BLOCK, BLOCK_SHINGLES = 2048, 1 << 21

_RNG = np.random.default_rng(20240918)
_XOR = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_MUL = (_RNG.integers(0, 1 << 31, HASHES, dtype=np.uint64) * 2 + 1).astype(np.uint32)


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """The distinct k-word shingles of each text, as sorted 64-bit hashes.

    Words are runs without ASCII white space, A-Z lower-cased. Fewer words than k: the whole
    sequence is the one shingle. Null or no words: empty.
    """
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    out: list[np.ndarray] = []
    for a, b in in_slices(raw, len):
        buf, at = joined(raw[a:b])
        starts, ends = word_spans(buf)
        words = spans_hash(buf, starts, ends)
        first = np.searchsorted(starts, at)
        run = np.zeros(len(words), dtype=np.uint64)
        for j in range(k):
            run[: len(words) - j] = mixed(run[: len(words) - j] + words[j:] * np.uint64(2 * j + 3))
        for i, j in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if j - i >= k:
                out.append(np.unique(run[i : j - k + 1]))
            elif j > i:
                whole = np.array([j - i], dtype=np.uint64)
                for w in range(i, j):
                    whole = mixed(whole + words[w : w + 1] * np.uint64(5))
                out.append(whole)
            else:
                out.append(np.zeros(0, dtype=np.uint64))
    return out


def minima(shingles: np.ndarray) -> np.ndarray:
    """Minimum of every hash function over a set that is not empty."""
    low = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(values), 1024):
        np.minimum(low, ((values[i : i + 1024, None] ^ _XOR) * _MUL).min(axis=0), out=low)
    return low


def packed_low_bits(low: np.ndarray) -> np.ndarray:
    """Low bits of each minimum mixed with its function's number. The minima's own low bits come
    from those of the shingles alone: two shingles would collide under all functions or none."""
    own = mixed(low.astype(np.uint64) + (np.arange(HASHES, dtype=np.uint64) << np.uint64(32)))
    lanes = (own & np.uint64((1 << LOW_BITS) - 1)).reshape(-1, LANES)
    return np.bitwise_or.reduce(lanes << (np.arange(LANES, dtype=np.uint64) * np.uint64(LOW_BITS)), axis=1)


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = mixed(key + rows[:, j] * np.uint64(2 * j + 3))
    return key


def _as_array(i64: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in i64]))).astype(np.int32)
    values = np.concatenate([*i64, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, row, n_shingles, digest, bands, bits); without shingles digest is null."""
    schema = "doc_id long, row long, n_shingles long, digest binary, bands array<long>, bits array<long>"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, column = batch.column(0), batch.column(1), batch.column(2)
            for a in range(0, len(ids), 256):
                sets = shingle_sets(column.slice(a, 256).to_pylist(), k)
                lows = [minima(s) if len(s) else None for s in sets]
                none = np.zeros(0, dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, 256),
                        rows.slice(a, 256),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        _as_array([none if m is None else band_keys(m) for m in lows]),
                        _as_array([none if m is None else packed_low_bits(m) for m in lows]),
                    ],
                    names=["doc_id", "row", "n_shingles", "digest", "bands", "bits"],
                )

    return docs.select("doc_id", "row", "text").mapInArrow(sign, schema)


def full_sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, shingles)"""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            for a in range(0, len(ids), 256):
                found = shingle_sets(column.slice(a, 256).to_pylist(), k)
                yield pa.RecordBatch.from_arrays([ids.slice(a, 256), _as_array(found)], names=["doc_id", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(sets, "doc_id long, shingles array<long>")


def estimate(a: Column, b: Column) -> Column:
    """Collision-corrected similarity from packed low bits: lanes that differ are counted."""
    odd = F.lit(0x5555555555555555)
    differs = F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y))
    lanes = F.aggregate(
        differs, F.lit(0), lambda n, x: n + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(odd))
    )
    chance = 1.0 / (1 << LOW_BITS)
    return ((1.0 - lanes / float(HASHES)) - chance) / (1.0 - chance)


def connected(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, root): the smallest node reachable over ``links`` (a, b), for every node.

    Labels flow over links and jump to their label's label until nothing changes.
    """
    both = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    touched = both.select(F.col("a").alias("doc_id")).distinct()
    labels = written(touched.select("doc_id", F.col("doc_id").alias("root")), "labels")
    while True:
        came = both.join(labels, both["b"] == labels["doc_id"]).groupBy("a").agg(F.min("root").alias("near"))
        lower = labels.join(came, labels["doc_id"] == came["a"]).select("doc_id", "root", F.least("root", "near").alias("next"))
        jump = labels.select(F.col("doc_id").alias("via"), F.col("root").alias("far"))
        moved = written(
            lower.join(jump, lower["next"] == jump["via"]).select("doc_id", F.least("next", "far").alias("root"), (F.least("next", "far") < F.col("root")).alias("moved")),
            "labels",
        )
        labels = moved.select("doc_id", "root")
        if not moved.filter("moved").limit(1).count():
            break
    return nodes.join(labels, "doc_id", "left").select("doc_id", F.coalesce("root", "doc_id").alias("root"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets meet the threshold."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    met = F.size(F.array_intersect("sa", "sb"))
    return both.filter(100 * met >= percent * (F.size("sa") + F.size("sb") - met)).select("a", "b")


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if column.num_chunks else pa.array([], pa.int64())
    return np.asarray(flat, dtype=np.int64).view(np.uint64).reshape(-1, width)


def block_candidates(table: pa.Table, most: int):
    """For each member of the left block, the members of the right one that may be linked to it:
    of another group, with ``most`` differing lanes at most or a small set, and with no earlier
    band in common (so that a pair is looked at in one bucket only)."""
    ids, root, own, size = (np.asarray(table[c], dtype=np.int64) for c in ("doc_id", "root", "own", "n_shingles"))
    bits, bands = _matrix(table["bits"], HASHES // LANES), _matrix(table["bands"], BANDS)
    p, q, key = table["p"][0].as_py(), table["q"][0].as_py(), np.int64(table["key"][0].as_py()).view(np.uint64)
    odd, one = np.uint64(0x5555555555555555), np.uint64(1)
    right = np.flatnonzero(own == q)
    for i in np.flatnonzero(own == p).tolist():
        x = bits[right] ^ bits[i]
        lanes = np.bitwise_count((x | (x >> one)) & odd).sum(axis=1)
        close = (lanes <= most) | (np.minimum(size[right], size[i]) <= SMALL_SET)
        hit = right[close & (root[right] != root[i]) & ((ids[right] > ids[i]) if p == q else True)]
        if len(hit):
            first = (bands[hit] == bands[i]).argmax(axis=1)
            hit = hit[bands[i][first] == key]
            if len(hit):
                yield i, hit


def dealt_in_blocks(members: DataFrame) -> DataFrame:
    """Members once for each pair of blocks (p, q) that theirs (own) is in."""
    groups = members.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("held"))
    largest = F.max_by(F.struct("root", "n", "held"), F.struct("n", -F.col("root")))
    sizes = groups.groupBy("key").agg(largest.alias("big"), F.sum("n").alias("n"), F.sum("held").alias("held"))

    def blocks(n: Column, held: Column) -> Column:
        return F.greatest(F.ceil(n / float(BLOCK)), F.ceil(held / float(BLOCK_SHINGLES)), F.lit(1)).cast("int")

    counts = sizes.select(
        F.col("key").alias("their_key"), F.col("big.root").alias("big"), blocks(F.col("big.n"), F.col("big.held")).alias("of_big"),
        blocks(F.col("n") - F.col("big.n"), F.col("held") - F.col("big.held")).alias("of_rest"),
    )
    mine = members.join(counts, members["key"] == counts["their_key"]).withColumn("in_big", F.col("root") == F.col("big"))
    number = F.xxhash64("doc_id")
    own = F.when(F.col("in_big"), F.pmod(number, F.col("of_big"))).otherwise(F.col("of_big") + F.pmod(number, F.col("of_rest"))).cast("int")
    others = F.sequence(F.when(F.col("in_big"), F.col("of_big")).otherwise(F.lit(0)), F.col("of_big") + F.col("of_rest") - 1)
    return mine.withColumn("own", own).withColumn("other", F.explode(others)).select(
        "key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "doc_id", "root", "n_shingles", "bits", "bands"
    )


def apart_links(members: DataFrame, sets: DataFrame, least: float, percent: int) -> DataFrame:
    """Links (a, b) between members of a bucket that are in different groups.

    ``members``: key, doc_id, root, n_shingles, bits, bands. A bucket's largest group and the others
    are dealt in blocks of bounded numbers of members and shingles; each pair of blocks is one
    task group. Blocks of the largest group never meet each other, so a bucket of one
    large group and some strays is dealt in rows that grow with its members, not their square.
    Members whose estimates may reach the threshold get their full sets, and are compared where
    they are: a row goes out for each link that joins two groups, not for each pair.
    """
    dealt = dealt_in_blocks(members)
    chance = 1 / (1 << LOW_BITS)
    most = int((1.0 - (least * (1 - chance) + chance)) * HASHES)

    def near(table: pa.Table) -> pa.Table:
        some = np.zeros(table.num_rows, dtype=bool)
        for i, hit in block_candidates(table, most):
            some[i] = some[hit] = True
        return table.filter(pa.array(some))

    def compare(table: pa.Table) -> pa.Table:
        ids = np.asarray(table["doc_id"], dtype=np.int64)
        sets = [np.asarray(s.values, dtype=np.int64) for s in table["shingles"].combine_chunks()] if table.num_rows else []
        size = np.array([len(s) for s in sets])
        group = {int(r): int(r) for r in np.unique(np.asarray(table["root"], dtype=np.int64))}
        root = np.asarray(table["root"], dtype=np.int64).tolist()

        def top(g: int) -> int:
            while group[g] != g:
                group[g] = g = group[group[g]]
            return g

        found = []
        for i, hit in block_candidates(table, most):
            mine = top(root[i])
            hit = np.array([j for j in hit.tolist() if top(root[j]) != mine], dtype=np.int64)
            if not len(hit):
                continue
            values = np.concatenate([sets[j] for j in hit.tolist()])
            at = np.minimum(np.searchsorted(sets[i], values), size[i] - 1)
            met = np.add.reduceat((sets[i][at] == values).astype(np.int64), np.cumsum(size[hit]) - size[hit])
            for j in hit[100 * met >= percent * (size[i] + size[hit] - met)].tolist():
                a, b = top(root[i]), top(root[j])
                if a != b:
                    group[max(a, b)] = min(a, b)
                    found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
        return pa.table({"a": pa.array([x[0] for x in found], pa.int64()), "b": pa.array([x[1] for x in found], pa.int64())})

    schema = "key long, p int, q int, own int, doc_id long, root long, n_shingles long, bits array<long>, bands array<long>"
    wanted = dealt.groupBy("key", "p", "q").applyInArrow(near, schema)
    ordered = sets.select("doc_id", F.sort_array("shingles").alias("shingles"))
    return wanted.join(ordered, "doc_id").groupBy("key", "p", "q").applyInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept.

    Links: ``100 * |A and B| >= percent * |A or B|`` over sets of k-word shingles; texts without
    words are linked with nothing and kept. Rows that repeat an id and text give equal rows. A
    row with a null id takes part like all others, but only ids name a component: one without
    an id in it has a null component_id, and one text of it is kept.
    Empty table: empty result; other columns are not read.
    """
    return _found(docs, k, percent, id_col, text_col).drop("row")


def _found(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """near_duplicates, with the number of each row's id and text as ``row``."""
    doc_id = F.col(id_col).cast("long")
    base = docs.select(doc_id.alias("doc_id"), row_key(doc_id, F.col(text_col)).alias("row"), F.col(text_col).alias("text"))
    signed = written(signatures(base, k), "signatures")
    # Copies fold into their smallest document before anything is compared.
    folded = written(
        signed.filter("digest is not null").groupBy("digest").agg(
            F.coalesce(F.min("doc_id"), F.xxhash64("digest")).alias("doc_id"), F.min("doc_id").alias("named"),
            F.min("row").alias("first_row"), F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"), F.first("bits").alias("bits"),
        ),
        "folded",
    )
    # Sets that no row with an id has go by a hash.
    texts, nameless = base.select("doc_id", "text"), folded.filter("named is null")
    some_nameless = nameless.limit(1).count() > 0
    if some_nameless:
        one = maybe_broadcast(written(nameless.select(F.col("first_row").alias("row"), F.col("doc_id").alias("node")), "nameless"), 48)
        texts = texts.filter("doc_id is not null").union(base.join(one, "row").select("node", "text"))
    rows = folded.select("doc_id", F.explode("bands").alias("key"))
    buckets = written(rows.groupBy("key").agg(F.min("doc_id").alias("pivot"), F.count("*").alias("n")).filter("n > 1").drop("n"), "buckets")
    members = written(rows.join(buckets, "key"), "members")

    bits = folded.select("doc_id", "n_shingles", "bits")
    least = percent / 100 - ESTIMATE_SLACK
    stars = members.filter("doc_id <> pivot").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct()
    close = written(_estimated(stars, bits, least, percent), "star-pairs")
    ids = members.select("doc_id").distinct()
    wanted = written(ids, "member-ids")
    sets = written(full_sets(texts.join(maybe_broadcast(wanted, 32), "doc_id", "left_semi").dropDuplicates(["doc_id"]), k), "sets")
    links = written(confirmed(close, sets, percent), "star-links")
    grouped = written(connected(wanted, links), "grouped")

    apart = members.join(grouped, "doc_id")
    several = apart.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("key")
    marks = folded.select("doc_id", "n_shingles", "bits", "bands")
    rest = apart.join(several, "key", "left_semi").join(marks, "doc_id").select("key", "doc_id", "root", "n_shingles", "bits", "bands")
    more = written(apart_links(rest, sets, least, percent), "block-links")
    roots = connected(grouped.select("doc_id"), links.union(more)) if more.limit(1).count() else grouped

    whole = folded.select("digest", "named", "first_row", F.col("doc_id").alias("first_id")).join(
        roots.select(F.col("doc_id").alias("first_id"), "root"), "first_id", "left"
    ).select("digest", "named", "first_row", "first_id", F.coalesce("root", "first_id").alias("root"))
    if some_nameless:
        # The smallest id of the component, and the row kept where it has none.
        whole = written(whole, "whole")
        names = whole.groupBy("root").agg(F.min("named").alias("component_id"))
        whole = whole.join(names, "root").withColumn("first_row", F.when(F.col("first_id") == F.col("root"), F.col("first_row")))
    else:
        whole = whole.withColumn("component_id", F.col("root"))
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    only = F.col("doc_id").isNotNull() | F.col("digest").isNull() | F.col("row").eqNullSafe(F.col("first_row"))
    return signed.select("doc_id", "row", "n_shingles", "digest").join(
        whole.select("digest", "first_row", F.col("component_id").alias("component")), "digest", "left"
    ).select(
        "doc_id",
        "row",
        "n_shingles",
        component.alias("component_id"),
        (F.col("doc_id").eqNullSafe(component) & only).alias("kept"),
    )


def _estimated(pairs: DataFrame, bits: DataFrame, least: float, percent: int) -> DataFrame:
    """The pairs whose sizes allow a link and whose estimates may reach it, or of small sets."""
    left = bits.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"), F.col("bits").alias("ba"))
    right = bits.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("bits").alias("bb"))
    both = pairs.join(left, "a").join(right, "b").filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    small = F.least("na", "nb") <= SMALL_SET
    return both.filter(small | (estimate(F.col("ba"), F.col("bb")) >= least)).select("a", "b")


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the smallest id of their group, with all their columns; of a group
    without an id, one row."""
    found = written(_found(docs, k, percent, id_col, text_col), "found")
    kept = found.filter("kept")
    key = row_key(docs[id_col].cast("long"), docs[text_col])
    # Rows that go are fewer than those that stay: while they are counted as small, texts do not move.
    gone = written(found.filter("not kept").select(F.col("row").alias("gone_row")).distinct().join(
        kept.select(F.col("row").alias("gone_row")).distinct(), "gone_row", "left_anti"), "gone")
    out = docs.join(maybe_broadcast(gone, 24), key == gone["gone_row"], "left_anti")
    again = kept.filter("doc_id is null and n_shingles > 0").groupBy("row").count().filter("count > 1").select(F.col("row").alias("again_row"))
    if not again.limit(1).count():
        return out
    name = free_name(docs, "row")
    out = out.withColumn(name, row_key(F.col(id_col).cast("long"), F.col(text_col)))
    here = out[name] == again["again_row"]
    once = out.join(again, here, "left_semi").dropDuplicates([name])
    return out.join(again, here, "left_anti").union(once).drop(name)
