"""Product codes of vectors, fitted over metric trees.

Vectors become integers and are cut into equal parts; each part has a codebook that a few rounds
of assigning and averaging fit exactly. Rows are dealt to blocks where they are read, and each
part of a block gets a metric tree by the anchors hierarchy: about sqrt(n) anchors take the
points nearest to them (a new anchor starts at the point farthest from its own and only looks at
points that can be nearer to it), anchors are merged upwards into balls that stay small, and
each anchor's own points are treated alike downwards. A ball keeps the count and sum of its
points. In a round a ball inherits the list of entries that may still own points of it, drops
those that are farther than another one from every point of the ball, and is added whole once
one entry is left; only balls that no entry owns are opened, and single points are compared at
the leaves. All sums are of integers, so results do not depend on blocks or trees.

Trees are written once to the shared folder and read in every round. What goes to the driver is
one row per entry and component, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodseries.llm.common import maybe_broadcast, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
# Rows of a block, and points that a ball is not split below.
BLOCK, LEAF = 4096, 32
_FIELDS = ["points", "place", "links", "balls", "sums"]


class Tree(NamedTuple):
    """Points in tree order, their rows, and per ball: first and last place and children (-1:
    a leaf), centre and radius, sum of points. The first ball is the root."""

    points: np.ndarray
    place: np.ndarray
    links: np.ndarray
    balls: np.ndarray
    sums: np.ndarray


def anchors(points: np.ndarray, most: int) -> np.ndarray:
    """The anchor that each point is nearest to, among at most ``most``."""
    away = points - points.mean(axis=0)
    pivots = [int((away * away).sum(axis=1).argmax())]
    away = points - points[pivots[0]]
    far = (away * away).sum(axis=1)
    owner = np.zeros(len(points), dtype=np.int64)
    while len(pivots) < most:
        new = int(far.argmax())
        if far[new] == 0:
            break
        gap = points[pivots] - points[new]
        # A point nearer to its anchor than half way to the new one stays.
        near = np.flatnonzero(4 * far >= (gap * gap).sum(axis=1)[owner])
        away = points[near] - points[new]
        there = (away * away).sum(axis=1)
        stolen = there < far[near]
        far[near[stolen]] = there[stolen]
        owner[near[stolen]] = len(pivots)
        pivots.append(new)
    return owner


def _merged(points: np.ndarray, groups: list[np.ndarray]) -> list:
    """The groups as a nested pair tree: the two balls whose union is smallest merge first."""
    size = np.array([len(g) for g in groups], dtype=float)
    centre = np.stack([points[g].mean(axis=0) for g in groups])
    radius = np.array([np.sqrt(((points[g] - c) ** 2).sum(axis=1).max()) for g, c in zip(groups, centre, strict=True)])
    gap = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(axis=2))
    cost = gap + radius[:, None] + radius[None]
    np.fill_diagonal(cost, np.inf)
    trees: list = list(groups)
    for _ in range(len(groups) - 1):
        i, j = divmod(int(cost.argmin()), len(trees))
        i, j = min(i, j), max(i, j)
        trees[i] = (trees[i], trees[j])
        apart = np.sqrt(((centre[i] - centre[j]) ** 2).sum())
        radius[i] = max(radius[i], radius[j], (apart + radius[i] + radius[j]) / 2)
        centre[i] = (size[i] * centre[i] + size[j] * centre[j]) / (size[i] + size[j])
        size[i] += size[j]
        row = np.sqrt(((centre - centre[i]) ** 2).sum(axis=1)) + radius + radius[i]
        cost[i] = np.where(np.isinf(cost[i]), np.inf, row)
        cost[:, i] = cost[i]
        cost[j] = cost[:, j] = np.inf
    return trees[0]


def _grown(points: np.ndarray, rows: np.ndarray):
    """Nested pairs down to leaves (arrays of rows), middle-out."""
    here = points[rows]
    if len(rows) <= LEAF or (here == here[0]).all():
        return rows
    owner = anchors(here, isqrt(len(rows) - 1) + 1)
    groups = [rows[owner == a] for a in range(int(owner.max()) + 1)]
    groups = [g for g in groups if len(g)]
    if len(groups) == 1:
        return rows
    below = {id(g): _grown(points, g) for g in groups}

    def filled(node):
        return below[id(node)] if isinstance(node, np.ndarray) else (filled(node[0]), filled(node[1]))

    return filled(_merged(points, groups))


def metric_tree(points: np.ndarray) -> Tree:
    """The tree over ``points`` (rows of integers)."""
    floats = points.astype(np.float64)
    links: list[list[int]] = []
    place: list[np.ndarray] = []
    held = 0
    # (node, parent, side); a ball is numbered before those inside it.
    todo = [(_grown(floats, np.arange(len(points))), -1, 0)]
    while todo:
        node, parent, side = todo.pop()
        number = len(links)
        if parent >= 0:
            links[parent][side] = number
        if isinstance(node, tuple):
            links.append([held, 0, -1, -1])
            todo += [(node[1], number, 3), (node[0], number, 2)]
        else:
            place.append(node)
            links.append([held, held + len(node), -1, -1])
            held += len(node)
    for link in reversed(links):
        if link[3] >= 0:
            link[1] = links[link[3]][1]
    table = np.array(links, dtype=np.int32)
    order = np.concatenate(place).astype(np.int32)
    points = points[order]
    done = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points, axis=0, dtype=np.int64)])
    sums = done[table[:, 1]] - done[table[:, 0]]
    centre = sums / (table[:, 1] - table[:, 0])[:, None]
    radius = np.empty(len(table))
    for i, (a, b) in enumerate(table[:, :2].tolist()):
        away = points[a:b] - centre[i]
        radius[i] = np.sqrt((away * away).sum(axis=1).max()) if points.shape[1] else 0.0
    return Tree(points.astype(np.int32), order, table, np.concatenate([centre, radius[:, None]], axis=1), sums)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    done = np.cumsum(lengths)
    return np.repeat(starts - (done - lengths), lengths) + np.arange(done[-1] if len(done) else 0)


def owners(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The entry nearest to each point in tree order (the lower one of equals), each entry's
    number and sum of points, and the points that were added with a ball that one entry owns."""
    k = len(book)
    entries = book.astype(np.float64)
    gaps = np.sqrt(((entries[:, None] - entries[None]) ** 2).sum(axis=2))
    chosen = np.empty(len(tree.points), dtype=np.int64)
    counts, sums = np.zeros(k, dtype=np.int64), np.zeros(book.shape, dtype=np.int64)
    whole = 0
    # An entry equal to a lower one owns nothing.
    listed = np.array([[not (book[:e] == book[e]).all(axis=1).any() for e in range(k)]])
    at = np.zeros(1, dtype=np.int64)
    while len(at):
        ball = tree.balls[at]
        far = ((ball[:, None, :-1] - entries[None]) ** 2).sum(axis=2)
        best = np.where(listed, far, np.inf).argmin(axis=1)
        rows = np.arange(len(at))
        least = far[rows, best][:, None]
        # Farther from each point of the ball than the best one, beyond what rounding can do.
        listed &= ~(far - least > 2 * ball[:, -1:] * gaps[best] * (1 + 1e-9) + 1e-9 * (far + least) + 1e-6)
        alone = listed.sum(axis=1) == 1
        own, entry = at[alone], best[alone]
        start, stop = tree.links[own, 0].astype(np.int64), tree.links[own, 1].astype(np.int64)
        size = stop - start
        chosen[_ranges(start, size)] = np.repeat(entry, size)
        np.add.at(counts, entry, size)
        np.add.at(sums, entry, tree.sums[own])
        whole += int(size.sum())
        leaf = ~alone & (tree.links[at, 2] < 0)
        start, stop = tree.links[at[leaf], 0].astype(np.int64), tree.links[at[leaf], 1].astype(np.int64)
        if len(start):
            some = _ranges(start, stop - start)
            points = tree.points[some].astype(np.int64)
            off = points[:, None] - book[None]
            near = np.where(np.repeat(listed[leaf], stop - start, axis=0), (off * off).sum(axis=2), np.iinfo(np.int64).max).argmin(axis=1)
            chosen[some] = near
            counts += np.bincount(near, minlength=k)
            np.add.at(sums, near, points)
        inner = ~alone & ~leaf
        listed = np.repeat(listed[inner], 2, axis=0)
        at = tree.links[at[inner], 2:].astype(np.int64).ravel()
    return chosen, counts, sums, whole


def _cuts(width: int, parts: int) -> list[int]:
    """Where each part starts (and the end): equal parts where the width allows it."""
    return [i * width // parts for i in range(parts + 1)]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), width)


def _packed(tree: Tree) -> list[bytes]:
    kinds = (np.int32, np.int32, np.int32, np.float64, np.int64)
    return [np.ascontiguousarray(a.astype(t)).tobytes() for a, t in zip(tree, kinds, strict=True)]


def _tree(cells: list[bytes], width: int) -> Tree:
    points, place, links, balls, sums = cells
    return Tree(
        np.frombuffer(points, np.int32).reshape(-1, width) if width else np.zeros((len(place) // 4, 0), np.int32),
        np.frombuffer(place, np.int32),
        np.frombuffer(links, np.int32).reshape(-1, 4),
        np.frombuffer(balls, np.float64).reshape(-1, width + 1),
        np.frombuffer(sums, np.int64).reshape(len(links) // 16, width),
    )


def _lists(column: pa.Array) -> pa.Array:
    """The whole column as the one list of a row."""
    return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)


def _blocks(vectors: DataFrame, width: int, parts: int) -> DataFrame:
    """One row per block: ids, labels and the parts' trees."""
    cuts = _cuts(width, parts)
    schema = T.StructType(
        [
            T.StructField("ids", T.ArrayType(vectors.schema["vec_id"].dataType)),
            T.StructField("labels", T.ArrayType(vectors.schema["label"].dataType)),
            *[T.StructField(f, T.ArrayType(T.BinaryType())) for f in _FIELDS],
        ]
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                some = batch.slice(a, BLOCK)
                q = _matrix(some.column(2), width)
                trees = [_packed(metric_tree(q[:, i:j])) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [_lists(some.column(0)), _lists(some.column(1)), *[pa.array([list(cells)], pa.list_(pa.binary())) for cells in zip(*trees, strict=True)]],
                    names=["ids", "labels", *_FIELDS],
                )

    return written(vectors.mapInArrow(build, schema), "metric-trees")


def _trees_of(batch: pa.RecordBatch, row: int, cuts: list[int]) -> list[Tree]:
    cells = [batch.column(batch.schema.get_field_index(f))[row].as_py() for f in _FIELDS]
    return [_tree(list(part), j - i) for part, i, j in zip(zip(*cells, strict=True), cuts[:-1], cuts[1:], strict=True)]


def _next_books(blocks: DataFrame, books: list[np.ndarray], cuts: list[int]) -> list[np.ndarray]:
    """Each entry's average over the parts it owns, rounded down; unused entries stay."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), dtype=np.int64) for b in books]
        sums = [np.zeros(b.shape, dtype=np.int64) for b in books]
        for batch in batches:
            for row in range(batch.num_rows):
                for p, tree in enumerate(_trees_of(batch, row, cuts)):
                    _, n, s, _ = owners(tree, books[p])
                    counts[p] += n
                    sums[p] += s
        rows = [
            (p, e, c, int(v))
            for p, (n, s) in enumerate(zip(counts, sums, strict=True))
            for e in range(len(n))
            if n[e]
            for c, v in enumerate([n[e], *s[e]])
        ]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)],
                names=["part", "entry", "cell", "v"],
            )

    each = blocks.select(*_FIELDS).mapInArrow(add, "part int, entry int, cell int, v long")
    sums = each.groupBy("part", "entry", "cell").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    cells = {(r["part"], r["entry"], r["cell"]): int(r["v"]) for r in sums}
    out = []
    for p, book in enumerate(books):
        new = book.copy()
        for e in range(len(book)):
            if n := cells.get((p, e, 0)):
                new[e] = [cells[p, e, c + 1] // n for c in range(book.shape[1])]
        out.append(new)
    return out


def _coded(blocks: DataFrame, books: list[np.ndarray], cuts: list[int], schema: T.StructType) -> DataFrame:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                trees = _trees_of(batch, row, cuts)
                n = len(trees[0].place)
                codes, errors = np.zeros((n, len(trees)), dtype=np.uint8), np.zeros(n, dtype=np.int64)
                for p, tree in enumerate(trees):
                    chosen = owners(tree, books[p])[0]
                    off = tree.points.astype(np.int64) - books[p][chosen]
                    codes[tree.place, p] = chosen
                    errors[tree.place] += (off * off).sum(axis=1)
                said = codes.tobytes().hex()
                width = 2 * len(trees)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[row].values,
                        batch.column(1)[row].values,
                        pa.array([said[i * width : (i + 1) * width] for i in range(n)], pa.string()),
                        pa.array(errors),
                    ],
                    names=["vec_id", "label", "code", "error"],
                )

    return blocks.mapInArrow(code, schema)


class Codes(NamedTuple):
    """Per kept vector vec_id, label, code, error; and the parts' codebooks."""

    rows: DataFrame
    books: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all entries' components, by part, entry and position."""
        said = ",".join(str(int(x)) for book in self.books for x in book.ravel())
        return hashlib.sha256(said.encode()).hexdigest()


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
                 id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> Codes:
    """Codes of all vectors without a null or non-finite component.

    A component x counts as floor(scale * x). Codebooks start as the parts of the ``entries``
    vectors with the smallest ids (null ids last, equal ids by their components); with fewer
    vectors they have fewer entries. Each round assigns every part to the nearest entry (of
    equals the lower) and replaces entries by floor(sum / count); entries without parts stay.
    ``error`` is the squared distance to the entries, summed over parts.

    Rows are rows: repeated ids and vectors are coded one by one, null ids and labels are kept.
    Vectors whose length is not the commonest one (the longer of equals) cannot share the
    codebooks and are dropped; where the length is no multiple of ``parts`` some parts are
    longer by one. Components are held to what squared distances in a long allow (2^27 in
    units of 1 / scale for 64 components). Empty table: empty result and codebooks; other
    columns are not read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits: 1 to 256 entries")
    spark = vectors.sparkSession
    raw = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    fit = raw.filter(F.col("v").isNotNull() & F.forall("v", _finite))
    widths = fit.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    width = widths[0]["width"] if widths else 0
    most = float(min(1 << 27, isqrt((1 << 62) // max(width, 1)) // 2))
    held = F.transform("v", lambda x: F.floor(F.greatest(F.least(x.cast("double") * float(scale), F.lit(most)), F.lit(-most))).cast("long"))
    kept = fit.filter(F.size("v") == width).select("vec_id", "label", held.alias("q"))
    schema = T.StructType([kept.schema["vec_id"], kept.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if not widths:
        return Codes(spark.createDataFrame([], schema), [])
    cuts = _cuts(width, parts)
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "q").limit(entries).select("q").collect()
    seeds = np.array([r["q"] for r in first], dtype=np.int64).reshape(len(first), width)
    books = [seeds[:, i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
    blocks = _blocks(kept, width, parts)
    for _ in range(rounds):
        books = _next_books(blocks, books, cuts)
    return Codes(_coded(blocks, books, cuts, schema), books)


def _finite(x: Column) -> Column:
    value = x.cast("double")
    return F.coalesce(~F.isnan(value) & (F.abs(value) < float("inf")), F.lit(False))


def with_label_errors(codes: Codes) -> DataFrame:
    """The rows with label_error, the error summed over equal labels (nulls together)."""
    rows = written(codes.rows, "vector-codes")
    sums = written(rows.groupBy(F.col("label").alias("their")).agg(F.sum("error").alias("label_error")), "label-errors")
    sums = maybe_broadcast(sums, 64)
    return rows.join(sums, rows["label"].eqNullSafe(sums["their"])).drop("their")


def decoded(spark: SparkSession, codes: Codes, scale: int = SCALE) -> DataFrame:
    """(vec_id, embedding): the vectors that the codes stand for."""
    books = [[[float(x) / scale for x in entry] for entry in book.tolist()] for book in codes.books]
    parts = [
        F.element_at(F.array([F.array([F.lit(x) for x in entry]).cast("array<double>") for entry in book]),
                     F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int") + 1)
        for p, book in enumerate(books)
    ]
    return codes.rows.select("vec_id", (F.concat(*parts) if parts else F.array().cast("array<double>")).alias("embedding"))
