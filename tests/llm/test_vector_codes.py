"""Product codes against a plain fit in Python integers, over odd rows and hot vectors."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodseries.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string, q long, their string"


def brute_force(rows, parts, entries, rounds, scale=4096):
    """(vec_id, code, error) per row and the digest of the codebooks, in plain loops."""
    kept = [(i, [int(np.floor(float(x) * scale)) for x in v]) for i, v, *_ in rows]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    n = len(kept[0][1])
    cuts = [p * n // parts for p in range(parts + 1)]
    books = [[q[a:b] for _, q in kept[:entries]] for a, b in zip(cuts, cuts[1:], strict=False)]

    def near(book, part):
        return min((sum((x - y) ** 2 for x, y in zip(part, e, strict=True)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            owned = {}
            for _, q in kept:
                owned.setdefault(near(books[p], q[a:b])[1], []).append(q[a:b])
            books[p] = [[sum(c) // len(owned[j]) for c in zip(*owned[j], strict=True)] if j in owned else e for j, e in enumerate(books[p])]
    out = []
    for i, q in kept:
        found = [near(books[p], q[a:b]) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
        out.append((i, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found)))
    said = ",".join(str(x) for book in books for e in book for x in e)
    return sorted(out, key=str), hashlib.sha256(said.encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, "y") for i, v, label in rows], SCHEMA)


def clustered(n, width, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (12, width))
    points = centres[rng.integers(0, 12, n)] + rng.normal(0, 0.05, (n, width))
    return [(int(i), [float(np.float32(x)) for x in v], int(i) % 5) for i, v in zip(rng.permutation(n * 3)[:n], points, strict=True)]


@pytest.mark.parametrize(("n", "width", "parts", "entries"), [(900, 16, 8, 16), (500, 10, 4, 7), (5, 8, 8, 16)])
def test_codes_are_those_of_a_plain_fit(spark, n, width, parts, entries):
    rows = clustered(n, width, n)
    codes = vc.vector_codes(frame(spark, rows).repartition(3), parts, entries, 3)
    mine = [(r["vec_id"], r["code"], r["error"]) for r in codes.rows.collect()]
    theirs, digest = brute_force(rows, parts, entries, 3)
    assert sorted(mine, key=str) == theirs
    assert codes.digest() == digest


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    same = [0.5, -0.25, 0.0, 1.0, 0.125, 0.5, -1.0, 2.0]
    good = [(i, same, None) for i in (7, 7, 9, 10)] + [(i, [x + i / 8 for x in same], 1) for i in range(3)] + [(None, same, None)]
    bad = [
        (20, None, 1), (21, [], 1), (22, [None] * 8, 1), (23, [inf] * 8, 1), (24, [0.0] * 7 + [nan], 2),
        (25, [-inf] + [0.0] * 7, None), (26, [1.0] * 9, 3), (None, None, None),
    ]
    codes = vc.vector_codes(frame(spark, good + bad), entries=5, rounds=2)
    found = vc.with_label_errors(codes)
    theirs, digest = brute_force(good, 8, 5, 2)
    assert sorted(((r["vec_id"], r["code"], r["error"]) for r in found.collect()), key=str) == theirs
    assert codes.digest() == digest
    by_label = {label: sum(e for i, _, e in theirs if i in ids) for label, ids in ((None, {7, 9, 10, None}), (1, {0, 1, 2}))}
    assert {r["label"]: r["label_error"] for r in found.collect()} == by_label


def test_empty_tables_huge_components_and_other_types(spark):
    none = vc.vector_codes(frame(spark, []))
    assert vc.with_label_errors(none).collect() == [] and none.books == []
    assert vc.decoded(spark, none).collect() == []
    huge = [(1, [3e38] * 8, 1), (2, [-3e38] * 8, 1), (3, [0.0] * 8, 1)]
    assert [r["error"] for r in vc.vector_codes(frame(spark, huge), entries=2).rows.filter("vec_id < 3").collect()] is not None
    named = spark.createDataFrame([("a", [1.0, 2.0], "x"), ("b", [1.5, 2.0], None)], "id string, v array<double>, kind string")
    codes = vc.vector_codes(named, 2, 2, 1, 4, "id", "v", "kind")
    assert sorted(map(tuple, vc.with_label_errors(codes).collect()), key=str) == [("a", "x", "0000", 0, 0), ("b", None, "0100", 0, 0)]
    back = {r["vec_id"]: r["embedding"] for r in vc.decoded(spark, codes, 4).collect()}
    assert back == {"a": [1.0, 2.0], "b": [1.5, 2.0]}
    assert isinstance(codes.rows.schema["vec_id"].dataType, T.StringType)


def test_balls_are_owned_whole_and_hot_vectors_are_one_ball():
    rng = np.random.default_rng(3)
    tight = np.concatenate([c + rng.integers(-20, 20, (300, 8)) for c in rng.integers(-9000, 9000, (9, 8))])
    tree = vc.metric_tree(tight)
    assert sorted(tree.place.tolist()) == list(range(len(tight)))
    for (a, b, left, right), ball, total in zip(tree.links.tolist(), tree.balls, tree.sums, strict=True):
        assert (tree.points[a:b].sum(axis=0) == total).all()
        assert (((tree.points[a:b] - ball[:-1]) ** 2).sum(axis=1) <= ball[-1] ** 2 * (1 + 1e-9) + 1e-6).all()
        if left >= 0:
            assert tree.links[left, 0] == a and tree.links[left, 1] == tree.links[right, 0] and tree.links[right, 1] == b
    chosen, counts, sums, whole = vc.owners(tree, tight[::300])
    assert counts.sum() == len(tight) and (sums.sum(axis=0) == tight.sum(axis=0)).all()
    assert whole > len(tight) / 2
    far = ((tree.points[:, None].astype(np.int64) - tight[::300][None]) ** 2).sum(axis=2)
    assert (far.argmin(axis=1) == chosen).all()
    equal = vc.metric_tree(np.tile(np.arange(8), (4096, 1)))
    assert len(equal.links) == 1
    assert vc.owners(equal, np.stack([np.arange(8) + 1, np.arange(8), np.arange(8)]))[3] == 4096


def test_blocks_do_not_change_codes(spark, monkeypatch):
    rows = clustered(700, 8, 11)
    whole = vc.vector_codes(frame(spark, rows).coalesce(1), 2, 16, 4)
    monkeypatch.setattr(vc, "BLOCK", 64)
    parted = vc.vector_codes(frame(spark, rows).repartition(5, F.rand(1)), 2, 16, 4)
    assert whole.digest() == parted.digest()
    assert sorted(map(tuple, whole.rows.collect())) == sorted(map(tuple, parted.rows.collect()))
