"""Recompression against all windows held in memory, and what its symbols promise."""

import random

import numpy as np
import pyarrow as pa
import pytest

from prodseries.llm import recompression as rc
from prodseries.llm.hashing import mixed
from tests.llm.odd import LONG, ROWS, no_documents, odd_documents


def by_brute_force(texts, width=rc.WIDTH):
    """(doc_id, n_words, kept words) for pairs of id and text; null ids take no part."""
    words = [(i, [w for w in (t or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]) for i, t in texts]
    least = {}
    for i, w in words:
        for at in range(len(w) - width + 1) if i is not None else ():
            key = tuple(w[at : at + width])
            least[key] = min(i, least.get(key, i))
    out = []
    for i, w in words:
        gone = set()
        for at in range(len(w) - width + 1) if i is not None else ():
            if least[tuple(w[at : at + width])] < i:
                gone.update(range(at, at + width))
        out.append((i, len(w), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=str)


def found(frame):
    return sorted(((r["doc_id"], r["n_words"], r["kept"]) for r in frame.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def repeats(seed, n=60):
    """Texts that share passages, runs of one word, periods, and near copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.choice([12, 13, 14, 30, 80]))] for _ in range(12)]
    passages += [["la"] * 40, ["na"] * 13, ["a", "b"] * 30, ["x", "y", "z"] * 9]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(0, 6)):
            own = list(rng.choice(passages))
            if rng.random() < 0.3:
                own[rng.randrange(len(own))] = f"edit{rng.randrange(1000)}"
            parts += own + [f"u{rng.randrange(10**9)}" for _ in range(rng.randrange(0, 5))]
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(parts)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("shard_bytes", [1 << 21, 1500])
def test_removes_what_all_windows_say(spark, seed, shard_bytes):
    rows = repeats(seed)
    assert found(rc.without_repeats(frame(spark, rows), shard_bytes=shard_bytes)) == by_brute_force(rows)


def test_odd_rows(spark):
    mine = found(rc.without_repeats(odd_documents(spark)))
    assert mine == by_brute_force(ROWS)
    assert rc.without_repeats(no_documents(spark)).collect() == []
    assert rc.without_repeats(odd_documents(spark)).columns == ["doc_id", "n_words", "n_removed", "spans", "kept"]


def test_spans_are_what_went(spark):
    rows = repeats(9)
    words = {i: t.split() for i, t in rows}
    for r in rc.without_repeats(frame(spark, rows)).collect():
        spans = list(zip(r["spans"][::2], r["spans"][1::2], strict=True))
        assert sum(b - a for a, b in spans) == r["n_removed"]
        gone = {p for a, b in spans for p in range(a, b)}
        assert r["kept"] == " ".join(w for p, w in enumerate(words[r["doc_id"]]) if p not in gone)


def test_a_text_with_most_of_all_copies(spark):
    many = [(i, "one text that has more copies than fit a shard and a tail of its own") for i in range(400)]
    rows = many + [(1000 + i, f"{LONG[:300]} {i}") for i in range(20)]
    assert found(rc.without_repeats(frame(spark, rows), shard_bytes=2000)) == by_brute_force(rows)


def lot_of(words):
    w = mixed(np.array(words, dtype=np.uint64))
    return rc.Lot(np.zeros(1, np.int64), np.zeros(1, np.int64), w, np.zeros(len(w), np.int64), np.array([0, len(w)]))


def test_equal_windows_have_equal_marks_and_equal_names_equal_words():
    rng = np.random.default_rng(4)
    shared = rng.integers(0, 9, 200).tolist()
    marks, names = {}, {}
    for _ in range(50):
        a, b = sorted(rng.integers(0, 200, 2).tolist())
        words = [*rng.integers(0, 9, 7).tolist(), *shared[a:b], *[3] * int(rng.integers(0, 30)), *rng.integers(0, 9, 20).tolist()]
        lot = lot_of(words)
        best, long, hashes = rc.parsed(lot)
        for at in lot.windows().tolist():
            assert marks.setdefault(tuple(words[at : at + rc.WIDTH]), best[at]) == best[at]
        for name, x, y in zip(hashes.long(long.start, long.stop).tolist(), long.start.tolist(), long.stop.tolist(), strict=True):
            assert y - x >= rc.WIDTH
            assert names.setdefault(name, tuple(words[x:y])) == tuple(words[x:y])
    assert len(set(marks.values())) > 100


def test_runs_and_pairs():
    words = np.array([5, 5, 5, 7, 5, 5], dtype=np.uint64)
    s = rc.runs_named(rc.words_as_symbols(words, np.array([0, 0, 0, 0, 0, 1])))
    assert s.start.tolist() == [0, 3, 4, 5] and s.stop.tolist() == [3, 4, 5, 6]
    assert s.name[2] == s.name[3] == 5 != s.name[0]
    assert s.left[0] < 0 and s.right[0] == 4 and s.right[2] > 6
    lone = rc.pairs_named(rc.words_as_symbols(mixed(np.arange(300, dtype=np.uint64)), np.zeros(300, np.int64)), 1)
    assert set((lone.stop - lone.start).tolist()) == {1, 2}
    assert (lone.start[1:] == lone.stop[:-1]).all()


def test_long_texts_come_in_stretches(monkeypatch):
    text = " ".join(f"w{i % 211}x{i % 7}" for i in range(3000)).encode()
    whole = {(int(p), int(m)) for lot in rc.lots([text]) for p, m in zip(lot.place(lot.windows())[1], rc.parsed(lot)[0][lot.windows()], strict=True)}
    monkeypatch.setattr(rc, "LOT", 100)
    lots = list(rc.lots([text, b"short one", text]))
    assert max(len(lot.words) for lot in lots) < 300
    parts = [(int(d), int(p), int(m)) for lot in lots for d, p, m in zip(*lot.place(lot.windows()), rc.parsed(lot)[0][lot.windows()], strict=True)]
    assert len(parts) == len(set(parts)) == 2 * len(whole)
    assert {(p, m) for d, p, m in parts if d == 2} == whole


def test_shards_without_rows():
    none = pa.table({"shard": pa.array([], pa.int64()), "doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())})
    assert rc.shard_windows(none, none, 3).num_rows == 0
    assert rc.cleared(none, none).num_rows == 0
