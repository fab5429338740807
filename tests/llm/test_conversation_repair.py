"""Conversation repair against an enumeration of all edits, a plain recursion, and odd rows."""

import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from prodseries.llm import conversation_repair as cr
from prodseries.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, audit string, part int, key string"
PATTERN = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """Each row's first fault: blank, duplicate, truncated or none."""
    seen, out = set(), []
    for role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def by_enumeration(rows):
    """(cost, audit) over all edits, with up to two inserts in a place."""
    inserts = [x for n in range(3) for x in itertools.product("ua", repeat=n)]
    best = None
    edits = []
    for (role, _), fault in zip(rows, faults(rows), strict=True):
        more = 5 * (fault == "truncated")
        own = [("D", 2, "")]
        if fault not in ("blank", "duplicate"):
            own += [("K", more, role[:1] or "?"), ("R", 1 + more, "u"), ("R", 1 + more, "a")]
        edits.append(own)
    for chosen in itertools.product(*edits):
        for put in itertools.product(inserts, repeat=len(rows) + 1):
            initials = "".join("".join(p) + e[2] for p, e in zip(put, [*chosen, ("", 0, "")], strict=True))
            if PATTERN.fullmatch(initials):
                cost = sum(e[1] for e in chosen) + 5 * sum(map(len, put))
                audit = "".join("I" * len(p) + e[0] for p, e in zip(put, [*chosen, ("", 0, "")], strict=True))
                best = min(best or (cost, audit), (cost, audit))
    return best


def by_recursion(rows):
    """(cost, audit): the least pair from every place and state, one edit at a time."""
    kinds = list(zip([r[:1] for r, _ in rows], faults(rows), strict=True))
    keep = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    other = {"": "u", "s": "u", "u": "a", "a": "u"}

    @cache
    def least(i, state, inserts):
        options = []
        if i == len(kinds):
            if state in ("", "a"):
                options.append((0, ""))
        else:
            initial, fault = kinds[i]
            more = 5 * (fault == "truncated")
            steps = [("D", 2, state)]
            if fault not in ("blank", "duplicate"):
                steps.append(("R", 1 + more, other[state]))
                if (state, initial) in keep:
                    steps.append(("K", more, keep[state, initial]))
            options += [(c + x, e + s) for e, c, to in steps for x, s in [least(i + 1, to, 0)]]
        if inserts < 3:
            x, s = least(i, other[state], inserts + 1)
            options.append((5 + x, "I" + s))
        return min(options, default=(10**9, ""))

    return least(0, "", 0)


def replayed(rows, audit):
    """The repaired lines that an audit stands for."""
    out, left = [], list(rows)
    for e in audit:
        role, text = (None, "") if e == "I" else left.pop(0)
        if e == "D":
            continue
        if e in "IR":
            role = "assistant" if out and out[-1][0][:1] == "u" else "user"
        out.append((role, text))
    assert not left
    assert PATTERN.fullmatch("".join(r[:1] for r, _ in out))
    return out


def expected(rows, repair=by_recursion):
    """The row of a conversation: ``rows`` are (turn, role, text), sorted."""
    pairs = [(r, t) for _, r, t in rows]
    found = faults(pairs)
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit = repair(pairs)
    lines = "\n".join(f"{r}:{t}" for r, t in replayed(pairs, audit))
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(pairs))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest())


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        n = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if n == 1:
            text = ""
        elif n == 2:
            text = re.sub(r"[.!?]", "", text)
        elif n == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if n == 0 else 2 if n == 3 else 1)
    return out


def by_conversation(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, v in out.items()}


def collected(frame):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r[0]: tuple(r)[1:] for r in frame.select(*names).collect()}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def random_rows(rng, n):
    roles = ["system", "user", "assistant", "tool", "", "s", "User"]
    texts = ["Well.", "no end", "", " \t\n", "What?", "A b\n", "Same!", "é。", "a.b"]
    return [(rng.choices(roles, [2, 6, 6, 1, 1, 1, 1])[0], rng.choices(texts, [6, 2, 1, 1, 4, 1, 2, 1, 1])[0]) for _ in range(n)]


def test_edits_are_the_least_of_all():
    rng = random.Random(5)
    for n in (0, 1, 2, 2, 2, 2, 3, 3):
        rows = random_rows(rng, n)
        assert by_enumeration(rows) == by_recursion(rows)
    for n in [*range(12)] * 60:
        rows = random_rows(rng, n)
        mine = cr._repaired([None] * n, *map(list, zip(*rows, strict=True))) if rows else cr._repaired([], [], [])
        assert tuple(mine[:8]) == expected([(None, *r) for r in rows])
        assert list(zip(mine[9], mine[10], strict=True)) == replayed(rows, mine[6])


def test_checkpoints_change_nothing():
    rng = random.Random(6)
    for n in (1, 2, 3, 4, 5, 15, 16, 17, 99, 100, 101, 600):
        rows = [(r, f"{t} {i}." if t == "Well." else t) for i, (r, t) in enumerate(random_rows(rng, n))]
        kinds = bytes(cr._marked(cr.kinds_of(*map(list, zip(*rows, strict=True))), cr._copies(*map(list, zip(*rows, strict=True)))))
        said, state = zip(*cr.walked(kinds, cr.END, cr.NOTHING), strict=True)
        cost, audit = by_recursion(rows)
        assert "".join(said) + cr.closing(state[-1]) == audit
        vector, total = cr.back_over(kinds, cr.END)
        assert total + vector[cr.NOTHING] == cost


def test_query_on_the_smallest_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    left = by_conversation(damage(rows))
    want = {c: expected(left.get(c, [])) for c in {r[0] for r in rows}}
    assert collected(QUERIES["op13_conversation_repair"](spark, SF)) == want


@pytest.mark.parametrize("width", [1, 3, 40])
def test_conversations_over_several_ranges(spark, width):
    """One conversation has most rows, among them many equal ones in one turn; others have few."""
    rng = random.Random(width)
    rows = [(7, t // 3 if t % 10 else None, r, f"{x} {t % 90}." if x == "Well." else x) for t, (r, x) in enumerate(random_rows(rng, 900))]
    rows += [(7, 50, "user", "The same.")] * 150
    rows += [(c, t, r, x) for c in range(20, 60) for t, (r, x) in enumerate(random_rows(rng, rng.randrange(1, 9)))]
    rows += [(None, 1, "user", "Hello."), (None, None, None, None), (None, 1, "assistant", "Hello."), (3, None, "user", None)]
    # Joins turn into broadcasts only at run time, which takes the deal by key from their results.
    settings = {"spark.sql.shuffle.partitions": width, "spark.sql.autoBroadcastJoinThreshold": -1, "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        repairs = cr.repaired(frame(spark, rows).repartition(5))
        found = collected(repairs.conversations)
        lines = repairs.rows.orderBy("part", "place").collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    want = by_conversation(rows)
    import sys
    sys.setrecursionlimit(10_000)
    assert found == {c: expected(v) for c, v in want.items()}
    for c, v in want.items():
        assert [(r["role"], r["text"]) for r in lines if r["conv_id"] == c] == replayed([(r, t) for _, r, t in v], found[c][6])


def test_empty_tables_dropped_conversations_and_nulls(spark):
    assert cr.repaired(frame(spark, [])).conversations.collect() == []
    assert collected(cr.for_every_conversation(frame(spark, []), cr.repaired(cr.damaged(frame(spark, []))))) == {}
    rows = [(c, 0, "user", "One.") for c in range(60)] + [(None, None, None, None), (None, 2, "user", "Long " * 50_000 + ".")]
    mine = collected(cr.for_every_conversation(frame(spark, rows), cr.repaired(cr.damaged(frame(spark, rows)))))
    left = by_conversation(damage(rows))
    assert mine == {c: expected(left.get(c, [])) for c in [*range(60), None]}
    gone = [c for c in range(60) if c not in left]
    assert gone and all(mine[c] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in gone)


def test_damage(spark):
    rows = [(c, t, "assistant", "Yes! No? Well.") for c in range(9) for t in range(9)] + [(None, None, None, None)]
    mine = cr.damaged(frame(spark, rows)).select("conv_id", "turn", "role", "text").orderBy(F.asc_nulls_last("conv_id"), "turn").collect()
    assert list(map(tuple, mine)) == damage(rows)
