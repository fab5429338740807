"""Repair of conversation structure by the cheapest edits.

A conversation should read as an optional system row, then user and assistant rows in turn. What
is left to do from a row on costs the same whatever came before, but for one of four states, so
a backward pass gives each row a vector of four costs, and a forward walk takes, of the edits
that are tight against these vectors, the ASCII-least. Vectors are stored only at checkpoints, a
square root of the rows apart; the walk recomputes one block of them at a time.

Rows are range-partitioned and sorted by conversation and turn, and each task repairs the
conversations that lie inside its range where they stand. The first and the last one of a range may go
on in its neighbours. They come out as runs (at most two for each range, and however
many a very long conversation fills), and are repaired across tasks: each run gives the costs
between its four states as a matrix, matrices composed from the end give the vector behind each
run, each run then tells where it leads from each state, and once these are composed from the
start every run is walked alone. So a conversation with a third of all rows is no one's group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import inf, isqrt
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prodseries.llm.common import maybe_broadcast, partitions, written

BLANKS = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5
# States: nothing yet, and after a system, user or assistant row. Where an insert leads.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_INSERTED = (USER, USER, ASSISTANT, USER)
# Where keeping a row with the initial s, u or a leads from each state.
_KEPT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}
# A row's kind: its initial's place here (others last), and its first fault.
INITIALS = "sua"
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
# Text that a task gathers before it hands rows on.
FLUSH = 1 << 22


def _with_inserts(costs: list[float]) -> tuple[float, ...]:
    """The cheapest of the costs after none, one or two inserts (a third leads nowhere new)."""
    for _ in range(2):
        costs = [min(c, INSERT + costs[_INSERTED[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


END = _with_inserts([0, inf, inf, 0])


class Costs:
    """Backward steps and forward choices over cost vectors, which are few once the least cost
    is taken off; each is worked out once."""

    def __init__(self) -> None:
        self.back: dict = {}
        self.ahead: dict = {}

    def before(self, kind: int, after: tuple) -> tuple[tuple, float]:
        """The vector before a row of this kind, less its least cost, and that cost."""
        found = self.back.get((kind, after))
        if found is None:
            initial, fault = divmod(kind, 4)
            costs = [DELETE + c for c in after]
            if fault < BLANK:
                more = CUT_SHORT * (fault == TRUNCATED)
                kept = _KEPT.get(INITIALS[initial : initial + 1], {})
                for q in range(4):
                    if q in kept:
                        costs[q] = min(costs[q], more + after[kept[q]])
                    costs[q] = min(costs[q], more + REROLE + after[_INSERTED[q]])
            costs = _with_inserts(costs)
            least = min(costs)
            found = self.back[kind, after] = (tuple(c - least for c in costs), least)
        return found

    def edits(self, kind: int, after: tuple, state: int) -> tuple[str, int]:
        """The ASCII-least tight edits for a row, inserts before it included, and the state behind it."""
        found = self.ahead.get((kind, after, state))
        if found is None:
            vector, least = self.before(kind, after)
            initial, fault = divmod(kind, 4)
            more, said, q = CUT_SHORT * (fault == TRUNCATED), "", state
            while found is None:
                cost = vector[q] + least
                kept = _KEPT.get(INITIALS[initial : initial + 1], {}) if fault < BLANK else {}
                if cost == DELETE + after[q]:
                    found = said + "D", q
                elif cost == INSERT + vector[_INSERTED[q]] + least:
                    said, q = said + "I", _INSERTED[q]
                elif q in kept and cost == more + after[kept[q]]:
                    found = said + "K", kept[q]
                else:
                    found = said + "R", _INSERTED[q]
            self.ahead[kind, after, state] = found
        return found


_COSTS = Costs()


def back_over(kinds: bytes, after: tuple) -> tuple[tuple, float]:
    """The vector before a run of rows, less its least cost, and that cost."""
    total = 0
    for kind in reversed(kinds):
        after, least = _COSTS.before(kind, after)
        total += least
    return after, total


def walked(kinds: bytes, after: tuple, state: int) -> Iterator[tuple[str, int]]:
    """Each row's edits and the state behind it. Vectors are kept only at checkpoints."""
    n = len(kinds)
    step = isqrt(max(n - 1, 0)) + 1
    checkpoints = []
    for start in range((n - 1) // step * step, -1, -step) if n else ():
        checkpoints.append((start, after))
        after = back_over(kinds[start : start + step], after)[0]
    for start, after in reversed(checkpoints):
        block = kinds[start : start + step]
        behind = []
        for kind in reversed(block):
            behind.append(after)
            after = _COSTS.before(kind, after)[0]
        for kind, vector in zip(block, reversed(behind), strict=True):
            said, state = _COSTS.edits(kind, vector, state)
            yield said, state


def closing(state: int) -> str:
    """The inserts that end a conversation in this state."""
    return {SYSTEM: "II", USER: "I"}.get(state, "")


def applied(roles: list[str], texts: list[str], edits: list[str], state: int = NOTHING, last: str = "") -> tuple[list[str], list[str]]:
    """Roles and texts after the rows' edits (and the closing inserts)."""
    out_roles, out_texts = [], []

    def put(role: str, text: str, to: int) -> int:
        out_roles.append(role)
        out_texts.append(text)
        return to

    for role, text, said in zip(roles, texts, edits, strict=True):
        for e in said:
            if e in "IR":
                to = _INSERTED[state]
                state = put(_NAMES[to], "" if e == "I" else text, to)
            elif e == "K":
                state = put(role, text, _KEPT[role[:1]][state])
    for _ in last:
        to = _INSERTED[state]
        state = put(_NAMES[to], "", to)
    return out_roles, out_texts


def kinds_of(roles: list[str], texts: list[str]) -> bytearray:
    """Each row's kind, copies not yet told."""
    out = bytearray()
    for role, text in zip(roles, texts, strict=True):
        solid = text.rstrip(BLANKS)
        fault = BLANK if not solid else SOUND if solid[-1] in ".!?" else TRUNCATED
        initial = INITIALS.find(role[:1]) if role else 3
        out.append(4 * (initial if initial >= 0 else 3) + fault)
    return out


def _marked(kinds: bytearray, copies) -> bytes:
    """The kinds with rows that are copies of earlier ones marked; blank ones stay blank."""
    for i in copies:
        if kinds[i] % 4 != BLANK:
            kinds[i] = kinds[i] // 4 * 4 + DUPLICATE
    return bytes(kinds)


def _copies(roles: list[str], texts: list[str]) -> list[int]:
    seen: set = set()
    out = []
    for i, row in enumerate(zip(roles, texts, strict=True)):
        if row in seen:
            out.append(i)
        seen.add(row)
    return out


def _counts(kinds: bytes) -> list[int]:
    tally = [0, 0, 0, 0]
    for k in kinds:
        tally[k % 4] += 1
    return [tally[BLANK], tally[DUPLICATE], tally[TRUNCATED]]


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False))


def _turn_facts(turns: list[int | None]) -> list:
    known = [t for t in turns if t is not None]
    return [known[0], known[-1], len(set(known))] if known else [None, None, 0]


def _gaps(first: int | None, last: int | None, distinct: int) -> int:
    return 0 if first is None else last - first + 1 - distinct


_SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_RUN = T.StructType(
    [
        *[T.StructField(c, T.LongType()) for c in _SUMMARY],
        T.StructField("audit", T.StringType()),
        T.StructField("repaired_sha256", T.StringType()),
        T.StructField("turns", T.ArrayType(T.LongType())),
        T.StructField("roles", T.ArrayType(T.StringType())),
        T.StructField("texts", T.ArrayType(T.StringType())),
        T.StructField("kinds", T.BinaryType()),
    ]
)
_RUN_ARROW = [
    *[(c, pa.int64()) for c in _SUMMARY],
    ("audit", pa.string()),
    ("repaired_sha256", pa.string()),
    ("turns", pa.list_(pa.int64())),
    ("roles", pa.list_(pa.string())),
    ("texts", pa.list_(pa.string())),
    ("kinds", pa.binary()),
]


def _repaired(turns: list, roles: list[str], texts: list[str]) -> list:
    """A run that is a whole conversation, as a row of _RUN."""
    kinds = _marked(kinds_of(roles, texts), _copies(roles, texts))
    edits, state = [], NOTHING
    for said, state in walked(kinds, END, NOTHING):  # noqa: B007
        edits.append(said)
    last = closing(state)
    vector, cost = back_over(kinds, END)
    new_roles, new_texts = applied(roles, texts, edits, NOTHING, last)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in zip(new_roles, new_texts, strict=True)).encode("utf-8", "surrogatepass"))
    return [
        _gaps(*_turn_facts(turns)), *_counts(kinds), _illegal([r[:1] for r in roles]), int(cost + vector[NOTHING]),
        "".join(edits) + last, digest.hexdigest(), None, new_roles, new_texts, None,
    ]


def _runs(rows: DataFrame) -> DataFrame:
    """One row for each conversation of a range: repaired, or open with its rows as they are."""
    schema = T.StructType(
        [rows.schema["key"], rows.schema["conv_id"], T.StructField("part", T.IntegerType()), T.StructField("open", T.BooleanType()), *_RUN.fields]
    )

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        out: list[list] = []
        size, first = 0, True
        id_type = None

        def finished(is_open: bool) -> None:
            nonlocal size
            turns, roles, texts = held["turns"], held["roles"], held["texts"]
            row = [None] * 8 + [turns, roles, texts, bytes(kinds_of(roles, texts))] if is_open else _repaired(turns, roles, texts)
            out.append([held["key"], held["conv_id"], held["part"], is_open, *row])
            size += sum(map(len, row[-2])) + 64 * len(roles)

        def flushed() -> pa.RecordBatch:
            nonlocal size
            columns = list(zip(*out, strict=True))
            kinds = [pa.string(), id_type, pa.int32(), pa.bool_(), *[t for _, t in _RUN_ARROW]]
            names = ["key", "conv_id", "part", "open", *[n for n, _ in _RUN_ARROW]]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)
            out.clear()
            size = 0
            return batch

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            key, conv, turn, role, text, part = (batch.column(i).to_pylist() for i in range(6))
            starts = [0] + [i for i in range(1, len(key)) if key[i] != key[i - 1]] if key else []
            for a, b in zip(starts, [*starts[1:], len(key)], strict=True):
                if held and held["key"] != key[a]:
                    finished(first)
                    first = False
                    held = {}
                    if size > FLUSH:
                        yield flushed()
                if not held:
                    held = {"key": key[a], "conv_id": conv[a], "part": part[a], "turns": [], "roles": [], "texts": []}
                held["turns"] += turn[a:b]
                held["roles"] += role[a:b]
                held["texts"] += text[a:b]
        if held:
            finished(True)
        if out:
            yield flushed()

    return rows.mapInArrow(repair, schema)


def _matrix(kinds: bytes) -> list[float]:
    """Costs from each state before a run to each state behind it, row by row; -1: none."""
    columns = []
    for q in range(4):
        vector, total = back_over(kinds, tuple(0 if p == q else inf for p in range(4)))
        columns.append([c + total for c in vector])
    return [-1 if columns[to][q] == inf else int(columns[to][q]) for q in range(4) for to in range(4)]


def _copied_rows(runs: DataFrame) -> DataFrame:
    """(key, part, copies): places of rows whose role and text an earlier row of the conversation has."""
    digest = F.unhex(F.sha2(F.concat(F.length("row.roles").cast("string"), F.lit(":"), F.col("row.roles"), F.col("row.texts")), 256))
    each = runs.select("key", "part", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "row")).select(
        "key", "part", "place", digest.alias("digest")
    )
    here = F.struct("part", "place")
    first = each.groupBy("key", "digest").agg(F.min(here).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = each.join(first, ["key", "digest"]).filter(here != F.col("first"))
    return later.groupBy("key", "part").agg(F.collect_list("place").alias("copies"))


def _run_facts(runs: DataFrame) -> DataFrame:
    """Per run: its matrix, and what counts over a conversation need of it."""
    names = ["matrix", "blank", "duplicate", "truncated", "illegal", "first_initial", "last_initial", "first_turn", "last_turn", "n_turns"]
    kinds = [pa.list_(pa.int64()), *[pa.int64()] * 4, pa.string(), pa.string(), *[pa.int64()] * 3]

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                marked = _marked(bytearray(row["kinds"]), row["copies"] or [])
                initials = row["initials"]
                rows.append([_matrix(marked), *_counts(marked), _illegal(initials), initials[0], initials[-1], *_turn_facts(row["turns"])])
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["key", "part", *names])

    narrow = runs.select("key", "part", "turns", F.transform("roles", lambda r: F.substring(r, 1, 1)).alias("initials"), "kinds", "copies")
    return narrow.mapInArrow(
        facts,
        "key string, part int, matrix array<long>, blank long, duplicate long, truncated long, illegal long, "
        "first_initial string, last_initial string, first_turn long, last_turn long, n_turns long",
    )


def _vectors_behind(group: pd.DataFrame) -> pd.DataFrame:
    """For a conversation's runs (at most one for each range): the vector behind each, its cost
    and counts, on every run's row."""
    group = group.sort_values("part")
    after: tuple = END
    vectors = []
    total = 0
    for matrix in reversed(group["matrix"].tolist()):
        vectors.append([int(c) for c in after])
        costs = [min(after[to] + matrix[4 * q + to] for to in range(4) if matrix[4 * q + to] >= 0) for q in range(4)]
        least = min(costs)
        after, total = tuple(c - least for c in costs), total + least
    known = group[group["n_turns"] > 0]
    initials = zip(group["last_initial"].tolist()[:-1], group["first_initial"].tolist()[1:], strict=True)
    shared = sum(a == b for a, b in zip(known["last_turn"].tolist()[:-1], known["first_turn"].tolist()[1:], strict=True))
    gaps = _gaps(int(known["first_turn"].iloc[0]), int(known["last_turn"].iloc[-1]), int(known["n_turns"].sum()) - shared) if len(known) else 0
    return pd.DataFrame(
        {
            "key": group["key"], "part": group["part"], "after": vectors[::-1], "last": [False] * (len(group) - 1) + [True],
            "gaps": gaps, "blank": group["blank"].sum(), "duplicate": group["duplicate"].sum(), "truncated": group["truncated"].sum(),
            "illegal": group["illegal"].sum() + sum(a + b not in _LEGAL for a, b in initials), "cost": int(total + after[NOTHING]),
        }
    )


def _states_before(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("part")
    state, states = NOTHING, []
    for ends in group["ends"]:
        states.append(state)
        state = int(ends[state])
    return pd.DataFrame({"key": group["key"], "part": group["part"], "state": states})


def _run_ends(runs: DataFrame) -> DataFrame:
    """(key, part, ends): the state behind a run that the walk from each of the four leads to."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for kinds, copies, after in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                marked = _marked(bytearray(kinds), copies or [])
                out = []
                for state in range(4):
                    to = state
                    for _, to in walked(marked, tuple(after), state):  # noqa: B007
                        pass
                    out.append(to)
                found.append(out)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["key", "part", "ends"])

    return runs.select("key", "part", "kinds", "copies", "after").mapInArrow(ends, "key string, part int, ends array<int>")


def _repaired_run(table: pa.Table) -> pa.Table:
    out = []
    for row in table.to_pylist():
        marked = _marked(bytearray(row["kinds"]), row["copies"] or [])
        edits, state = [], row["state"]
        for said, state in walked(marked, tuple(row["after"]), row["state"]):  # noqa: B007
            edits.append(said)
        last = closing(state) if row["last"] else ""
        out.append((row["key"], row["part"], "".join(edits) + last, *applied(row["roles"], row["texts"], edits, row["state"], last)))
    kinds = [pa.string(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string())]
    names = ["key", "part", "audit", "roles", "texts"]
    return pa.table({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(zip(names, kinds, strict=True))})


def _digests(lines: DataFrame) -> DataFrame:
    """(key, repaired_sha256) of conversations whose rows come in order: a hash goes from line
    to line, so each conversation is streamed through one task, but never held. ``lines`` is a
    written table: over a join by the same key the planner would leave out the deal below, and
    may then read the join's own one in pieces."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for k, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.encode("utf-8", "surrogatepass"))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], names=["key", "repaired_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "repaired_sha256"])

    ordered = lines.repartition(partitions(lines.sparkSession), "key").sortWithinPartitions("key", "part", "place")
    return ordered.select("key", F.concat("role", F.lit(":"), "text").alias("line")).mapInArrow(digest, "key string, repaired_sha256 string")


class Repairs(NamedTuple):
    """Per conversation its counts, cost, audit and digest; and the repaired rows, in order of
    part and place."""

    conversations: DataFrame
    rows: DataFrame


def repaired(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> Repairs:
    """Repair every conversation that has a row.

    Rows are taken by turn (nulls first; equal turns by role and text). A null role or text
    counts as one space; rows with a null conversation id are one conversation. Faults, the
    first of which counts: blank, duplicate (role and text seen earlier), truncated (the last
    solid character does not end a sentence). Edits: K keep (0), R rerole to user or assistant
    (1), D delete (2; blank and duplicate rows must go), I insert an empty user or assistant
    row (5); a truncated row that stays adds 5. The audit holds the cheapest edits that give role
    initials ``(s?(ua)+)?``, the ASCII-least of equals. Other columns are not read. Empty table: empty.
    """
    spark = rows.sparkSession
    conv = F.col(conv_col)
    base = rows.select(
        F.when(conv.isNull(), "n").otherwise(F.concat(F.lit("v"), conv.cast("string"))).alias("key"),
        conv.alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
    )
    # Equal rows are told apart, so that no number of them has to stay in one range.
    order = ["key", F.asc_nulls_first("turn"), "role", "text", "copy"]
    dealt = base.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    runs = written(_runs(dealt.select("key", "conv_id", "turn", "role", "text", F.spark_partition_id().alias("part"))), "runs")

    open_runs = runs.filter("open")
    copies = _copied_rows(open_runs)
    marked = written(open_runs.select("key", "part", "turns", "roles", "kinds").join(copies, ["key", "part"], "left"), "open-runs")
    behind = written(
        _run_facts(marked).groupBy("key").applyInPandas(
            _vectors_behind,
            "key string, part int, after array<long>, last boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long",
        ),
        "vectors",
    )
    known = marked.join(maybe_broadcast(behind.select("key", "part", "after", "last"), 200), ["key", "part"])
    states = written(_run_ends(known).groupBy("key").applyInPandas(_states_before, "key string, part int, state int"), "states")
    full = (
        open_runs.select("key", "part", "roles", "texts", "kinds")
        .join(known.select("key", "part", "copies", "after", "last"), ["key", "part"])
        .join(maybe_broadcast(states, 100), ["key", "part"])
    )
    fixed = written(
        full.groupBy("key", "part").applyInArrow(_repaired_run, "key string, part int, audit string, roles array<string>, texts array<string>"), "repaired-runs"
    )

    ids = open_runs.select("key", "conv_id").distinct()
    shut = runs.filter("not open")
    lines = written(_lines(fixed.join(ids, "key")), "repaired-lines")
    audits = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "audit"))), lambda x: x.audit), "")
    across = (
        behind.filter("last").join(fixed.groupBy("key").agg(audits.alias("audit")), "key").join(_digests(lines), "key", "left").join(ids, "key")
        .select("conv_id", *_SUMMARY, "audit", F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
    )
    summary = shut.select("conv_id", *_SUMMARY, "audit", "repaired_sha256").unionByName(across)
    return Repairs(summary, _lines(shut).unionByName(lines).drop("key"))


def _lines(runs: DataFrame) -> DataFrame:
    return runs.select("key", "conv_id", "part", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "row")).select(
        "key", "conv_id", "part", "place", F.col("row.roles").alias("role"), F.col("row.texts").alias("text")
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of a conversations table with faults sown by a checksum of conversation and turn:
    of 20 remainders 0 drops a row, 1 empties its text, 2 takes its sentence ends, 3 repeats it,
    4 makes its role user. Nulls count as one space."""

    def solid(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(solid("conv_id"), F.lit(":"), solid("turn")).cast("binary")) % 20
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return (
        rows.select("conv_id", "turn", solid("role").alias("role"), solid("text").alias("text"), fault.alias("fault"))
        .filter("fault <> 0")
        .select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
        .drop("copy")
    )


def for_every_conversation(originals: DataFrame, repairs: Repairs) -> DataFrame:
    """A row for each conversation of ``originals``; those without rows left have zeros."""
    ids = originals.select(F.col("conv_id").alias("their_id")).distinct()
    found = repairs.conversations
    return ids.join(found, ids["their_id"].eqNullSafe(found["conv_id"]), "left").select(
        F.col("their_id").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in _SUMMARY],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
