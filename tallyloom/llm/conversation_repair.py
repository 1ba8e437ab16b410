"""Conversations brought to the order of turns by the cheapest edits, found by an auction for shortest paths.

The rows of a conversation and the four states of the order (nothing yet, after the system turn, after
a user turn, after an assistant turn) are the nodes of a lattice whose arcs are edits with whole-number
costs. A path from the first node extends along the arc of least cost plus price, or, where that is
dearer than the node's own price, raises the price and steps back. When it ends, the prices are the
costs still to go, the arcs that they leave tight are those of all cheapest paths, and following the
smallest letter among tight arcs spells the least audit.

A conversation may hold any part of all rows. Rows are cut into sorted ranges; of a conversation's rows in
a range ("run"), parts of a fixed length are solved apart: each gives the costs from state to state.
Prices then pass backwards over the runs' cost matrices, states forwards over the runs' exits, and
runs are traced side by side. Only the digest of a repaired conversation reads it in one stream, row
after row, as SHA-256 goes on from byte to byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import range_count
from .common import stage

#: White space of the contracts.
BLANKS = " \t\n\x0b\f\r"
#: Rows whose lattice is solved together.
PART = 32
#: What an unreachable state costs.
NEVER = 1 << 40
#: States of the order: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: What the end of a conversation still costs in each state: the inserted turns that close a pair.
CLOSING = (0, 4, 2, 0)
CLOSED_BY = ("", "II", "I", "")
#: A row's code is the class of its role (system, user, assistant, other) plus four times its fault.
OTHER = 3
SOUND, EMPTY, REPEATED, CUT = range(4)


def _edits(code: int, state: int) -> list[tuple[str, int, int, int]]:
    """``(letter, cost, rows, next state)`` of the edits at a row, by letter."""
    role, fault = code & 3, code >> 2
    turn = ASSISTANT if state == USER else USER
    out = [("D", 3, 1, state), ("I", 2, 0, turn)]
    if fault not in (EMPTY, REPEATED):
        more = int(fault == CUT)
        if role == turn - 1 or (role == 0 and state == START):
            out.append(("K", more, 1, role + 1))
        out.append(("R", 2 + more, 1, turn))
    return out


EDITS = [[_edits(code, state) for state in range(4)] for code in range(16)]


@lru_cache(maxsize=1 << 14)
def auction(codes: bytes, end: tuple[int, ...]) -> tuple[tuple[int, ...], tuple[tuple[tuple[str, int], ...], ...]]:
    """Prices of the four states before the rows, and the arcs ``(letter, next node)`` that lie on cheapest
    paths, of a lattice whose states after the rows have the prices ``end`` (``NEVER``: not to be reached).
    Node ``4 * row + state``."""
    n = len(codes)
    arcs: list[list[tuple[str, int, int]]] = []
    for i, code in enumerate(codes):
        arcs += [[(letter, cost, 4 * (i + rows) + to) for letter, cost, rows, to in EDITS[code][state]] for state in range(4)]
    least = min(end)
    alive = [False] * (4 * n) + [e < NEVER for e in end]
    prices = [0] * (4 * n) + list(end)
    for i in range(n - 1, -1, -1):
        # Every path pays for a row what its fault costs at least, which makes feasible first prices.
        least += (0, 3, 3, 1)[codes[i] >> 2]
        for node in (*range(4 * i, 4 * i + 4), *range(4 * i, 4 * i + 4)):
            prices[node] = least
            alive[node] = alive[node] or any(alive[to] for _, _, to in arcs[node])
    arcs = [[a for a in own if alive[a[2]]] for own in arcs]
    for origin in range(4):
        if not alive[origin]:
            continue
        path = [origin]
        while path[-1] < 4 * n:
            node = path[-1]
            best, to = min((cost + prices[to], to) for _, cost, to in arcs[node])
            if prices[node] < best:
                prices[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
    good = [False] * (4 * n) + [e < NEVER for e in end]
    tight: list[tuple[tuple[str, int], ...]] = [()] * (4 * n)
    for i in range(n - 1, -1, -1):
        for node in (*range(4 * i, 4 * i + 4), *range(4 * i, 4 * i + 4)):
            tight[node] = tuple((letter, to) for letter, cost, to in arcs[node] if good[to] and prices[node] == cost + prices[to])
            good[node] = bool(tight[node])
    return tuple(p if a else NEVER for p, a in zip(prices[:4], alive[:4], strict=True)), tuple(tight)


def _to_go(codes: bytes, end: tuple[int, ...]) -> tuple[int, ...]:
    """Prices before a part; they are found relative to the least at its end, which makes equal parts meet in the cache."""
    least = min(end)
    prices = auction(codes, tuple(e - least if e < NEVER else NEVER for e in end))[0]
    return tuple(p + least if p < NEVER else NEVER for p in prices)


def _traced(codes: bytes, end: tuple[int, ...], state: int) -> tuple[str, int]:
    """The least audit of a part among its cheapest ones, and the state after it."""
    least = min(end)
    tight = auction(codes, tuple(e - least if e < NEVER else NEVER for e in end))[1]
    node, out = state, []
    while node < 4 * len(codes):
        letter, node = tight[node][0]
        out.append(letter)
    return "".join(out), node - 4 * len(codes)


def _parts(codes: bytes) -> list[bytes]:
    return [codes[k : k + PART] for k in range(0, len(codes), PART)]


@lru_cache(maxsize=1 << 14)
def _matrix(part: bytes) -> np.ndarray:
    """Costs from each state before a part to each one after it."""
    return np.array([auction(part, tuple(0 if s == to else NEVER for s in range(4)))[0] for to in range(4)], np.int64).T


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), NEVER)


def run_matrix(codes: bytes) -> np.ndarray:
    out = None
    for part in _parts(codes):
        out = _matrix(part) if out is None else _joined(out, _matrix(part))
    return out


def run_prices(codes: bytes, end: tuple[int, ...]) -> list[tuple[bytes, tuple[int, ...]]]:
    """The parts of a run, each with the prices after it."""
    out = []
    for part in reversed(_parts(codes)):
        out.append((part, end))
        end = _to_go(part, end)
    return out[::-1]


def run_trace(codes: bytes, end: tuple[int, ...], state: int) -> tuple[str, int]:
    audit = []
    for part, after in run_prices(codes, end):
        letters, state = _traced(part, after, state)
        audit.append(letters)
    return "".join(audit), state


def row_edits(audit: str, state: int, roles: str) -> Iterator[dict]:
    """For each row of a run: the turns inserted before it, the edit, a new role, and turns added at the end.
    ``roles`` has the initial of the row's role for each letter of the audit."""
    names = {USER: "user", ASSISTANT: "assistant"}
    before: list[str] = []
    waiting = None
    for k, letter in enumerate(audit):
        turn = ASSISTANT if state == USER else USER
        if letter == "I":
            before.append(names[turn] + ":")
            state = turn
            continue
        if waiting:
            yield waiting
        waiting = {"before": "\n".join(before) or None, "act": letter, "role": names[turn] if letter == "R" else None, "after": None}
        before = []
        if letter == "K" and state == START and roles[k] == "s":
            state = SYSTEM
        elif letter in "KR":
            state = turn
    if waiting:
        yield waiting



RUN = "run long, range long, codes binary, costs binary, blank long, duplicate long, truncated long, illegal long, opens int, closes int, least_turn long, most_turn long, turns long"


def conversation_runs(rows: DataFrame) -> DataFrame:
    """``conv_id`` and ``RUN`` from sorted rows ``(pos, range, conv_id, turn, role, fault)``: a conversation's rows in a range."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    legal = np.zeros((4, 4), bool)
    legal[[0, 1, 2], [1, 2, 1]] = True

    def run(table: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        table = table.take(pc.sort_indices(table["pos"]))
        role, fault = (table[c].to_numpy().astype(np.int64) for c in ("role", "fault"))
        codes = (role + 4 * fault).astype(np.uint8).tobytes()
        turns = table["turn"].drop_null()
        ends = pc.min_max(turns).as_py()
        made = [
            table["pos"][0].as_py(), table["range"][0].as_py(), codes, run_matrix(codes).tobytes(),
            *[int((fault == f).sum()) for f in (EMPTY, REPEATED, CUT)], int((~legal[role[:-1], role[1:]]).sum()), int(role[0]), int(role[-1]),
            ends["min"], ends["max"], pc.count_distinct(turns).as_py(),
        ]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 4, pa.int32(), pa.int32(), *[pa.int64()] * 3]
        names = [x.split()[0] for x in RUN.split(", ")]
        return pa.table([table["conv_id"].slice(0, 1), *[pa.array([v], k) for v, k in zip(made, kinds, strict=True)]], names=["conv_id", *names])

    return rows.groupBy("conv_id", "range").applyInArrow(run, f"conv_id {kind}, {RUN}")


def _along(df: DataFrame, use, schema: str) -> DataFrame:
    """``use`` on a conversation's rows, one per run, in the order of runs."""

    def ordered(table: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        return use(table.take(pc.sort_indices(table["run"])))

    return df.groupBy("conv_id").applyInArrow(ordered, schema)


def end_prices(runs: DataFrame) -> DataFrame:
    """``run, prices, last``: what it costs to go on from each state after each run of a conversation."""

    def back(table: pa.Table) -> pa.Table:
        end, out = np.array(CLOSING, np.int64), []
        for costs in reversed(table["costs"].to_pylist()):
            out.append(end.tobytes())
            end = np.minimum((np.frombuffer(costs, np.int64).reshape(4, 4) + end).min(axis=1), NEVER)
        last = [False] * (len(out) - 1) + [True]
        return pa.table([table["run"], pa.array(out[::-1], pa.binary()), pa.array(last)], names=["run", "prices", "last"])

    return _along(runs.select("conv_id", "run", "costs"), back, "run long, prices binary, last boolean")


def _prices(x: bytes) -> tuple[int, ...]:
    return tuple(np.frombuffer(x, np.int64).tolist())


def entry_states(priced: DataFrame) -> DataFrame:
    """``run, state``: the state in which the traced path enters each run."""
    kind = priced.schema["conv_id"].dataType.simpleString()

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for codes, prices in zip(batch["codes"].to_pylist(), batch["prices"].to_pylist(), strict=True):
                start = _to_go_run(codes, _prices(prices))
                out.append(bytes(run_trace(codes, _prices(prices), s)[1] if start[s] < NEVER else s for s in range(4)))
            yield pa.RecordBatch.from_arrays([batch["conv_id"], batch["run"], pa.array(out, pa.binary())], names=["conv_id", "run", "exits"])

    def forth(table: pa.Table) -> pa.Table:
        state, out = START, []
        for x in table["exits"].to_pylist():
            out.append(state)
            state = x[state]
        return pa.table([table["run"], pa.array(out, pa.int32())], names=["run", "state"])

    leaving = priced.select("conv_id", "run", "codes", "prices").mapInArrow(exits, f"conv_id {kind}, run long, exits binary")
    return _along(leaving, forth, "run long, state int")


def _to_go_run(codes: bytes, end: tuple[int, ...]) -> tuple[int, ...]:
    part, after = run_prices(codes, end)[0]
    return _to_go(part, after)


EDIT = "array<struct<before:string,act:string,role:string,after:string>>"


def traced_runs(entered: DataFrame) -> DataFrame:
    """``conv_id, run, audit, edits`` of each run, from its codes, prices after it and state before it."""
    kind = entered.schema["conv_id"].dataType.simpleString()
    fields = pa.list_(pa.struct([(c, pa.string()) for c in ("before", "act", "role", "after")]))

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits, edits = [], []
            for codes, prices, state, last in zip(*[batch[c].to_pylist() for c in ("codes", "prices", "state", "last")], strict=True):
                audit, left = run_trace(codes, _prices(prices), state)
                roles = iter("suao"[c & 3] for c in codes)
                kept = "".join(" " if x == "I" else next(roles) for x in audit)
                own = list(row_edits(audit, state, kept))
                if last and CLOSED_BY[left]:
                    audit += CLOSED_BY[left]
                    own[-1]["after"] = "user:\nassistant:" if left == SYSTEM else "assistant:"
                audits.append(audit)
                edits.append(own)
            yield pa.RecordBatch.from_arrays([batch["conv_id"], batch["run"], pa.array(audits, pa.string()), pa.array(edits, fields)], names=["conv_id", "run", "audit", "edits"])

    return entered.select("conv_id", "run", "codes", "prices", "state", "last").mapInArrow(trace, f"conv_id {kind}, run long, audit string, edits {EDIT}")


def _digests(lines: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of ``(conv_id, pos, line)``: one stream per conversation, a batch in memory."""
    kind = lines.schema["conv_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            ids, out = [], []
            for conv, line in zip(batch["conv_id"].to_pylist(), batch["line"].to_pylist(), strict=True):
                if sha is None or conv != now:
                    if sha is not None:
                        ids.append(now)
                        out.append(sha.hexdigest())
                    now, sha, first = conv, hashlib.sha256(), True
                if line is not None:
                    sha.update(line.encode() if first else b"\n" + line.encode())
                    first = False
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(out, pa.string())], names=["conv_id", "repaired_sha256"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], batch.schema.field(0).type), pa.array([sha.hexdigest()], pa.string())], names=["conv_id", "repaired_sha256"])

    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    return ordered.select("conv_id", "line").mapInArrow(digest, f"conv_id {kind}, repaired_sha256 string")


def sorted_turns(turns: DataFrame) -> DataFrame:
    """``pos, range, conv_id, turn, role, text, digest``: rows in ranges of the order of conversations and turns.

    Turns that are null come first; rows of one turn follow one another by role and text digest. A
    null role or text counts as one space.
    """
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    rows = rows.withColumn("digest", F.md5(F.col("text").cast("binary"))).withColumn("spread", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest", "spread")]
    rows = rows.repartitionByRange(range_count(rows), *keys).sortWithinPartitions(*keys)
    rows = stage(rows.drop("spread").withColumn("pos", F.monotonically_increasing_id()), "turns")
    return rows.withColumn("range", F.shiftright("pos", 33))


def faults(rows: DataFrame) -> DataFrame:
    """``pos, range, conv_id, turn, role, fault`` of sorted turns: the class of the role and the first fault."""
    firsts = rows.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("first"))
    bare = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    small = rows.select(
        "pos", "range", "conv_id", "turn",
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER).alias("role"),
        F.when(bare == "", EMPTY).when(~F.substring(bare, -1, 1).isin(".", "!", "?"), CUT).otherwise(SOUND).alias("own"),
    )
    # A position is one row, so this join has no hot key, however often a turn repeats.
    marked = small.join(firsts.select("first"), F.col("pos") == F.col("first"), "left")
    fault = F.when((F.col("own") != EMPTY) & F.col("first").isNull(), REPEATED).otherwise(F.col("own"))
    return marked.select("pos", "range", "conv_id", "turn", "role", fault.alias("fault"))


def repaired_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` per conversation of
    ``turns(conv_id, turn, role, text, ...)``.

    Each row's first fault counts: blank (no text but white space), duplicate (role and text seen
    earlier in the conversation), truncated (the last character is none of ``.!?``). Edits are Keep
    (0), Rerole to user or assistant (2), Delete (3, required for blank and duplicate rows) and Insert of
    an empty user or assistant turn (2); a truncated row that stays adds 1. The audit spells the cheapest
    edits that leave an optional system turn and pairs of user and assistant, the least by ASCII.
    ``gaps`` are turn numbers that are missing between the first and the last one. A role counts by its
    first character; other roles, the empty one too, cannot stay. A null conversation id is an id, an
    empty table gives no rows, other columns are not looked at.
    """
    rows = sorted_turns(turns)
    runs = stage(conversation_runs(faults(rows)), "runs")
    priced = stage(runs.join(end_prices(runs), "run"), "priced")
    entered = priced.join(entry_states(priced), "run")
    traced = stage(traced_runs(entered), "traced")

    edits = traced.select("run", F.posexplode("edits").alias("at", "edit")).select((F.col("run") + F.col("at")).alias("at"), "edit.*")
    edits = edits.select("at", "before", "act", F.col("role").alias("new_role"), "after")
    own = F.when(F.col("act") != "D", F.concat(F.coalesce("new_role", "role"), F.lit(":"), F.col("text")))
    both = rows.select("pos", "conv_id", "role", "text").join(edits, F.col("pos") == F.col("at"))
    pieces = F.array_compact(F.array("before", own, "after"))
    lines = both.select("conv_id", "pos", F.when(F.size(pieces) > 0, F.array_join(pieces, "\n")).alias("line"))

    def told(table: pa.Table) -> pa.Table:
        r = table.to_pylist()
        legal = {(0, 1), (1, 2), (2, 1)}
        illegal = sum(x["illegal"] for x in r) + sum((a["closes"], b["opens"]) not in legal for a, b in zip(r[:-1], r[1:], strict=True))
        dated = [x for x in r if x["turns"]]
        turns = sum(x["turns"] for x in dated) - sum(a["most_turn"] == b["least_turn"] for a, b in zip(dated[:-1], dated[1:], strict=True))
        gaps = dated[-1]["most_turn"] - dated[0]["least_turn"] + 1 - turns if dated else 0
        end = np.array(CLOSING, np.int64)
        for x in reversed(r):
            end = np.minimum((np.frombuffer(x["costs"], np.int64).reshape(4, 4) + end).min(axis=1), NEVER)
        sums = [gaps, *[sum(x[c] for x in r) for c in ("blank", "duplicate", "truncated")], illegal, int(end[START])]
        audit = "".join(x["audit"] for x in r)
        return pa.table([table["conv_id"].slice(0, 1), *[pa.array([v], pa.int64()) for v in sums], pa.array([audit], pa.string())], names=["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

    kind = turns.schema["conv_id"].dataType.simpleString()
    known = runs.drop("codes", "range").join(traced.select("run", "audit"), "run")
    summed = _along(known, told, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
    digests = _digests(lines)
    out = summed.alias("s").join(digests.alias("d"), F.col("s.conv_id").eqNullSafe(F.col("d.conv_id")))
    return out.select("s.*", "d.repaired_sha256")


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with planted damage, by a hash of conversation and turn: rows that are lost,
    emptied, without stops, repeated or given to the user."""
    name = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(name.cast("binary")) % 20).alias("luck"),
    ).filter("luck != 0")
    text: Column = F.when(F.col("luck") == 1, "").when(F.col("luck") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("luck") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "luck")
    times = F.when(F.col("luck") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("time", F.explode(times)).drop("luck", "time")


def repair_of_damaged(conversations: DataFrame) -> DataFrame:
    """The repair of each conversation after planted damage; one that has lost all rows has zeros, an
    empty audit and the digest of the empty string."""
    ids = conversations.select("conv_id").distinct()
    told = repaired_conversations(damaged(conversations)).withColumnRenamed("conv_id", "own_id")
    rows = ids.join(told, F.col("conv_id").eqNullSafe(F.col("own_id")), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return rows.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
