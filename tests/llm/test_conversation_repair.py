"""Conversation repair against brute force: every lattice by dynamic programming over whole audits."""

import collections
import hashlib
import random
import re
import zlib

BLANK = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {("", "u"): "u", ("", "s"): "s", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        luck = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if luck:
            text = "" if luck == 1 else re.sub("[.!?]", "", text) if luck == 2 else text
            out += [(conv, turn, "user" if luck == 4 else role, text)] * (2 if luck == 3 else 1)
    return out


def repair(rows):
    """Of one conversation's ordered rows ``(turn, role, text)``: the contract's columns."""
    seen, faults = set(), []
    for _, role, text in rows:
        letters = BLANK.findall(text)
        faults.append(1 if not letters else 2 if (role, text) in seen else 3 if letters[-1] not in ".!?" else 0)
        seen.add((role, text))
    # Of each state the cheapest (cost, audit, lines).
    best = {"": (0, "", ())}

    def better(into, state, value):
        if state not in into or value[:2] < into[state][:2]:
            into[state] = value

    def with_inserts(states):
        out = dict(states)
        for _ in range(3):
            for state, (cost, audit, lines) in list(out.items()):
                for c, name in (("u", "user"), ("a", "assistant")):
                    if (state, c) in NEXT:
                        better(out, NEXT[state, c], (cost + 2, audit + "I", (*lines, name + ":")))
        return out

    for (_, role, text), fault in zip(rows, faults):
        into = {}
        for state, (cost, audit, lines) in with_inserts(best).items():
            better(into, state, (cost + 3, audit + "D", lines))
            if fault in (0, 3):
                more = int(fault == 3)
                if (state, role[:1]) in NEXT:
                    better(into, NEXT[state, role[:1]], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                for name in ("user", "assistant"):
                    if (state, name[0]) in NEXT:
                        better(into, NEXT[state, name[0]], (cost + 2 + more, audit + "R", (*lines, f"{name}:{text}")))
        best = into
    best = with_inserts(best)
    cost, audit, lines = min(best[s] for s in ("", "a") if s in best)
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows[:-1], rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, *[faults.count(f) for f in (1, 2, 3)], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def by_force(rows, ids):
    groups = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, role, text))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest())
    return {i: repair(sorted(groups[i], key=order)) if i in groups else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for i in ids}


def conversations():
    rng = random.Random(5)
    rows = []
    for conv in range(120):
        for turn in range(rng.randrange(1, 12)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Fine.", "Cut off", " \t\n", "Ja! ", None, "What? ", "", f"Text {turn}."])
            rows.append((conv, rng.choice([turn, turn, 2 * turn, None]), role, text))
    # A long one of which much is sound, one of a single repeated row, one without an id.
    rows += [(500, t, ("user", "assistant")[t % 2] if t % 9 else "assistant", f"Row {t}." if t % 13 else "cut") for t in range(700)]
    rows += [(501, 3, "user", "Same.") for _ in range(300)]
    rows += [(None, t, "user", f"Text {t}.") for t in range(5)]
    rows += [(600 + k, None, "user", None) for k in range(40)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, pos int, range string")


def test_repair_of_damaged(spark):
    from tallyloom.llm.conversation_repair import repair_of_damaged

    rows = conversations()
    got = {r["conv_id"]: tuple(r)[1:] for r in repair_of_damaged(frame(spark, rows)).collect()}
    want = by_force(damage(rows), {r[0] for r in rows})
    assert got.keys() == want.keys()
    for conv in want:
        assert got[conv] == want[conv], conv
    assert any(zlib.crc32(f"{600 + k}: ".encode()) % 20 == 0 for k in range(40))
    assert repair_of_damaged(frame(spark, rows).limit(0)).count() == 0


def test_a_conversation_over_many_ranges(spark):
    """Forty ranges cut two long conversations into runs whose prices and states pass on."""
    from tallyloom.llm import conversation_repair as R

    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"T{t}.", "cut", " ", "Same."])) for c in (1, 2) for t in range(400)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = {r["conv_id"]: tuple(r)[1:] for r in R.repaired_conversations(frame(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == by_force(rows, {1, 2})


def test_prices_are_costs_to_go():
    from tallyloom.llm.conversation_repair import CLOSING, NEVER, run_matrix, run_prices, run_trace, _to_go_run

    rng = random.Random(3)
    for _ in range(60):
        codes = bytes(rng.randrange(16) for _ in range(rng.randrange(1, 90)))
        prices = _to_go_run(codes, CLOSING)
        assert [int(x) for x in (run_matrix(codes) + list(CLOSING)).min(axis=1)] == list(prices)
        assert all(p < NEVER for p in prices) and len(run_prices(codes, CLOSING)) == -(-len(codes) // 32)
        for state in range(4):
            audit, left = run_trace(codes, CLOSING, state)
            own = sum({"D": 3, "I": 2, "K": 0, "R": 2}[x] for x in audit)
            faults = iter(c >> 2 for c in codes)
            own += sum(next(faults) == 3 and x != "D" for x in audit if x != "I")
            assert own + CLOSING[left] == prices[state]
