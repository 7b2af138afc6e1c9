"""Operator 11: conversation repair against dynamic programming over all positions."""
import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from barmarts.llm import repair
from llm_edge import SF_SMALL

SPACE = " \t\n\x0b\x0c\r"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
AFTER = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}
FULL = {"u": "user", "a": "assistant"}


def brute_damage(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv]
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else "".join(c for c in text if c not in ".!?") if code == 2 else text
        groups[conv] += [(turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    return groups


def brute_repair(rows):
    """Every cheapest value at every (rows done, state), audits kept as whole strings."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {(0, 0): (0, "")}

    def offer(key, value):
        best[key] = min(value, best.get(key, value))
    for i in range(len(rows) + 1):
        for s in (0, 1, 2, 3) * 4:
            if (i, s) in best:
                cost, audit = best[i, s]
                offer((i, AFTER[s][1]), (cost + 2, audit + "I"))
        for s in range(4):
            if (i, s) not in best or i == len(rows):
                continue
            cost, audit = best[i, s]
            offer((i + 1, s), (cost + 3, audit + "D"))
            if faults[i] in "bd" and faults[i]:
                continue
            cost += faults[i] == "t"
            first = rows[i][1][:1]
            if first == AFTER[s][0]:
                offer((i + 1, AFTER[s][1]), (cost, audit + "K"))
            if first == "s" and s == 0:
                offer((i + 1, 1), (cost, audit + "K"))
            offer((i + 1, AFTER[s][1]), (cost + 2, audit + "R"))
    cost, audit = min(best[len(rows), s] for s in (0, 3) if (len(rows), s) in best)
    out, state, left = [], 0, iter(rows)
    for letter in audit:
        if letter != "I":
            _, role, text = next(left)
        if letter == "K" and role[:1] == "s":
            state = 1
            out.append(f"{role}:{text}")
        elif letter != "D":
            wanted, state = AFTER[state]
            out.append(f"{role}:{text}" if letter == "K" else FULL[wanted] + ":" + (text if letter == "R" else ""))
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(x) for x in "bdt"), illegal,
            cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def found(df):
    rows = df.select("conv_id", *COLUMNS).collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_query_against_brute_force(spark):
    raw = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    want = {c: brute_repair(rows) for c, rows in brute_damage(raw).items()}
    assert found(E.queries()["op11_conversation_repair"](spark, SF_SMALL)) == want


ROWS = [
    (1, 0, "user", "Hello."), (1, 1, "assistant", "Yes!"), (1, 2, "user", "cut"), (1, 3, "assistant", "cut too"),
    (2, 0, "system", "Rules."), (2, 1, "assistant", "I speak first."), (2, 2, "assistant", "Again."), (2, 9, "user", "Bye?"),
    (3, 0, "assistant", "A."), (3, 1, "user", "U."),
    (4, None, "user", "No turn."), (4, None, None, "No role."), (4, 5, "user", None),
    (5, 0, "", "Empty role."), (5, 1, "User", "Capital."), (5, 2, "tool", " \t\n"),
    (6, 0, "user", "x" * 300_000 + "."), (6, 1, "assistant", "Long."),
    (7, 0, "system", "s."), (7, 1, "system", "t."), (7, 2, "user", "u."), (7, 3, "user", "v."), (7, 4, "user", "w."),
    (None, 0, "user", "No id."), (None, 1, "user", "No id.\r\n"), (8, 3, "user", "One."), (8, 3, "user", "One."),
    *((9, k, ("user", "assistant", "system")[k * k % 3], f"Say {k % 40}{'.' if k % 7 else ''}") for k in range(300)),
]
SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("segment_rows", [1, 2, 7, 2000])
def test_segments_give_the_same_rows(spark, segment_rows):
    """Whatever the bound, also where every conversation takes the way of the long ones."""
    rows = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    clash = rows.withColumns({c: F.lit("clash") for c in ("audit", "pos", "id", "hash", "repaired")})
    groups = defaultdict(list)
    for conv, turn, role, text in ROWS:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    want = {c: brute_repair(sorted(g, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))) for c, g in groups.items()}
    assert found(repair.with_digest(repair.repair(clash, segment_rows))) == want
    damaged = repair.with_digest(repair.repair(repair.damage(clash), segment_rows))
    assert found(damaged) == {c: brute_repair(sorted(g, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))) for c, g in brute_damage(ROWS).items()}


def test_empty_table_and_lost_conversation(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert repair.with_digest(repair.repair(repair.damage(nothing))).count() == 0
    lost = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    one = spark.createDataFrame([(1, lost, "user", "Gone.")], SCHEMA)
    assert found(repair.with_digest(repair.repair(repair.damage(one)))) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_agenda_finds_the_least_audit():
    assert repair.lightest([("a", 0), ("u", 0)], repair.START) == (4, "IKKI")  # not RR, of the same cost
    assert repair.lightest([("u", 0), ("u", 0)], repair.START) == (2, "KR")
    assert repair.lightest([("s", 0)], repair.START) == (3, "D")
    assert repair.lightest([], repair.START) == (0, "")
