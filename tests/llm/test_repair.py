import hashlib
import random
import re

import pytest

from gridmart.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, place string"
NAMES = {2: "user", 3: "assistant"}


def plain(rows):
    """Every cheapest way kept as (cost, audit, turns), the least taken at the end."""
    said = [(turn, " " if role is None else role, " " if text is None else text) for turn, role, text in rows]
    said.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = {t for t, _, _ in said if t is not None}
    out = {"gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, "blank": 0, "duplicate": 0, "truncated": 0}
    out["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
    ways, seen = {0: (0, "", ())}, set()
    for _, role, text in said:
        fault = None
        if not text.strip(" \t\n\x0b\x0c\r"):
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text):
            fault = "truncated"
        seen.add((role, text))
        if fault:
            out[fault] += 1
        found = {}
        for before, way in ways.items():
            for extra in range(3):
                state, (cost, audit, done) = before, way
                for _ in range(extra):
                    state = 3 if state == 2 else 2
                    cost, audit, done = cost + 5, audit + "I", (*done, NAMES[state] + ":")
                edits = [(state, cost + 2, audit + "D", done)]
                if fault in (None, "truncated"):
                    cost, to = cost + 5 * (fault == "truncated"), 3 if state == 2 else 2
                    edits.append((to, cost + 1, audit + "R", (*done, f"{NAMES[to]}:{text}")))
                    kept = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((role[:1], state))
                    if kept:
                        edits.append((kept, cost, audit + "K", (*done, f"{role}:{text}")))
                for to, *edit in edits:
                    found[to] = min(found.get(to, tuple(edit)), tuple(edit))
        ways = found
    ends = []
    for state, (cost, audit, done) in ways.items():
        while state not in (0, 3):
            state = 3 if state == 2 else 2
            cost, audit, done = cost + 5, audit + "I", (*done, NAMES[state] + ":")
        ends.append((cost, audit, done))
    cost, audit, done = min(ends)
    return out | {"cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(done).encode()).hexdigest()}


def compared(spark, rows):
    turns = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    found = repair.audited(turns, turns).collect()
    by = {}
    for conv, *row in rows:
        by.setdefault(conv, []).append(row)
    assert len(found) == len(by)
    for r in found:
        assert {k: v for k, v in r.asDict().items() if k != "conv_id"} == plain(by[r["conv_id"]]), by[r["conv_id"]]


@pytest.mark.parametrize("fan", [12, 1])
def test_random_conversations_against_every_way(spark, monkeypatch, fan):
    """With a fan of two, conversations go through a tree of several levels."""
    monkeypatch.setattr(repair, "FAN", fan)
    rng = random.Random(fan)
    texts = ["a.", "b!", "c?", "d", "e", "", " \n", None, "a. ", "ö.", "f.", "g."]
    roles = ["user", "assistant"] * 4 + ["system", "tool", "", None, "agent"]
    rows = []
    for conv in range(60):
        n = rng.randint(1, 14)
        for turn in range(n):
            rows.append((conv if conv else None, rng.choice([turn, turn, turn, None, 3]), rng.choice(roles), rng.choice(texts)))
    rows += [(7, 2, "user", "same")] * 9 + [(8, None, None, None)] * 5
    compared(spark, rows)


def test_a_conversation_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(repair, "FAN", 3)
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), f"{t}" + rng.choice(["", ".", "!"])) for t in range(3000)]
    compared(spark, rows + [(2, 0, "user", "x" * 300_000 + ".")])


def test_turns_lost_to_damage_and_no_turns(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a.", "x"), (2, 0, "user", "a.", "x")], SCHEMA)
    found = {r["conv_id"]: r for r in repair.audited(rows, rows.filter("conv_id = 1")).collect()}
    nothing = hashlib.sha256().hexdigest()
    assert found[2].asDict() == {"conv_id": 2, "audit": "", "repaired_sha256": nothing} | dict.fromkeys(
        ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0
    )
    assert (found[1]["audit"], found[1]["cost"]) == ("D", 2)
    none = rows.filter("false")
    assert repair.audited(none, none).count() == 0


def test_edits_hold_the_turns(spark):
    rows = [(1, 0, "assistant", "a.", "x"), (1, 1, "assistant", "b.", "x"), (1, 2, "user", "c.", "x")]
    edits, costs = repair.repair(repair.find_faults(spark.createDataFrame(rows, SCHEMA)))
    held = [(r["edits"], r["before"], r["new_role"], r["after"]) for r in edits.orderBy("place").collect()]
    assert held == [("R", [], "user", []), ("K", [], "assistant", []), ("D", [], None, [])]
    assert [tuple(r) for r in costs.collect()] == [(1, 1, 3)]
