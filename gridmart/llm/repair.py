"""Conversation structure repair by Hirschberg's divide and conquer.

A repaired conversation is an optional system turn and then user and assistant in turn, ending with
the assistant. Four states say what the turns kept so far allow: nothing yet, after the system turn,
after a user, after an assistant. Each turn is kept, given another role, or deleted, and empty turns
may be inserted before it; a vector of four costs is all that has to be known of the turns before a
point (forward) or after it (backward). In the middle of a conversation both vectors meet: the
cheapest crossing state, of equal ones the one with the least audit before it, splits the problem in
two, which are solved alike. Space is linear in the turns.

Of one start, audits that lead to different states differ at some letter and none begins another,
because inserted turns always precede an edit of a turn. So four ranks beside the forward costs order
the audits, and no audit is compared as a string.

A long conversation is cut into blocks of turns. What a block does to the four states is a table of
four by four costs and ranks, and such tables compose like single turns: blocks are summed up in a
tree, crossings are chosen down the tree, and each block then finds its own edits. No task ever holds
more than a block, whatever the length of a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache, lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from gridmart.llm.common import staged

#: Prices of the edits: another role, a deleted turn, an inserted turn, a turn left truncated.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows of a block and blocks of a node of the tree: two to this power.
FAN = 12
#: Rows of a batch that goes back to Spark.
HELD_ROWS = 4096
_NEVER = 1 << 60
#: A state dearer than the cheapest by more than this is on no cheapest way: two inserted turns and
#: a deleted system turn make up for any state.
_HOPELESS = 2 * INSERT + DELETE + 20
START, SYSTEM, USER, ASSISTANT = range(4)
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_INITIALS = "sua"
SPACE = " \t\n\x0b\x0c\r"

#: What a turn does to the states: costs and ranks, from each state to each.
Table = tuple[tuple[tuple[int, ...], ...], tuple[tuple[int, ...], ...]]
#: Costs and ranks of the ways that lead to each state.
Vector = tuple[tuple[int, ...], tuple[int, ...]]

_INSERTED = {
    (START, USER): 1,
    (START, ASSISTANT): 2,
    (SYSTEM, USER): 1,
    (SYSTEM, ASSISTANT): 2,
    (USER, ASSISTANT): 1,
    (ASSISTANT, USER): 1,
}


def _after(state: int) -> int:
    """The state after one more turn of the alternation."""
    return ASSISTANT if state == USER else USER


@cache
def _ways(kind: int) -> dict[tuple[int, int], tuple[int, str]]:
    """The cheapest edits of a turn of a kind from one state to another; of equal ones the least."""
    role, fault = divmod(kind, 3)
    found: dict[tuple[int, int], tuple[int, str]] = {}
    for before in range(4):
        for state in range(4):
            inserted = 0 if state == before else _INSERTED.get((before, state))
            if inserted is None:
                continue
            edits = [(DELETE, "D", state)]
            if fault < 2:
                left = TRUNCATED * fault
                edits.append((REROLE + left, "R", _after(state)))
                if (role == 0 and state == START) or (role == 1 and state != USER) or (role == 2 and state == USER):
                    edits.append((left, "K", role + 1))
            for cost, letter, to in edits:
                way = (INSERT * inserted + cost, "I" * inserted + letter)
                found[before, to] = min(way, found.get((before, to), way))
    return found


@cache
def turn_table(kind: int) -> Table:
    """The table of a turn; its kind is three times the role (system, user, assistant, other) plus
    the fault (none, truncated, to be deleted)."""
    ways = _ways(kind)
    costs = tuple(tuple(ways[p, q][0] if (p, q) in ways else _NEVER for q in range(4)) for p in range(4))
    ranks = []
    for p in range(4):
        order = sorted(w[1] for (a, _), w in ways.items() if a == p)
        ranks.append(tuple(order.index(ways[p, q][1]) if (p, q) in ways else 9 for q in range(4)))
    return costs, tuple(ranks)


def _from(state: int) -> Vector:
    return tuple(0 if q == state else _NEVER for q in range(4)), (0, 0, 0, 0)


@lru_cache(1 << 16)
def _advanced(vector: Vector, table: Table) -> tuple[int, Vector]:
    """What the cheapest way grows by, and the vector after a table, its least cost taken off."""
    costs, ranks = vector
    found, keys = [_NEVER] * 4, [(9, 9)] * 4
    for q in range(4):
        for p in range(4):
            cost = costs[p] + table[0][p][q]
            if cost < _NEVER and (cost, ranks[p], table[1][p][q]) < (found[q], *keys[q]):
                found[q], keys[q] = cost, (ranks[p], table[1][p][q])
    least = min(found)
    order = sorted(keys[q] for q in range(4) if found[q] < _NEVER)
    kept = tuple(c - least if c - least <= _HOPELESS else _NEVER for c in found)
    return least, (kept, tuple(order.index(keys[q]) if found[q] < _NEVER else 9 for q in range(4)))


@lru_cache(1 << 16)
def _retreated(costs: tuple[int, ...], table: Table) -> tuple[int, tuple[int, ...]]:
    """The same backwards: costs from each state to the end, before a table."""
    found = [min(table[0][p][q] + costs[q] for q in range(4)) for p in range(4)]
    least = min(found)
    return least, tuple(c - least if c - least <= 2 * _HOPELESS else _NEVER for c in found)


def _forward(state: int, tables: Iterable[Table]) -> tuple[int, Vector]:
    total, vector = 0, _from(state)
    for table in tables:
        more, vector = _advanced(vector, table)
        total += more
    return total, vector


def summed(tables: list[Table]) -> Table:
    """One table for several in a row."""
    rows = []
    for p in range(4):
        total, (costs, ranks) = _forward(p, tables)
        rows.append((tuple(total + c if c < _NEVER else _NEVER for c in costs), ranks))
    return tuple(c for c, _ in rows), tuple(r for _, r in rows)


def crossings(tables: list[Table], start: int, end: int) -> list[int]:
    """The states of the cheapest way of the least audit, before the first table and after each."""
    states = [start] + [end] * len(tables)
    open_parts = [(0, len(tables))]
    while open_parts:
        low, high = open_parts.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        _, (ahead, ranks) = _forward(states[low], tables[low:middle])
        behind = _from(states[high])[0]
        for table in reversed(tables[middle:high]):
            _, behind = _retreated(behind, table)
        states[middle] = min(range(4), key=lambda q: (min(ahead[q] + behind[q], _NEVER), ranks[q]))
        open_parts += [(low, middle), (middle, high)]
    return states


def _last(table: Table) -> tuple[int, int, int]:
    """(cost, state, turns inserted at the very end) of a whole conversation."""
    costs, ranks = table[0][START], table[1][START]
    tails = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
    cost, _, state = min((costs[q] + INSERT * tails[q], ranks[q], q) for q in range(4))
    return cost, state, tails[state]


def _roles(state: int, inserted: int) -> tuple[list[str], int]:
    """Roles of turns inserted after a state, and the state they lead to."""
    names = []
    for _ in range(inserted):
        state = _after(state)
        names.append(_NAMES[state])
    return names, state


# --- on Spark ----------------------------------------------------------------------------------


def same_key(one: DataFrame, two: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join in which a null key equals a null one."""
    renamed = two.select(*(F.col(c).alias(f"_two_{c}" if c in keys else c) for c in two.columns))
    on = [F.col(k).eqNullSafe(F.col(f"_two_{k}")) for k in keys]
    return one.join(renamed, on, how).drop(*(f"_two_{k}" for k in keys))


def _tail(text: Column) -> Column:
    """The last character that is no white space."""
    return F.substring(F.rtrim(text, F.lit(SPACE)), -1, 1)


def find_faults(turns: DataFrame) -> DataFrame:
    """The distinct rows of ``turns`` (conv_id, turn, role, text): place, the row, copies, fault.

    Places ascend with conv_id, turn, role and text, nulls first. Equal rows are one row with its
    number of copies, and all copies but the first are duplicates. The fault is "blank" (nothing but
    white space), "duplicate" (role and text stand earlier in the conversation), "truncated" (the
    last character is no full stop, exclamation or question mark) or null, the first that holds.
    Null role or text is one space; other columns are ignored.
    """
    read = turns.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    once = staged(read.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")), "turns")
    said = ["conv_id", "role", "text"]
    first = once.groupBy(*said).agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("first"))
    placed = same_key(once, first, said)
    blank = F.rtrim(F.col("text"), F.lit(SPACE)) == ""
    fault = F.when(blank, "blank").when(~F.col("turn").eqNullSafe(F.col("first.turn")), "duplicate")
    fault = fault.when(~_tail(F.col("text")).isin(".", "!", "?"), "truncated")
    rows = placed.select(*once.columns, fault.alias("fault"))
    ranked = rows.orderBy(*(F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")))
    return staged(ranked.select(F.monotonically_increasing_id().alias("place"), *rows.columns), "faults")


def _kind(fault: Column, role: Column) -> Column:
    number = reduce(lambda other, k: F.when(role.startswith(_INITIALS[k]), k).otherwise(other), range(3), F.lit(3))
    return (3 * number + F.when(fault.isin("blank", "duplicate"), 2).when(fault == "truncated", 1).otherwise(0)).cast("int")


_TABLE = "costs array<long>, ranks array<int>, first string, last string, illegal long, extra long"
_LEGAL = ("su", "ua", "au")


def _packed(table: Table) -> dict:
    return {"costs": [c for row in table[0] for c in row], "ranks": [r for row in table[1] for r in row]}


def _unpacked(row: dict) -> Table:
    costs, ranks = row["costs"], row["ranks"]
    return tuple(tuple(costs[4 * p : 4 * p + 4]) for p in range(4)), tuple(tuple(ranks[4 * p : 4 * p + 4]) for p in range(4))


def _met(parts: list[dict]) -> dict:
    """First and last role initial, pairs out of turn, and prices of copies, of parts in a row."""
    between = sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(parts, parts[1:]))
    return {
        "first": parts[0]["first"],
        "last": parts[-1]["last"],
        "illegal": between + sum(p["illegal"] for p in parts),
        "extra": sum(p["extra"] for p in parts),
    }


def _mapped(df: DataFrame, schema: str, make) -> DataFrame:
    """``make`` for every row: a dictionary in, a list of dictionaries out."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in range(batch.num_rows):
                held += make(batch.slice(row, 1).to_pylist()[0])
                if len(held) >= HELD_ROWS:
                    yield pa.RecordBatch.from_pylist(held, arrow)
                    held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, arrow)

    return df.mapInArrow(run, schema)


def _leaf(row: dict) -> list[dict]:
    turns = row["parts"]
    said = [
        {"first": t["initial"], "last": t["initial"], "illegal": t["copies"] - 1, "extra": DELETE * (t["copies"] - 1)}
        for t in turns
    ]
    return [{"conv": row["conv"], "node": row["node"]} | _packed(summed([turn_table(t["kind"]) for t in turns])) | _met(said)]


def _inner(row: dict) -> list[dict]:
    table = summed([_unpacked(p) for p in row["parts"]])
    return [{"conv": row["conv"], "node": row["node"]} | _packed(table) | _met(row["parts"])]


def _rooted(row: dict) -> list[dict]:
    cost, state, tail = _last(_unpacked(row))
    known = {k: row[k] for k in ("conv", "node", "illegal")}
    return [known | {"start": START, "end": state, "tail": tail, "cost": cost + row["extra"]}]


def _passed_down(row: dict) -> list[dict]:
    parts = row["parts"]
    states = crossings([_unpacked(p) for p in parts], row["start"], row["end"])
    return [
        {"conv": row["conv"], "node": p["node"], "start": states[k], "end": states[k + 1], "tail": row["tail"] * (k == len(parts) - 1)}
        for k, p in enumerate(parts)
    ]


def _edited(row: dict) -> list[dict]:
    turns = row["parts"]
    states = crossings([turn_table(t["kind"]) for t in turns], row["start"], row["end"])
    found = []
    for k, turn in enumerate(turns):
        edits = _ways(turn["kind"])[states[k], states[k + 1]][1]
        before, _ = _roles(states[k], len(edits) - 1)
        after, _ = _roles(states[k + 1], row["tail"] if k == len(turns) - 1 else 0)
        new = _NAMES[states[k + 1]] if edits[-1] == "R" else None
        found.append({"place": turn["place"], "edits": edits, "before": before, "rerole": new, "after": after})
    return found


def repair(faults: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edits of each row of ``find_faults``, and (conv_id, illegal, cost) of each conversation.

    Edits: all columns of ``faults``; ``edits``, the initials of the turns inserted before the row
    (I) and of what happens to it (Keep, Rerole, Delete; further copies are deleted);
    ``before`` and ``after``, the roles of the turns inserted there; ``new_role``, null if deleted.
    Roles go by their first letter; one that begins with none of s, u and a is rerole or delete. A
    null conv_id is a conversation. No rows give no rows.
    """
    keyed = faults.withColumn("conv", F.struct("conv_id"))
    initial = F.substring("role", 1, 1).alias("initial")
    turn = F.struct("place", _kind(F.col("fault"), F.col("role")).alias("kind"), initial, "copies")
    node = F.shiftright("place", FAN).alias("node")
    conv = faults.schema["conv_id"].dataType.simpleString()
    key = f"conv struct<conv_id: {conv}>, node long"
    leaves = staged(keyed.groupBy("conv", node).agg(F.array_sort(F.collect_list(turn)).alias("parts")), "blocks")
    levels = [(leaves, staged(_mapped(leaves, f"{key}, {_TABLE}", _leaf), "tables"))]
    while True:
        tables = levels[-1][1]
        many = tables.groupBy("conv").agg(F.count("*").alias("n")).filter("n > 1").limit(1)
        if many.isEmpty():
            break
        part = F.struct("node", *(F.col(c) for c in tables.columns[2:]))
        above = tables.groupBy("conv", F.shiftright("node", FAN).alias("node"))
        inner = staged(above.agg(F.array_sort(F.collect_list(part)).alias("parts")), "blocks")
        levels.append((inner, staged(_mapped(inner, f"{key}, {_TABLE}", _inner), "tables")))
    ends = "start int, end int, tail int"
    roots = staged(_mapped(levels[-1][1], f"{key}, illegal long, {ends}, cost long", _rooted), "roots")
    asked = roots.select("conv", "node", "start", "end", "tail")
    for inner, _ in reversed(levels[1:]):
        asked = staged(_mapped(inner.join(asked, ["conv", "node"]), f"{key}, {ends}", _passed_down), "crossings")
    made = "place long, edits string, before array<string>, rerole string, after array<string>"
    found = _mapped(leaves.join(asked, ["conv", "node"]), made, _edited)
    edits = faults.join(found, "place")
    new = F.when(F.col("edits").endswith("K"), F.col("role")).otherwise(F.col("rerole"))
    edits = edits.select(*faults.columns, "edits", "before", "after", new.alias("new_role"))
    return staged(edits, "edits"), roots.select("conv.conv_id", "illegal", "cost")


DIGEST = "conv struct<conv_id: {0}>, audit string, repaired_sha256 string"


def digests(edits: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256): all edits of a conversation in order, and the hash of its
    turns after them, "role:text" joined by line ends; inserted turns have no text.

    A hash reads a conversation from its first turn to its last, so one task streams it, sorted by
    Spark on disk where it is large; only the audit is held, a letter a turn.
    """
    conv = edits.schema["conv_id"].dataType.simpleString()
    schema = DIGEST.format(conv)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, audit, hashed, begun = None, [], hashlib.sha256(), False

        def done() -> pa.RecordBatch:
            row = {"conv": now, "audit": "".join(audit), "repaired_sha256": hashed.hexdigest()}
            return pa.RecordBatch.from_pylist([row], arrow)

        for batch in batches:
            for row in batch.to_pylist():
                if row["conv"] != now:
                    if now is not None:
                        yield done()
                    now, audit, hashed, begun = row["conv"], [], hashlib.sha256(), False
                audit += [row["edits"], "D" * (row["copies"] - 1), "I" * len(row["after"])]
                said = [f"{role}:" for role in row["before"]]
                if row["new_role"] is not None:
                    said.append(f"{row['new_role']}:{row['text']}")
                for turn in said + [f"{role}:" for role in row["after"]]:
                    hashed.update((b"\n" if begun else b"") + turn.encode())
                    begun = True
        if now is not None:
            yield done()

    keyed = edits.select(F.struct("conv_id").alias("conv"), "place", "edits", "copies", "before", "new_role", "text", "after")
    placed = keyed.repartition("conv").sortWithinPartitions("conv", "place")
    return placed.mapInArrow(run, schema).select("conv.conv_id", "audit", "repaired_sha256")


def counted(faults: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated): how often each fault comes, and how many turn
    numbers are missing between the first and the last."""
    copies = F.col("copies") - 1
    blank, more = F.col("fault") == "blank", F.col("fault") == "duplicate"
    turns = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")

    def total(count: Column) -> Column:
        return F.sum(count).cast("long")

    return faults.groupBy("conv_id").agg(
        F.coalesce(turns, F.lit(0)).cast("long").alias("gaps"),
        total(F.when(blank, F.col("copies")).otherwise(0)).alias("blank"),
        total(F.when(more, F.col("copies")).when(blank, 0).otherwise(copies)).alias("duplicate"),
        total(F.when(F.col("fault") == "truncated", 1).otherwise(0)).alias("truncated"),
    )


def audited(conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``: what was found and done in its ``turns``."""
    faults = find_faults(turns)
    edits, costs = repair(faults)
    found = conversations.select("conv_id").distinct()
    for part in (counted(faults), costs, digests(edits)):
        found = same_key(found, part, ["conv_id"], "left")
    zeros = {c: F.coalesce(c, F.lit(0)) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    nothing = hashlib.sha256().hexdigest()
    return found.withColumns(
        zeros | {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.lit(nothing))}
    )
