"""Chat formatting by incremental black-box rendering.

A template is only known through ``render(turns) -> text``. Rendering the prefixes of one, two,
three ... turns and comparing consecutive outputs locates each turn: it is what the output grew by.
Where an output does not begin with the one before, the template has rewritten history.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

#: The strings that structure a formatted conversation.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[OUT]", "[ROLE]", "[/ROLE]")

_CONTROLS = "|".join(map(re.escape, CONTROL))
_IN_TEXT = re.compile(rf"\\*(?:{_CONTROLS})")
_ESCAPED = re.compile(rf"\\(\\*(?:{_CONTROLS}))")
_TURN = re.compile(
    r"<s>\[INST\] (?P<user>.*?) \[/INST\]\n"
    r"|\[OUT\] (?P<assistant>.*?) </s>\n"
    r"|\[ROLE\] (?P<role>.*?) \[/ROLE\] (?P<other>.*?) </s>\n",
    re.DOTALL,
)

Turn = tuple[str, str]


class BracketTemplate:
    """Bracketed turns. A control string inside a text gets one more backslash in front, whatever
    number it has already, so a bare control string is always the template's own."""

    @staticmethod
    def escape(text: str) -> str:
        return _IN_TEXT.sub(r"\\\g<0>", text)

    @staticmethod
    def unescape(text: str) -> str:
        return _ESCAPED.sub(r"\1", text)

    def turn(self, role: str, text: str) -> str:
        body = self.escape(text)
        if role == "user":
            return f"<s>[INST] {body} [/INST]\n"
        if role == "assistant":
            return f"[OUT] {body} </s>\n"
        return f"[ROLE] {self.escape(role)} [/ROLE] {body} </s>\n"

    def render(self, turns: list[Turn]) -> str:
        return "".join(self.turn(role, text) for role, text in turns)

    def parse(self, output: str) -> list[Turn]:
        """The turns an output holds; raises when something is left over."""
        found, at = [], 0
        while at < len(output):
            match = _TURN.match(output, at)
            if not match:
                raise ValueError(f"no turn at character {at}")
            kind = match.lastgroup
            role = self.unescape(match["role"]) if kind == "other" else kind
            found.append((role, self.unescape(match[kind])))
            at = match.end()
        return found


@dataclass
class Trace:
    """What successive renderings show of one conversation."""

    output: str = ""
    spans: list[tuple[int, int]] = field(default_factory=list)
    texts: list[tuple[int, int] | None] = field(default_factory=list)
    rewritten_at: list[int] = field(default_factory=list)


def _shared(left: str, right: str, start: int = 0) -> int:
    """Length of the longest common prefix, known to reach ``start``."""
    low, high = start, min(len(left), len(right))
    while low < high:
        middle = (low + high + 1) // 2
        if left[low:middle] == right[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def trace(template, turns: list[Turn], learn: Iterable[str] = ("assistant",)) -> Trace:
    """Renders every prefix of ``turns`` and locates each turn, and the text of the learned ones.

    The text inside a turn is found by rendering two probes in its place: what both share on
    the left and on the right belongs to the template. A conversation whose template rewrites
    history gets no text spans: no place of an early output is sure to hold in the last one.
    The renderings cost the square of one conversation's turns.
    """
    seen = Trace()
    learn = frozenset(learn)
    for k, (role, _) in enumerate(turns):
        output = template.render(turns[: k + 1])
        start = len(seen.output)
        if not output.startswith(seen.output):
            seen.rewritten_at.append(k)
            start = _shared(seen.output, output)
        seen.spans.append((start, len(output)))
        place = None
        if role in learn:
            left, right = (template.render([*turns[:k], (role, probe)]) for probe in "ab")
            head = _shared(left, right)
            tail = _shared(left[head:][::-1], right[head:][::-1])
            place = (head, len(output) - tail)
        seen.texts.append(place)
        seen.output = output
    if seen.rewritten_at:
        seen.texts = [None] * len(turns)
    return seen


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[Turn]]]:
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for conv, members in groupby(rows, key=lambda row: row[0]):
        yield conv, [(role or "", text or "") for _, role, text in members]


FORMATTED = (
    "conv_id long, n_turns long, formatted string, "
    "turns array<struct<role:string,start:long,end:long,text_start:long,text_end:long>>, rewritten_at array<int>"
)


def format_conversations(turns: DataFrame, template=None, learn: Iterable[str] = ("assistant",)) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text; further columns are ignored).

    ``turns`` of the result holds each turn's span of ``formatted`` and, for the roles in
    ``learn``, that of its (escaped) text, all in code points. ``rewritten_at`` lists turns at
    which the template changed what it had written before.

    Turns are ordered by number, ties by role and text; a repeated row is a further turn. A null
    text or role counts as empty, null numbers come first, rows without conv_id form one
    conversation. No rows give no rows.
    """
    template = template or BracketTemplate()
    learn = tuple(learn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for conv, members in _conversations(batches):
            seen = trace(template, members, learn)
            places = [
                {"role": role, "start": a, "end": b, "text_start": t and t[0], "text_end": t and t[1]}
                for (role, _), (a, b), t in zip(members, seen.spans, seen.texts, strict=True)
            ]
            rows.append((conv, len(members), seen.output, places, seen.rewritten_at))
            if len(rows) == 256:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    ordered = (
        turns.select("conv_id", "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )
    return ordered.mapInArrow(run, FORMATTED)


_PLACE = pa.struct(
    [("role", pa.string()), *((n, pa.int64()) for n in ("start", "end", "text_start", "text_end"))]
)
_SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("formatted", pa.string()),
        ("turns", pa.list_(_PLACE)),
        ("rewritten_at", pa.list_(pa.int32())),
    ]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)
