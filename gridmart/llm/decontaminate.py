"""Benchmark decontamination with a generalised suffix automaton.

The normalised benchmark items are the strings of one automaton over words. Training texts stream
through it word by word; the length of the longest item substring that ends at a word is tracked.
Where that length reaches a window (ten words, or the whole of a shorter item) the window's words
are hit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import staged

WINDOW = 10
#: Item words of one automaton; a larger benchmark makes more automata, one pass each.
AUTOMATON_WORDS = 200_000

#: Byte by byte: A-Z to lower case, what is no part of a word to a blank; UTF-8 beyond ASCII stays.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


@dataclass
class Automaton:
    """Suffix automaton of several word sequences; state 0 is the root."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    follow: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])

    def _extend(self, last: int, word: int) -> int:
        """State of the sequence at ``last`` followed by ``word``."""
        follow, link, length = self.follow, self.link, self.length
        known = follow[last].get(word)
        if known is not None:
            if length[known] == length[last] + 1:
                return known
            return self._split(last, known, word)
        new = len(follow)
        follow.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and word not in follow[at]:
            follow[at][word] = new
            at = link[at]
        if at >= 0:
            known = follow[at][word]
            link[new] = known if length[known] == length[at] + 1 else self._split(at, known, word)
        return new

    def _split(self, at: int, known: int, word: int) -> int:
        clone = len(self.follow)
        self.follow.append(dict(self.follow[known]))
        self.link.append(self.link[known])
        self.length.append(self.length[at] + 1)
        self.link[known] = clone
        while at >= 0 and self.follow[at].get(word) == known:
            self.follow[at][word] = clone
            at = self.link[at]
        return clone

    def add(self, sequence: Iterable[bytes]) -> list[int]:
        """Takes a sequence in; gives the state of each of its prefixes."""
        last, states = 0, []
        for word in sequence:
            last = self._extend(last, self.vocabulary.setdefault(word, len(self.vocabulary)))
            states.append(last)
        return states


class Matcher:
    """Which words of a text lie in windows of the items, and which items those windows are of.

    ``items`` are (id, words); items without words match nothing.
    """

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.automaton = automaton = Automaton()
        prefixes = [(item, automaton.add(sequence)) for item, sequence in items if sequence]
        states = len(automaton.follow)
        #: For every state, the short items that end there as a whole, and those with a window there.
        self.whole: dict[int, set[int]] = {}
        self.windows: dict[int, set[int]] = {}
        self.shortest = window
        for item, path in prefixes:
            if len(path) < window:
                self.whole.setdefault(path[-1], set()).add(item)
                self.shortest = min(self.shortest, len(path))
            for state in path[window - 1 :]:
                self.windows.setdefault(self._suffix(state, window), set()).add(item)
        #: The nearest state on the way of suffix links, itself included, at which a short item ends.
        self.ends = [-1] * states
        for state in sorted(range(1, states), key=automaton.length.__getitem__):
            self.ends[state] = state if state in self.whole else self.ends[automaton.link[state]]
        self.get = automaton.vocabulary.get

    def _suffix(self, state: int, length: int) -> int:
        """The state that holds the suffix of ``length`` words of the strings of ``state``."""
        automaton = self.automaton
        while automaton.length[automaton.link[state]] >= length:
            state = automaton.link[state]
        return state

    def match(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit spans of ``text`` (disjoint, word numbers) and the items found.

        A word that no item has ends every match, so only stretches of known words, at least as
        long as the shortest window, are streamed through the automaton.
        """
        get = self.get
        known = np.fromiter((get(w, -1) for w in text), np.int64, len(text))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (known >= 0).view(np.int8), [0]])))
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - start >= self.shortest:
                self._stream(known[start:end].tolist(), start, spans, items)
        return spans, items

    def _stream(self, stretch: list[int], offset: int, spans: list[tuple[int, int]], items: set[int]) -> None:
        follow, link, length = self.automaton.follow, self.automaton.link, self.automaton.length
        window, state, matched = self.window, 0, 0
        for at, word in enumerate(stretch, offset + 1):
            while word not in follow[state]:
                state = link[state]
                matched = length[state]
            state = follow[state][word]
            matched += 1
            hit = 0
            if matched >= window:
                found = self._suffix(state, window)
                items |= self.windows[found]
                hit = window
            ending = self.ends[state]
            while ending > 0:
                if (size := length[ending]) <= matched:  # a short item is the longest string of its state
                    items |= self.whole[ending]
                    hit = max(hit, size)
                ending = self.ends[link[ending]]
            if hit:
                begin = at - hit
                while spans and spans[-1][1] >= begin:
                    begin = min(begin, spans.pop()[0])
                spans.append((begin, at))


def load_items(benchmark: DataFrame, automaton_words: int = AUTOMATON_WORDS) -> list[DataFrame]:
    """``benchmark`` (item_id, text) in parts of about ``automaton_words`` words by a bound of their bytes."""
    held = benchmark.select("item_id", "text")
    size = held.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // (2 * automaton_words)) or 1
    if parts == 1:
        return [held]
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    return [held.filter(part == n) for n in range(parts)]


FOUND = "array<struct<start:int,end:int>>"


def find_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with n_words, hit_spans (word numbers) and hit_items; all columns stay.

    Words are runs of ASCII letters, digits and everything beyond ASCII, with A-Z in lower case.
    Null or empty texts have no words. Items without an id or without words are never found;
    items that repeat an id count once. Columns of ``docs`` of the three names are replaced.
    """
    docs = docs.drop("n_words", "hit_spans", "hit_items")
    parts = load_items(benchmark)
    if len(parts) == 1:
        return _searched(docs, parts[0], window)[0]
    # the driver and the tasks hold one part at a time: its hits are written before the next is fetched
    numbered = staged(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    hits = []
    for number, part in enumerate(parts):
        found, sent = _searched(numbered.select("_row", "text"), part, window)
        rows = found.select("_row", *_HITS)
        hits.append(staged(rows if number == 0 else rows.filter(F.size("hit_spans") > 0), "hits"))
        sent.destroy()
    every = reduce(DataFrame.unionByName, hits).groupBy("_row").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("hit_spans")).alias("hit_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_items")))).alias("hit_items"),
    )
    together = every.mapInArrow(_joined_spans, every.schema)
    return numbered.join(together, "_row").select(*docs.columns, *_HITS)


_HITS = ("n_words", "hit_spans", "hit_items")


def _search(spark, part: DataFrame, window: int):
    """What finds the hits of one part of the benchmark in batches, and the broadcast that holds it."""
    items = [(r["item_id"], words((r["text"] or "").encode())) for r in part.collect() if r["item_id"] is not None]
    sent = spark.sparkContext.broadcast(items)
    return _pass(sent, window), sent


def _searched(docs: DataFrame, part: DataFrame, window: int):
    """``docs`` with what one part of the benchmark hits, and the broadcast that holds the part."""
    none = {"n_words": F.lit(0).cast("long"), "hit_spans": F.array().cast(FOUND), "hit_items": F.array().cast("array<long>")}
    search, sent = _search(docs.sparkSession, part, window)
    return docs.mapInArrow(search, docs.withColumns(none).schema), sent


def _joined_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("hit_spans")
        spans = [_merged([(s["start"], s["end"]) for s in row]) for row in batch["hit_spans"].to_pylist()]
        joined = pa.array([[{"start": a, "end": b} for a, b in row] for row in spans], _SPANS)
        yield batch.set_column(at, batch.schema.field(at).with_type(_SPANS), joined)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _pass(sent, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(sent.value, window)
        for batch in batches:
            counts, spans, items = [], [], []
            for value in batch["text"].cast(pa.large_binary()):
                text = words(value.as_py() or b"")
                new, new_items = matcher.match(text)
                counts.append(len(text))
                spans.append([{"start": a, "end": b} for a, b in _merged(new)])
                items.append(sorted(new_items))
            found = [pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, *_HITS])

    return run


def items_digest(items: list[int]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, longest: int = 0, coverage: float = 0.5
) -> DataFrame:
    """``docs`` without what they share with the benchmark; the columns stay as they are.

    Hit spans of more than ``longest`` words leave the text, with what stands between their words;
    a document whose hit words are more than ``coverage`` of all its words goes as a whole.
    Documents without a hit stay untouched, null and empty ones included.
    """
    # the other columns travel in a struct, where the columns that are added cannot cover them
    named = docs.select("text", F.struct(*docs.columns).dropFields("text").alias("_others"))
    columns = named.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = [[(s["start"], s["end"]) for s in spans] for spans in batch["hit_spans"].to_pylist()]
            most = [n * coverage for n in batch["n_words"].to_pylist()]
            rest = batch.select(columns)
            texts = {k: batch["text"][k].as_py() for k, spans in enumerate(hit) if spans}
            if texts:
                kept = [sum(b - a for a, b in spans) <= n for spans, n in zip(hit, most, strict=True)]
                new = [remove_words(texts[k], spans, longest) if spans else None for k, spans in enumerate(hit)]
                left = pc.if_else(pa.array([bool(s) for s in hit]), pa.array(new, rest["text"].type), rest["text"])
                rest = rest.set_column(0, rest.schema.field(0), left).filter(pa.array(kept))
            yield rest

    parts = load_items(benchmark)
    if len(parts) > 1:
        left = find_spans(named, benchmark, window).mapInArrow(cut, named.schema)
    else:
        # found and cut by the same worker
        search, _ = _search(docs.sparkSession, parts[0], window)
        left = named.mapInArrow(lambda batches: cut(search(batches)), named.schema)
    return left.select(*(c if c == "text" else F.col("_others")[c].alias(c) for c in docs.columns))


def remove_words(text: str, spans: list[tuple[int, int]], longest: int = 0) -> str:
    """``text`` without the words of ``spans`` and what lies between them."""
    raw = text.encode()
    mask = np.frombuffer(raw.translate(_WORD_BYTES), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    begins, ends = edges[::2], edges[1::2]
    out, at = [], 0
    for start, end in spans:
        if end - start > longest:
            out.append(raw[at : begins[start]])
            at = ends[end - 1]
    out.append(raw[at:])
    return b"".join(out).decode()
