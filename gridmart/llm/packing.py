"""Best-fit packing of tokenised documents by length patterns.

Documents longer than a sequence are cut; what remains is a histogram of piece lengths. Patterns of
up to three lengths that fill a sequence are enumerated on a coarse grid, their repeat counts are
fitted to the histogram by non-negative least squares and rounded down, and what they leave is
packed best-fit, longest first, into the gaps and into new sequences. All of this handles counts
of lengths, at most one line per length, whatever the number of documents; the pieces then find
their places by their rank among pieces of their length.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridmart.llm.common import staged

SEQUENCE = 2048
#: Lengths are fitted in steps of a sequence divided by this.
GRID = 64
#: Pieces of one length are ranked in at least this many groups.
RANK_GROUPS = 64
RANKED_ROWS = 50_000
SEPARATOR = 0


# --- tokens ------------------------------------------------------------------------------------


class Tokens:
    """Token ids as little-endian unsigned 32-bit bytes.

    The byte-pair vocabulary is that of ``byte_bpe_50k.json``, read from its ranks; the special
    token's string in a text is the special token, as the vocabulary file says.
    """

    def __init__(self, ranks_path: str, special: str = "<|endoftext|>", special_id: int = 50256):
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={special: special_id}
        )
        self.special = special

    def ids(self, text: str) -> bytes:
        if self.special in text:
            return array("I", self.encoding.encode(text, allowed_special="all")).tobytes()
        return array("I", self.encoding.encode_ordinary(text)).tobytes()


_PIECES = pa.schema(
    [(n, pa.int64()) for n in ("doc_id",)]
    + [("piece", pa.int32())]
    + [(n, pa.int64()) for n in ("start", "length", "ids_crc32")]
)


def tokenised_pieces(docs: DataFrame, ranks_path: str, sequence: int = SEQUENCE) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's tokens and a closing 0.

    Only documents longer than a sequence are cut: every piece but the first is a whole sequence.
    Null text is empty, so each row gives one piece at least. Rows that repeat give theirs again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(ranks_path)
        closing = array("I", [SEPARATOR]).tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = memoryview(tokens.ids(text.as_py() or "") + closing)
                total = len(ids) // 4
                start, end, piece = 0, total % sequence or sequence, 0
                while start < total:
                    rows.append((doc_id, piece, start, end - start, zlib.crc32(ids[4 * start : 4 * end])))
                    start, end, piece = end, end + sequence, piece + 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


# --- patterns over counts ----------------------------------------------------------------------


def patterns(grid: int) -> list[tuple[int, ...]]:
    """Up to three steps, largest first, that add up to ``grid``."""
    out = [(grid,)]
    out += [(grid - b, b) for b in range(1, grid // 2 + 1)]
    out += [(grid - b - c, b, c) for c in range(1, grid // 3 + 1) for b in range(c, (grid - c) // 2 + 1)]
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """x >= 0 that minimises |ax - b|, by active sets: the variable that helps most enters, those
    that a least-squares step would make negative leave."""
    gram, target = a.T @ a, a.T @ b
    x = np.zeros(a.shape[1])
    free = np.zeros(a.shape[1], bool)
    enough = 1e-9 * max(1.0, np.abs(target).max(initial=0.0))
    for _ in range(rounds or 3 * a.shape[0]):
        gain = np.where(free, -np.inf, target - gram @ x)
        best = int(gain.argmax())
        if gain[best] <= enough:
            break
        free[best] = True
        while True:
            inside = np.flatnonzero(free)
            step = _solve(gram[np.ix_(inside, inside)], target[inside])
            if step.min(initial=1.0) > 0:
                x[inside] = step
                break
            now = x[inside]
            down = step <= 0
            reach = (now[down] / np.maximum(now[down] - step[down], 1e-300)).min()
            x[inside] = np.maximum(now + reach * (step - now), 0)
            free &= x > 1e-12
            x[~free] = 0
    return x


def _solve(gram: np.ndarray, target: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(gram, target)
    except np.linalg.LinAlgError:  # patterns that depend on each other
        return np.linalg.lstsq(gram, target, rcond=None)[0]


@dataclass
class Filled:
    """``times`` sequences that all hold pieces of these lengths."""

    lengths: tuple[int, ...]
    times: int


class _Stock:
    """Counts of pieces by length, with the largest length that fits a room."""

    def __init__(self, counts: dict[int, int]):
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.lengths = sorted(self.left)

    def fitting(self, room: int, least: int = 1) -> int | None:
        at = bisect_left(self.lengths, room + 1) - 1
        return self.lengths[at] if at >= 0 and self.lengths[at] >= least else None

    def take(self, length: int, times: int) -> None:
        self.left[length] -= times
        if not self.left[length]:
            del self.left[length]
            self.lengths.remove(length)


def plan(counts: dict[int, int], sequence: int = SEQUENCE, grid: int = GRID) -> list[Filled]:
    """Sequences that hold every piece counted in ``counts`` (length: number) just once."""
    grid = min(grid, sequence)
    step = sequence / grid
    stock = _Stock({n: c for n, c in counts.items() if n < sequence})
    done = [Filled((sequence,), counts[sequence])] if counts.get(sequence) else []
    for steps, times in _repeats(stock.left, sequence, grid):
        while times:
            chosen: list[int] = []
            held = Counter()
            for k, part in enumerate(steps):
                room = sequence - sum(chosen)
                last = k == len(steps) - 1
                length = stock.fitting(room if last else min(room, int(part * step)), int((part - 1) * step) + 1)
                if length is None or held[length] >= stock.left[length]:
                    break
                chosen.append(length)
                held[length] += 1
            if len(chosen) < len(steps):
                break  # rounding and earlier patterns have used these up: best fit takes the rest
            repeat = min(times, *(stock.left[n] // c for n, c in held.items()))
            for length, c in held.items():
                stock.take(length, c * repeat)
            done.append(Filled(tuple(chosen), repeat))
            times -= repeat
    return _best_fit(stock, done, sequence)


def _repeats(counts: dict[int, int], sequence: int, grid: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with their fitted and rounded repeat counts, the most wanted first."""
    if not counts:
        return []
    wanted = np.zeros(grid)
    for length, count in counts.items():
        wanted[-(-length * grid // sequence) - 1] += count
    known = [p for p in patterns(grid) if all(wanted[s - 1] for s in p)]
    if not known:
        return []
    a = np.zeros((grid, len(known)))
    for k, steps in enumerate(known):
        for s in steps:
            a[s - 1, k] += 1
    used = wanted > 0
    # what is rare must not be fitted worse than what is frequent
    weight = 1 / np.sqrt(wanted[used])
    times = np.floor(nnls(a[used] * weight[:, None], wanted[used] * weight) + 1e-6).astype(int)
    return sorted(((known[k], int(n)) for k, n in enumerate(times) if n), key=lambda p: (-p[1], p[0]))


def _best_fit(stock: _Stock, done: list[Filled], sequence: int) -> list[Filled]:
    """Packs what is left, longest first, each into the smallest room that takes it."""
    rooms: dict[int, list[Filled]] = {}
    open_rooms: list[int] = []

    def offer(filled: Filled) -> None:
        room = sequence - sum(filled.lengths)
        if room not in rooms:
            rooms[room] = []
            insort(open_rooms, room)
        rooms[room].append(filled)

    for filled in done:
        offer(filled)
    for length in sorted(stock.left, reverse=True):
        left = stock.left[length]
        while left:
            at = bisect_left(open_rooms, length)
            if at == len(open_rooms):
                each = sequence // length
                for lengths, times in (((length,) * each, left // each), ((length,) * (left % each), 1)):
                    if lengths and times:
                        offer(Filled(lengths, times))
                break
            room = open_rooms[at]
            filled = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                open_rooms.pop(at)
            each = min(room // length, max(1, left // filled.times))
            times = min(filled.times, left // each)
            if times < filled.times:
                offer(Filled(filled.lengths, filled.times - times))
            offer(Filled(filled.lengths + (length,) * each, times))
            left -= times * each
    return [filled for held in rooms.values() for filled in held]


# --- places ------------------------------------------------------------------------------------


def _slots(filled: list[Filled]) -> np.ndarray:
    """Rows (length, first rank, pieces a sequence, first sequence, offset), sorted."""
    rows, ranks, sequence = [], Counter(), 0
    for group in filled:
        offset = 0
        for length, each in Counter(group.lengths).items():
            rows.append((length, ranks[length], each, sequence, offset))
            ranks[length] += each * group.times
            offset += each * length
        sequence += group.times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``pieces`` (doc_id, piece, length, others) with sequence_id and offset.

    Every sequence is filled from 0 without gaps. Pieces of equal length are interchangeable;
    they are ranked in groups that keep a frequent length spread: by a column _row of distinct
    numbers where there is one, else by all columns. Lengths run from 1 to ``sequence``. No pieces give no rows.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(_slots(plan(counts, sequence)))
    groups = max(RANK_GROUPS, -(-sum(counts.values()) // RANKED_ROWS))
    told = ["_row"] if "_row" in pieces.columns else pieces.columns
    grouped = pieces.withColumn("_group", F.pmod(F.xxhash64(*told), F.lit(groups)).cast("int"))
    sizes = grouped.groupBy("length", "_group").agg(F.count("*").alias("_n"))
    before = W.partitionBy("length").orderBy("_group").rowsBetween(W.unboundedPreceding, -1)
    firsts = sizes.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = W.partitionBy("length", "_group").orderBy(*told)
    ranked = grouped.withColumn("_place", F.row_number().over(own) - 1).join(firsts, ["length", "_group"])
    ranked = ranked.withColumn("_rank", F.col("_first") + F.col("_place"))
    placed = ranked.withColumn("_place", _place_of(slots)("length", "_rank"))
    return placed.select(*pieces.columns, "_place.sequence_id", "_place.offset")


def _place_of(slots):
    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        table = slots.value
        keys = (table[:, 0] << 48) + table[:, 1]
        found = table[np.searchsorted(keys, (length.to_numpy() << 48) + rank.to_numpy(), side="right") - 1]
        behind = rank.to_numpy() - found[:, 1]
        each = found[:, 2]
        return pd.DataFrame(
            {"sequence_id": found[:, 3] + behind // each, "offset": found[:, 4] + behind % each * found[:, 0]}
        )

    return place


def pack_documents(docs: DataFrame, ranks_path: str, sequence: int = SEQUENCE) -> DataFrame:
    """Tokenises ``docs`` once, into a table of pieces in the shared folder, and packs the pieces."""
    pieces = tokenised_pieces(docs, ranks_path, sequence)
    # rows that repeat an id, or have none, are told apart by their number
    numbered = staged(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    return pack(numbered, sequence).drop("_row")
