"""Interpolated modified Kneser-Ney n-gram model, counted by Spark and mapped into memory by workers.

Tokens are 64-bit hashes of words. Tasks count the n-grams of what they read and send sorted runs of
counts to shards; a shard adds them up and writes its hashes, sorted, beside their counts to a file in
the shared folder. From the same counts it sends the next lower order: how many different words
precede each shorter n-gram. Scoring tasks map the files and look their n-grams up in order of the
hashes, so that a look-up sweeps a shard instead of jumping about in it.

A shard holds all continuations of its contexts, so that sums over a context need no further shuffle.
Contexts that end in one of the most frequent words are spread over all shards by n-gram instead; the
few sums of theirs are added up apart.
"""

from __future__ import annotations

import os
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import staged
from gridmart.llm.minhash import _mix, _powers
from gridmart.session import scratch_path

BEGIN, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
#: Bytes hashed at once, and bytes of text a shard stands for.
PIECE_BYTES = 2 << 20
SHARD_BYTES = 16 << 20
#: Tokens a task counts, or looks up, at once.
RUN_TOKENS = 1_000_000
#: Texts of the sample that names frequent words, and the part of a shard's share that makes a word one.
SAMPLED_TEXTS = 2_000
HOT_SHARE = 0.1
#: Shard files a worker keeps mapped.
MAPPED = 256

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_INSIDE = np.ones(256, bool)
_INSIDE[[0x20, *range(0x09, 0x0E)]] = False


# --- tokens ------------------------------------------------------------------------------------


@dataclass
class Run:
    """Token hashes of some texts: each token behind as many preceding ones as the order asks for."""

    columns: list[np.ndarray]
    rows: np.ndarray


def _hashed(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of several texts, one behind the other, and where they begin."""
    global _up, _down
    if len(_up) <= len(raw):
        n = max(PIECE_BYTES, len(raw)) + 1024
        _up, _down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
    raw = _LOWER[raw]
    inside = _INSIDE[raw]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = starts[(starts > 0) & (starts < len(raw))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw + np.uint64(1)) * _up[: len(raw)], out=sums[1:])
    return _mix((sums[end] - sums[begin]) * _down[begin] + (end - begin).astype(np.uint64) * _ODD), begin


_up = _down = np.empty(0, np.uint64)


def _pieces(texts: pa.LargeBinaryArray) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool, bool]]:
    """(first row, bytes, text starts, whether they begin and end a text): whole texts up to about a
    piece, or pieces of one longer text, cut at white space."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        size = offsets[row + 1] - offsets[row]
        if size > PIECE_BYTES:
            at, end = offsets[row], offsets[row + 1]
            first = True
            while at < end:
                cut = min(at + PIECE_BYTES, end)
                while cut < end and not len(spaces := np.flatnonzero(~_INSIDE[data[cut : min(cut + 4096, end)]])):
                    cut = min(cut + 4096, end)
                if cut < end:
                    cut += spaces[0]
                yield row, data[at:cut], np.zeros(1, np.int64), first, cut == end
                at, first = cut, False
            row += 1
        else:
            till = int(np.searchsorted(offsets, offsets[row] + PIECE_BYTES, "right")) - 1
            till = max(till, row + 1)
            yield row, data[offsets[row] : offsets[till]], offsets[row:till] - offsets[row], True, True
            row = till


def runs(texts: pa.Array, order: int) -> Iterator[Run]:
    """The tokens of texts (null: empty), each text's last one being its end."""
    filled = pc.fill_null(texts.cast(pa.large_binary()), b"")
    lead = order - 1
    carried = np.full(lead, BEGIN)
    for row, raw, starts, first, last in _pieces(filled):
        words, begin = _hashed(raw, starts)
        n = len(starts)
        text = np.searchsorted(starts, begin, "right") - 1
        # texts without a byte share their start with the next: words belong to the last of these
        counts = np.bincount(text, minlength=n)
        sizes = counts + lead + int(last)
        base = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.empty(base[-1], np.uint64)
        for k in range(lead):
            flat[base[:-1] + k] = BEGIN if first else carried[k]
        place = np.arange(len(words)) + (text + 1) * lead + text * int(last)
        flat[place] = words
        if last:
            flat[base[1:] - 1] = END
        told = np.ones(len(flat), bool)
        for k in range(lead):
            told[base[:-1] + k] = False
        at = np.flatnonzero(told)
        if lead:
            carried = flat[-lead:]
        yield Run([flat[at - lead + k] for k in range(order)], row + np.repeat(np.arange(n), counts + int(last)))


def folded(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of an n-gram; of a single word its own."""
    code = columns[0]
    for column in columns[1:]:
        code = _mix(code * _ODD + column)
    return code


# --- counting ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """How n-grams are dealt over shards."""

    order: int
    shards: int
    hot: np.ndarray
    folder: str

    def keys(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(place, hash) of n-grams: equal contexts share a place, but for those of frequent words."""
        code = folded(columns)
        if len(columns) == 1:
            return code, code
        return np.where(np.isin(columns[-2], self.hot), code, folded(columns[:-1])), code

    def shard(self, place: np.ndarray) -> np.ndarray:
        return ((place >> np.uint64(32)) * np.uint64(self.shards) >> np.uint64(32)).astype(np.int32)

    def path(self, kind: str, shard: int) -> str:
        return os.path.join(self.folder, f"{kind}-{shard}.arrow")


def _added(columns: list[np.ndarray], counts: np.ndarray | None, layout: Layout) -> tuple[list, np.ndarray, np.ndarray]:
    """Distinct n-grams in order of (place, hash), their counts and places."""
    place, code = layout.keys(columns)
    order = np.lexsort((code, place)) if place is not code else np.argsort(code)
    place, code = place[order], code[order]
    new = np.ones(len(code), bool)
    new[1:] = code[1:] != code[:-1]
    at = np.flatnonzero(new)
    ends = np.append(at[1:], len(code))
    total = ends - at if counts is None else np.add.reduceat(counts[order], at) if len(at) else counts[:0]
    return [c[order[at]] for c in columns], total.astype(np.int64), place[at]


_BLOB = pa.schema(
    {"kind": pa.string(), "shard": pa.int32(), "grams": pa.binary(), "counts": pa.binary(), "width": pa.int32()}
)
_BLOB_DDL = "kind string, shard int, grams binary, counts binary, width int"


def _blobs(kind: str, columns: list, counts: np.ndarray, place: np.ndarray, layout: Layout) -> Iterator[dict]:
    """Sorted n-grams and counts as a row for each shard."""
    shard = layout.shard(place)
    edges = np.searchsorted(shard, np.arange(layout.shards + 1))
    for k in np.unique(shard).tolist():
        a, b = edges[k], edges[k + 1]
        width = next(w for w in (1, 2, 4, 8) if int(counts[a:b].max()) < 1 << 8 * w - (w == 8))
        grams = b"".join(c[a:b].tobytes() for c in columns)
        yield {"kind": kind, "shard": k, "grams": grams, "counts": counts[a:b].astype(f"u{width}").tobytes(), "width": width}


def _read(rows: list[dict], words: int) -> tuple[list[np.ndarray], np.ndarray]:
    columns: list[list] = [[] for _ in range(words)]
    counts = []
    for row in rows:
        counts.append(np.frombuffer(row["counts"], f"u{row['width']}").astype(np.int64))
        grams = np.frombuffer(row["grams"], np.uint64).reshape(words, -1)
        for k in range(words):
            columns[k].append(grams[k])
    return [np.concatenate(c) for c in columns], np.concatenate(counts)


def _counter(layout: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        tokens = 0

        def sent() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            held.clear()
            found = _blobs("grams", *_added(columns, None, layout), layout)
            for row in found:
                yield pa.RecordBatch.from_pylist([row], _BLOB)

        for batch in batches:
            for part in runs(batch["text"], layout.order):
                held.append(part.columns)
                tokens += len(part.rows)
                if tokens >= RUN_TOKENS:
                    yield from sent()
                    tokens = 0
        if held:
            yield from sent()

    return run


def _write(path: str, arrays: dict[str, np.ndarray]) -> None:
    """One file; a repeated task puts the same content in its place."""
    table = pa.table(arrays)
    spare = f"{path}.{uuid.uuid4().hex}"
    with pa.OSFile(spare, "wb") as out, pa.ipc.new_file(out, table.schema) as writer:
        writer.write_table(table)
    os.replace(spare, path)


def _by_context(columns: list, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Of each context: the sum of its counts, and how many are 1, 2 and more."""
    code = folded(columns[:-1])
    order = np.argsort(code, kind="stable")
    new = np.ones(len(code), bool)
    new[1:] = code[order][1:] != code[order][:-1]
    at = np.flatnonzero(new)
    taken = counts[order]
    held = {"code": code[order][at], "total": np.add.reduceat(taken, at)}
    parts = (taken == 1, taken == 2, taken > 2)
    return held | {f"n{k}": np.add.reduceat(p.astype(np.int64), at) for k, p in enumerate(parts, 1)}


def _of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in range(1, 5)] + [int((counts > 2).sum()), len(counts), int(counts.sum())]


_STATS = 7


def _merger(layout: Layout, words: int):
    """Adds up a shard of n-grams of ``words`` words, writes its files, and sends what the next order
    counts, the words' own counts (highest order), sums of spread contexts and counts of counts."""

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        shard, out = rows[0]["shard"], []
        read = _read([r for r in rows if r["kind"] == "grams"], words)
        del table, rows
        columns, counts, _ = _added(*read, layout)
        _write_counts(layout.path(f"grams{words}", shard), folded(columns), counts)
        spread = np.isin(columns[-2], layout.hot)
        if not spread.all():
            sums = _by_context([c[~spread] for c in columns], counts[~spread])
            _write(layout.path(f"contexts{words}", shard), sums)
        if spread.any():
            sums = _by_context([c[spread] for c in columns], counts[spread])
            place = sums.pop("code")
            parts = np.concatenate(list(sums.values()))
            for row in _blobs("spread", [place], sums["total"], place, layout):
                inside = layout.shard(place) == row["shard"]
                row["counts"] = parts.reshape(4, -1)[:, inside].astype("u8").tobytes()
                out.append(row | {"width": 8})
        if words == layout.order:
            out += _blobs("words", *_added(columns[-1:], counts, layout), layout)
        # a text's first words have nothing before them: these count as often as they come
        opening = (columns[1] == BEGIN) if words > 2 else np.zeros(len(counts), bool)
        out += _blobs("grams", *_added(columns[1:], np.where(opening, counts, 1), layout), layout)
        stats = np.array(_of_counts(counts), np.int64)
        out.append({"kind": "stats", "shard": shard, "grams": b"", "counts": stats.tobytes(), "width": 8})
        return pa.Table.from_pylist(out, _BLOB)

    return merge


def _write_counts(path: str, code: np.ndarray, counts: np.ndarray, **more: np.ndarray) -> None:
    order = np.argsort(code)
    width = next(w for w in (1, 2, 4, 8) if not len(counts) or int(counts.max()) < 1 << 8 * w - (w == 8))
    _write(path, {"code": code[order], "count": counts[order].astype(f"u{width}")} | {k: v[order] for k, v in more.items()})


def _word_merger(layout: Layout):
    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        shard = rows[0]["shard"]
        words, counts, _ = _added(*_read([r for r in rows if r["kind"] == "words"], 1), layout)
        if layout.order > 1:
            same, before, _ = _added(*_read([r for r in rows if r["kind"] == "grams"], 1), layout)
            assert np.array_equal(same[0], words[0])
        else:
            before = counts
        _write_counts(layout.path("words", shard), words[0], before, seen=counts)
        stats = np.array([*_of_counts(before), int(counts.sum())], np.int64)
        row = {"kind": "stats", "shard": shard, "grams": b"", "counts": stats.tobytes(), "width": 8}
        return pa.Table.from_pylist([row], _BLOB)

    return merge


def _spread_merger(layout: Layout, words: int):
    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        code = np.concatenate([np.frombuffer(r["grams"], np.uint64) for r in rows])
        sums = np.concatenate([np.frombuffer(r["counts"], np.int64).reshape(4, -1) for r in rows], axis=1)
        found, at = np.unique(code, return_inverse=True)
        added = np.zeros((4, len(found)), np.int64)
        for k in range(4):
            np.add.at(added[k], at, sums[k])
        _write(layout.path(f"spread{words}", rows[0]["shard"]), {"code": found} | dict(zip(_SUMS, added, strict=True)))
        return _BLOB.empty_table()

    return merge


_SUMS = ("total", "n1", "n2", "n3")


# --- the model ---------------------------------------------------------------------------------


def discounts(of_counts: list[int]) -> tuple[float, float, float]:
    """What is taken from counts of 1, 2 and more, by the counts of counts 1 to 4; half of the count
    (1.5 at most) where these are too few to tell."""
    n = of_counts[:4]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    found = []
    for k in range(1, 4):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.0
        found.append(d if n[k] and 0 < d < k else k / 2)
    return tuple(found)


@dataclass(frozen=True)
class Model:
    """Where the counts lie and what they add up to; the counts themselves stay in their files."""

    layout: Layout
    #: Discounts by order, from single words on.
    taken: list[tuple[float, float, float]] = field(default_factory=list)
    #: Words: how many, sum of their counts as continuations, and how many of these are 1, 2, more.
    words: int = 0
    total: int = 0
    ones: tuple[int, int, int] = (0, 0, 0)
    tokens: int = 0


def _local(path: str) -> str:
    """The shared folder as a path that workers can map."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"mapping a model needs a mounted shared folder, not {parts.scheme}://")
    return parts.path


def _frequent(texts: DataFrame, n_texts: int, shards: int) -> np.ndarray:
    """Hashes of words that make up more than a part of a shard's share of the tokens of a sample: at
    most ``shards / HOT_SHARE`` words. They decide where n-grams lie, never what is counted."""
    one_in = max(1, n_texts // SAMPLED_TEXTS)
    drawn = texts.filter(F.pmod(F.xxhash64("text"), F.lit(one_in)) == 0).limit(2 * SAMPLED_TEXTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [part.columns[0] for batch in batches for part in runs(batch["text"], 1)]
        words, counts = np.unique(np.concatenate(found or [np.empty(0, np.uint64)]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "n"])

    counted = drawn.select(F.substring("text", 1, 20_000).alias("text")).mapInArrow(run, "word long, n long")
    counted = counted.groupBy("word").agg(F.sum("n").alias("n"))
    total = counted.agg(F.sum("n")).first()[0] or 0
    hot = counted.filter(F.col("n") > HOT_SHARE * total / shards).select("word").collect() if shards > 1 else []
    return np.sort(np.array([r["word"] for r in hot], np.int64).view(np.uint64))


def _stats(rows: DataFrame, size: int) -> list[int]:
    """The counts of counts of all shards, added up."""
    names = [f"s{k}" for k in range(size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added = np.zeros(size, np.int64)
        for batch in batches:
            for counts in batch["counts"]:
                added += np.frombuffer(counts.as_py(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([n]) for n in added], names)

    parts = rows.filter("kind = 'stats'").select("counts").mapInArrow(run, ", ".join(f"{name} long" for name in names))
    return [n or 0 for n in parts.agg(*(F.sum(name) for name in names)).first()]


def train(texts: DataFrame, order: int = 2) -> Model:
    """A model of column ``text`` of all rows (null: empty). Words are split at ASCII white space, A-Z
    in lower case; each text has one more token, its end.

    The files lie in the shared folder, which has to be mounted, since they are mapped. No rows give
    a model that knows no words.
    """
    spark = texts.sparkSession
    texts = texts.select(F.col("text").cast("binary").alias("text"))
    size = texts.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    shards = 1 + (size["bytes"] or 0) // SHARD_BYTES
    folder = _local(scratch_path(spark, "ngrams"))
    os.makedirs(folder, exist_ok=True)
    layout = Layout(order, shards, _frequent(texts, size["n"], shards), folder)
    rows = texts.mapInArrow(_counter(layout), _BLOB_DDL)
    taken, spoken = [], None
    for words in range(order, 1, -1):
        rows = staged(rows.filter("kind = 'grams'").groupBy("shard").applyInArrow(_merger(layout, words), _BLOB_DDL), "ngram-shards")
        taken.append(discounts(_stats(rows, _STATS)))
        if len(layout.hot):
            spread = rows.filter("kind = 'spread'").groupBy("shard")
            spread.applyInArrow(_spread_merger(layout, words), _BLOB_DDL).count()
        spoken = spoken or rows.filter("kind = 'words'")
    if spoken is not None:
        rows = rows.filter("kind = 'grams'").union(spoken)
    else:
        rows = rows.withColumn("kind", F.lit("words"))
    found = _stats(staged(rows.groupBy("shard").applyInArrow(_word_merger(layout), _BLOB_DDL), "words"), _STATS + 1)
    taken.append(discounts(found))
    ones = (found[0], found[1], found[4])
    return Model(layout, taken[::-1], words=found[5], total=found[6], ones=ones, tokens=found[7])


# --- scoring -----------------------------------------------------------------------------------


class _Mapped:
    """The files of a model, mapped as they are asked for."""

    def __init__(self, layout: Layout):
        self.layout = layout
        self.open: OrderedDict[tuple, dict | None] = OrderedDict()

    def _file(self, kind: str, shard: int) -> dict | None:
        key = kind, shard
        if key not in self.open:
            path = self.layout.path(kind, shard)
            found = None
            if os.path.exists(path):
                table = pa.ipc.open_file(pa.memory_map(path)).read_all().combine_chunks()
                found = {name: table[name].chunk(0).to_numpy() if table.num_rows else np.empty(0) for name in table.column_names}
            self.open[key] = found
            if len(self.open) > MAPPED:
                self.open.popitem(last=False)
        self.open.move_to_end(key)
        return self.open[key]

    def find(self, kind: str, place: np.ndarray, code: np.ndarray, names: tuple[str, ...]) -> list[np.ndarray]:
        """The named values of each hash, 0 where it is unknown; hashes are looked up in order."""
        shard = self.layout.shard(place)
        order = np.lexsort((code, shard))
        edges = np.searchsorted(shard[order], np.arange(self.layout.shards + 1))
        found = [np.zeros(len(code)) for _ in names]
        for k in np.flatnonzero(np.diff(edges)).tolist():
            file = self._file(kind, k)
            if file is None or not len(file["code"]):
                continue
            at = order[edges[k] : edges[k + 1]]
            asked = code[at]
            here = np.minimum(np.searchsorted(file["code"], asked), len(file["code"]) - 1)
            known = file["code"][here] == asked
            for values, name in zip(found, names, strict=True):
                values[at[known]] = file[name][here[known]]
        return found


class _Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.files = _Mapped(model.layout)

    def _left(self, counts: np.ndarray, words: int) -> np.ndarray:
        """Counts less their discounts."""
        taken = np.array([0.0, *self.model.taken[words - 1]])
        return np.maximum(counts - taken[np.minimum(counts, 3).astype(np.int64)], 0)

    def words(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of words without a context, and how often each was seen."""
        model = self.model
        even = 1 / (model.words + 1)
        if not model.total:
            return np.full(len(code), even), np.zeros(len(code))
        count, seen = self.files.find("words", code, code, ("count", "seen"))
        rest = sum(d * n for d, n in zip(model.taken[0], model.ones, strict=True)) / model.total
        return self._left(count, 1) / model.total + rest * even, seen

    def probabilities(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each last word behind the others, and how often the word was seen."""
        word, of_word = np.unique(columns[-1], return_inverse=True)
        p, seen = (v[of_word] for v in self.words(word))
        for words in range(2, len(columns) + 1):
            own = columns[-words:]
            place, code = self.model.layout.keys(own)
            _, at, back = np.unique(code, return_index=True, return_inverse=True)
            (count,) = self.files.find(f"grams{words}", place[at], code[at], ("count",))
            context = folded(own[:-1])
            _, one, again = np.unique(context, return_index=True, return_inverse=True)
            held = self.files.find(f"contexts{words}", context[one], context[one], _SUMS)
            spread = np.isin(own[-2][one], self.model.layout.hot)
            if spread.any():
                for values, more in zip(held, self.files.find(f"spread{words}", context[one[spread]], context[one[spread]], _SUMS)):
                    values[spread] = more
            total, *ones = held
            below = np.maximum(total, 1)
            rest = np.where(total > 0, sum(d * n for d, n in zip(self.model.taken[words - 1], ones, strict=True)) / below, 1)
            p = self._left(count, words)[back] / below[again] + rest[again] * p
        return p, seen


_SCORED = "n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without ``text``, with n_tokens, n_known (tokens whose word was seen), train_tokens,
    base_score (words alone, each count one more) and score, the log10 probability of the text.

    Older columns of these names go. Null and empty texts are their end alone; a text of any length
    is read in pieces.
    """
    names = [c.split()[0] for c in _SCORED.split(", ")]
    kept = [c for c in docs.columns if c not in (*names, "text")]
    read = docs.select(*kept, F.col("text").cast("binary").alias("text"))
    schema = docs.select(*kept, *(F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in _SCORED.split(", "))).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for batch in batches:
            n = batch.num_rows
            sums = {name: np.zeros(n) for name in ("n_tokens", "n_known", "base_score", "score")}
            held: list[Run] = []

            def look_up() -> None:
                columns = [np.concatenate(c) for c in zip(*(r.columns for r in held), strict=True)]
                rows = np.concatenate([r.rows for r in held])
                held.clear()
                p, seen = scorer.probabilities(columns)
                base = np.log10((seen + 1) / (model.tokens + model.words + 1))
                for name, of in (("n_tokens", np.ones(len(p))), ("n_known", seen > 0), ("base_score", base), ("score", np.log10(p))):
                    sums[name] += np.bincount(rows, of, n)

            for part in runs(batch["text"], model.layout.order):
                held.append(part)
                if sum(len(r.rows) for r in held) >= RUN_TOKENS:
                    look_up()
            if held:
                look_up()
            found = [sums["n_tokens"].astype(np.int64), sums["n_known"].astype(np.int64), np.full(n, model.tokens)]
            arrays = [batch[c] for c in kept] + [pa.array(a) for a in (*found, sums["base_score"], sums["score"])]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, *names])

    return read.mapInArrow(run, schema)
