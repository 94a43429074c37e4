"""Near-duplicate documents by MinHash.

A document is the set of its word shingles. Minima of many universal hash functions over the set are
its signature; equal bands of minima propose pairs, a bit of each minimum is compared to reject
pairs that cannot reach the threshold, and those left are confirmed on the full sets. Confirmed
links join documents to components.

Documents with equal sets are one node. In a bucket of a band every member is compared with one
pivot, the member with the most company in all its buckets: in a group of copies of one text that is
the text itself or one close to it. Members left outside the pivot's component are compared with those
alone that share rare differences from the pivot with them, which any two linked members do, so a
group of thousands of near copies costs about one comparison each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridmart.llm.common import staged
from gridmart.llm.components import components
from gridmart.llm.language import slices

SLICE_BYTES = 4 << 20
#: Minima of which a bit each is compared before a pair is confirmed; bands use the first of them.
SKETCH_BITS = 1024
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Scheme:
    """Shingle length, threshold in percent, and the banding that follows from them.

    A pair at the threshold is missed with a chance of at most ``miss``; of the bandings within
    ``most`` minima the one with the longest bands is taken, as it proposes the fewest pairs.
    """

    shingle: int = 5
    percent: int = 80
    miss: float = 1e-7
    most: int = 340
    seed: int = 11

    @property
    def banding(self) -> tuple[int, int]:
        """(bands, minima in a band)."""
        fitting = []
        for rows in range(1, 17):
            bands = ceil(log(self.miss) / log(1 - (self.percent / 100) ** rows)) if self.percent < 100 else 1
            if bands * rows <= self.most:
                fitting.append((bands, rows))
        return fitting[-1]

    @property
    def differing_bits(self) -> int:
        """Sketch bits in which a pair at the threshold differs at most, by 5 standard deviations."""
        p = (1 - self.percent / 100) / 2
        return ceil(SKETCH_BITS * p + 5 * sqrt(SKETCH_BITS * p * (1 - p)))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


class _Hasher:
    """Hashes of the words of a byte text, all at once: differences of running sums of byte * base**place."""

    BASE = 0xD6E8FEB86659FD93

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def words(self, text: bytes) -> np.ndarray:
        """64-bit hashes of the words, in order; words are split at ASCII white space."""
        if len(self.up) <= len(text):
            n = 2 * len(text) + 1024
            self.up, self.down = _powers(self.BASE, n), _powers(_inverse(self.BASE), n)
        raw = np.frombuffer(text.lower(), np.uint8)
        inside = (raw != 0x20) & ((raw < 0x09) | (raw > 0x0D))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
        begin, end = edges[::2], edges[1::2]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw + np.uint64(1)) * self.up[: len(raw)], dtype=np.uint64)])
        return _mix((sums[end] - sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64) * _ODD)

    def shingles(self, text: bytes, size: int) -> np.ndarray:
        """The sorted set of shingle hashes; of all words where there are fewer than ``size``."""
        hashes = self.words(text)
        if not len(hashes):
            return hashes
        size = min(size, len(hashes))
        n = len(hashes) - size + 1
        code = np.full(n, size, np.uint64)
        for k in range(size):
            code = _mix(code * _ODD + hashes[k : k + n])
        return np.unique(code)


class _Signer:
    def __init__(self, scheme: Scheme):
        self.bands, self.rows = scheme.banding
        rng = np.random.default_rng(scheme.seed)
        n = max(self.bands * self.rows, SKETCH_BITS)
        self.times = (rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1))[:, None]
        self.plus = rng.integers(0, 1 << 32, n, dtype=np.uint32)[:, None]
        self.weights = rng.integers(0, 1 << 63, (self.bands, self.rows), dtype=np.uint64) | np.uint64(1)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        values = (shingles >> np.uint64(32)).astype(np.uint32)
        out = np.full(len(self.times), np.iinfo(np.uint32).max, np.uint32)
        for at in range(0, len(values), 512):
            hashed = self.times * values[None, at : at + 512] + self.plus
            np.minimum(out, hashed.min(1), out)
        return out

    def keys(self, minima: np.ndarray) -> np.ndarray:
        """One key for each band."""
        parts = minima[: self.bands * self.rows].reshape(self.bands, self.rows).astype(np.uint64) * self.weights
        return _mix(parts.sum(1, dtype=np.uint64) + np.arange(self.bands, dtype=np.uint64) * _ODD).view(np.int64)

    @staticmethod
    def sketch(minima: np.ndarray) -> np.ndarray:
        """A bit of each minimum, mixed for each function: the multipliers are odd, so the minima's
        own low bits would show the same bits of the shingles in all functions."""
        mixed = _mix(minima[:SKETCH_BITS] + np.arange(SKETCH_BITS, dtype=np.uint64) * _ODD)
        return np.packbits((mixed >> np.uint64(63)).astype(np.uint8)).view(np.int64)


_SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, sketch array<long>, bands array<long>"


#: What tells one set from another.
EQUAL = ["set_a", "set_b", "n_shingles"]


def set_names(shingles: np.ndarray) -> tuple[int | None, int | None]:
    """Two numbers that stand for a set."""
    if not len(shingles):
        return None, None
    pair = shingles.sum(dtype=np.uint64), _mix(shingles).sum(dtype=np.uint64)
    return tuple(int(x.view(np.int64)) for x in pair)


def signatures(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, sketch, bands): set_a and set_b stand for the set as a whole.

    Texts without a word have no shingles and neither of the rest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, signer = _Hasher(), _Signer(scheme)
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                counts, sums, sketches, keys = [], [], [], []
                for text in part["text"].cast(pa.large_binary()):
                    found = hasher.shingles(text.as_py() or b"", scheme.shingle)
                    counts.append(len(found))
                    sums.append(set_names(found))
                    if not len(found):
                        sketches.append(None)
                        keys.append(None)
                        continue
                    minima = signer.minima(found)
                    sketches.append(signer.sketch(minima))
                    keys.append(signer.keys(minima))
                whole = zip(*sums, strict=True)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array(counts, pa.int64()),
                        *(pa.array(c, pa.int64()) for c in whole),
                        pa.array(sketches, longs),
                        pa.array(keys, longs),
                    ],
                    ["doc_id", "n_shingles", "set_a", "set_b", "sketch", "bands"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _SIGNED)


def _sets(docs: DataFrame, firsts: DataFrame, ids: DataFrame, scheme: Scheme) -> DataFrame:
    """(id, shingles) of the nodes in ``ids``, as a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher()
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                found = [hasher.shingles(t.as_py() or b"", scheme.shingle) for t in part["text"].cast(pa.large_binary())]
                named = [set_names(f) for f in found]
                arrays = [pa.array([n[k] for n in named], pa.int64()) for k in range(2)]
                sizes = pa.array([len(f) for f in found], pa.int64())
                held = pa.array([f.view(np.int64) for f in found], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part["doc_id"], *arrays, sizes, held], ["doc_id", *EQUAL, "shingles"])

    wanted = staged(firsts.join(ids, "id", "left_semi"), "wanted")
    held = docs.select(F.col("doc_id").cast("long"), "text").join(wanted, "doc_id", "left_semi")
    read = held.mapInArrow(run, "doc_id long, set_a long, set_b long, n_shingles long, shingles array<long>")
    sets = staged(read.join(wanted, ["doc_id", *EQUAL]).select("id", "shingles"), "sets")
    if sets.groupBy("id").count().filter("count > 1").isEmpty():
        return sets
    return staged(sets.dropDuplicates(["id"]), "sets")  # rows repeated in the input


def _confirmed(docs: DataFrame, firsts: DataFrame, pairs: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold, as a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch["left"], batch["right"], strict=True):
                one, two = (x.values.to_numpy() for x in (left, right))
                both = np.intersect1d(one, two, assume_unique=True).size
                keep.append(100 * both >= scheme.percent * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = _sets(docs, firsts, ids, scheme)
    loaded = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("right")), "b")
    loaded = loaded.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("left")), "a")
    return staged(loaded.select("a", "b", "left", "right").mapInArrow(run, "a long, b long"), "links")


def _bits() -> Column:
    """The sketch bits in which x and y differ."""
    bits = [F.bit_count(F.col("x.sketch")[k].bitwiseXOR(F.col("y.sketch")[k])) for k in range(SKETCH_BITS // 64)]
    return reduce(Column.__add__, bits)


def _alike(scheme: Scheme) -> Column:
    """What two signatures must meet: sketches close enough, sizes within the threshold."""
    least, most = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    return (_bits() <= scheme.differing_bits) & (least * 100 >= most * scheme.percent)


def _signed_alike(pairs: DataFrame, nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs (a, b) that pass the comparison of their signatures."""
    own = nodes.select("id", F.struct("n", "sketch").alias("s"))
    held = pairs.join(own.select(F.col("id").alias("b"), F.col("s").alias("y")), "b")
    held = held.join(own.select(F.col("id").alias("a"), F.col("s").alias("x")), "a")
    return held.filter(_alike(scheme)).select("a", "b")


def _labelled(rows: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
    """``rows`` with the component of the node in ``column``; a node without a link is its own."""
    held = labels.select(F.col("id").alias(column), F.col("component").alias(name))
    return rows.join(held, column, "left").withColumn(name, F.coalesce(name, column))


def _apart(docs: DataFrame, firsts: DataFrame, held: DataFrame, scheme: Scheme) -> DataFrame:
    """``held`` (pivot, id, ...) with n and n_pivot, the sizes of the sets, and apart, the shingles
    that one of both has."""
    names = held.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, SLICE_BYTES, "left"):
                pairs = [tuple(x.values.to_numpy() for x in two) for two in zip(part["left"], part["right"], strict=True)]
                sizes = [pa.array([len(p[k]) for p in pairs], pa.int64()) for k in range(2)]
                apart = pa.array([np.setxor1d(*p, assume_unique=True) for p in pairs], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*(part[c] for c in names), *sizes, apart], [*names, "n", "n_pivot", "apart"])

    ids = held.select(F.explode(F.array("id", "pivot")).alias("id")).distinct()
    sets = _sets(docs, firsts, ids, scheme)
    loaded = held.join(sets.select("id", F.col("shingles").alias("left")), "id")
    loaded = loaded.join(sets.select(F.col("id").alias("pivot"), F.col("shingles").alias("right")), "pivot")
    schema = ", ".join([f"{c} long" for c in names] + ["n long, n_pivot long, apart array<long>"])
    return loaded.select(*names, "left", "right").mapInArrow(run, schema)


def _edits(apart: DataFrame, scheme: Scheme) -> DataFrame:
    """(pivot, edit, id, mine, main, n, size, place, asks, answers): the rarest of each member's edits,
    the shingles that it or the pivot alone has; edits of one member only are left out.

    If x is not linked with the pivot p, each y that it is linked with shares edits with it: were
    none shared, both would differ by all of them, more than the threshold allows. With c = (1 - t) /
    (1 + t), they share at least (E(x) + E(y) - c(x + y)) / 2 edits, which is (E(x) - c(x + p)) / 2 or
    more for x whatever y is, and more than (E(y) + c(p - y)) / 2 for y whatever x is. Of sets that
    share k elements in an order of all of them the first size - k + 1 have one in common, so that only
    these ask (x) or answer (y); the rarest come first.
    """
    each = apart.withColumn("size", F.size("apart").cast("long")).withColumn("edit", F.explode("apart")).drop("apart")
    shared = each.groupBy("pivot", "edit").agg(F.count("*").alias("often")).filter("often > 1")
    known = each.join(staged(shared, "shared-edits"), ["pivot", "edit"])
    mine = W.partitionBy("pivot", "id")
    place = F.col("size") - F.count("*").over(mine) + F.row_number().over(mine.orderBy("often", "edit"))
    more, less = 100 + scheme.percent, 100 - scheme.percent
    size = F.col("size") * more
    asks = F.greatest(F.lit(1), F.ceil((size - less * (F.col("n") + F.col("n_pivot"))) / (2 * more)))
    answers = F.greatest(F.lit(1), F.floor((size + less * (F.col("n_pivot") - F.col("n"))) / (2 * more)) + 1)
    near = known.withColumns({"place": place, "asks": asks, "answers": answers})
    names = ["pivot", "edit", "id", "mine", "main", "n", "size", "place"]
    asking = (F.col("mine") != F.col("main")) & (F.col("place") <= F.col("size") - F.col("asks") + 1)
    answering = F.col("place") <= F.col("size") - F.col("answers") + 1
    rows = near.select(*names, asking.alias("asks"), answering.alias("answers"))
    return staged(rows.filter("asks or answers"), "edits")


def _residual(docs: DataFrame, firsts: DataFrame, members: DataFrame, labels: DataFrame, scheme: Scheme) -> DataFrame:
    """Pairs of a bucket not yet joined by way of its pivot, as far as their edits agree; ``lacking``
    tells how far they may be below the threshold at most, less if closer.

    Members outside the pivot's component are compared with those that share rare edits with them: in
    a group of near copies whose edits are their own, none are.
    """
    known = _labelled(_labelled(members.select("id", "pivot").distinct(), labels, "id", "mine"), labels, "pivot", "main")
    known = staged(known.filter(F.col("id") != F.col("pivot")).select("pivot", "id", "mine", "main"), "bucket-components")
    outside = known.filter(F.col("mine") != F.col("main"))
    held = known.join(staged(outside.select("pivot").distinct(), "open-buckets"), "pivot")
    edits = _edits(staged(_apart(docs, firsts, held, scheme), "apart"), scheme)
    x, y = edits.filter("asks").alias("x"), edits.filter("answers").alias("y")
    once = (F.col("y.mine") == F.col("y.main")) | (F.col("x.id") < F.col("y.id"))
    new = (F.col("x.mine") != F.col("y.mine")) & (F.col("x.id") != F.col("y.id"))
    more, less = 100 + scheme.percent, 100 - scheme.percent
    sizes, counts = F.col("x.size") + F.col("y.size"), F.col("x.n") + F.col("y.n")
    # what they can still share from here on, against what they have to share
    able = 1 + F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
    lacking = sizes * more - counts * less - able * 2 * more
    least, most = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    near = (lacking <= 0) & (least * 100 >= most * scheme.percent)
    same = (F.col("x.pivot") == F.col("y.pivot")) & (F.col("x.edit") == F.col("y.edit"))
    ends = F.greatest("x.id", "y.id").alias("a"), F.least("x.id", "y.id").alias("b")
    met = x.join(y, same & once & new & near).select(*ends, lacking.alias("lacking"))
    return met.groupBy("a", "b").agg(F.min("lacking").alias("lacking"))


def _members(nodes: DataFrame) -> DataFrame:
    """(key, id, pivot, company): the members of buckets of more than one node, and the pivot of
    each bucket with the sum of the sizes of its own buckets."""
    banded = nodes.select("id", F.explode("bands").alias("key")).distinct()
    shared = banded.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    inside = staged(banded.join(staged(shared, "buckets"), "key"), "bucket-members")
    company = staged(inside.groupBy("id").agg(F.sum("size").alias("company")), "company")
    weighed = inside.select("key", "id").join(company, "id")
    best = weighed.groupBy("key").agg(F.max(F.struct("company", (-F.col("id")).alias("minus"))).alias("best"))
    pivots = staged(best.select("key", (-F.col("best.minus")).alias("pivot"), "best.company"), "pivots")
    return staged(inside.select("key", "id").join(pivots, "key"), "members")


def _pairs(one: str, two: str, rows: DataFrame) -> DataFrame:
    return rows.select(F.greatest(one, two).alias("a"), F.least(one, two).alias("b")).distinct()


def _joined(docs: DataFrame, firsts: DataFrame, labels: DataFrame, pairs: DataFrame, scheme: Scheme) -> DataFrame:
    """The components after the pairs that are links have joined them."""
    pairs = staged(pairs.select("a", "b"), "pairs")
    if pairs.isEmpty():
        return labels
    known = labels.select(F.col("id").alias("a"), F.col("component").alias("b"))
    return components(known.union(_confirmed(docs, firsts, pairs, scheme)))


def _likeliest(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Of the pairs between two components the closest."""
    known = _labelled(_labelled(pairs, labels, "a", "one"), labels, "b", "two")
    sides = F.greatest("one", "two").alias("one"), F.least("one", "two").alias("two")
    known = known.filter(F.col("one") != F.col("two")).select(*sides, F.struct("lacking", "a", "b").alias("pair"))
    return known.groupBy("one", "two").agg(F.min("pair").alias("p")).select("p.a", "p.b")


def near_duplicates(docs: DataFrame, scheme: Scheme | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked where the shingle sets of their texts reach the scheme's similarity;
    component_id is the smallest doc_id that links lead to, and the document with it is kept. Words
    are split at ASCII white space, A-Z in lower case; a text of fewer words than a shingle is one
    shingle, one without words is linked with nothing.

    Rows that share a doc_id are one node and all its texts' links count. Rows without doc_id have
    no component and are kept. Other columns of ``docs`` are ignored. No documents give no rows.
    """
    scheme = scheme or Scheme()
    signed = staged(signatures(docs, scheme), "signatures")
    known = signed.filter(F.col("doc_id").isNotNull() & F.col("set_a").isNotNull())
    # a node is a set, numbered in the order of the smallest doc_id that has it
    firsts = known.groupBy(*EQUAL).agg(F.min("doc_id").alias("doc_id")).orderBy("doc_id", *EQUAL)
    firsts = staged(firsts.select(F.monotonically_increasing_id().alias("id"), "doc_id", *EQUAL), "equal-sets")
    rows = known.join(firsts, ["doc_id", *EQUAL]).select("id", F.col("n_shingles").alias("n"), "sketch", "bands")
    nodes = staged(rows.dropDuplicates(["id"]), "nodes")
    members = _members(nodes)

    # every node with its best pivot, then with its others, then what pivots have not joined
    met = members.filter(F.col("id") != F.col("pivot"))
    paired = staged(met.select("id", "pivot", "company").distinct(), "pairs")
    first = paired.groupBy("id").agg(F.max(F.struct("company", "pivot")).alias("best"))
    likely = staged(_signed_alike(_pairs("id", "best.pivot", first), nodes, scheme), "pairs")
    links = _confirmed(docs, firsts, likely, scheme)
    labels = components(links.union(_of_one_id(signed, firsts)))
    others = _parted(_pairs("id", "pivot", paired), labels)
    labels = _joined(docs, firsts, labels, _signed_alike(others, nodes, scheme), scheme)
    found = staged(_residual(docs, firsts, members, labels, scheme), "pairs")
    labels = _joined(docs, firsts, labels, _likeliest(found, labels), scheme)
    labels = _joined(docs, firsts, labels, _parted(found, labels), scheme)
    named = _labelled(firsts, labels, "id", "component").select(*EQUAL, "component")
    smallest = firsts.select(F.col("id").alias("component"), F.col("doc_id").alias("component_id"))
    named = staged(named.join(smallest, "component").drop("component"), "equal-components")
    out = signed.join(named, EQUAL, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    kept = F.coalesce(component == F.col("doc_id"), F.lit(True))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def _of_one_id(signed: DataFrame, firsts: DataFrame) -> DataFrame:
    """Links (a, b) between the sets of rows that share a doc_id: these are one node."""
    several = signed.filter(F.col("doc_id").isNotNull() & F.col("set_a").isNotNull()).groupBy("doc_id")
    several = staged(several.agg(F.min("set_a").alias("low"), F.max("set_a").alias("high")).filter("low <> high"), "repeated-ids")
    ids = signed.select("doc_id", *EQUAL).join(several.select("doc_id"), "doc_id", "left_semi")
    held = ids.join(firsts.select("id", *EQUAL), EQUAL).select("doc_id", "id").distinct()
    least = held.groupBy("doc_id").agg(F.min("id").alias("b"))
    return held.join(least, "doc_id").select(F.col("id").alias("a"), "b").filter("a <> b")


def _parted(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose nodes are in different components so far."""
    known = _labelled(_labelled(pairs, labels, "a", "one"), labels, "b", "two")
    return known.filter(F.col("one") != F.col("two")).select("a", "b")
