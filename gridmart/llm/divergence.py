"""How far the sources of a language diverge in their words, in exact integers.

Texts are lower-cased, split, dictionary-encoded and counted by Arrow's own kernels, a batch at a
time; tasks send partial counts, which Spark merges. Terms that enough documents of a language have
are kept and laid out in columnar shards, a row a term and a column a source. Each shard gives its
part of the divergence of every pair of sources and its own strongest terms of each source; parts add
up and few strongest terms are left to rank.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.common import staged

#: What parts two terms, for Arrow and for cutting long texts.
SEPARATORS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
_SEPARATOR = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
SLICE_BYTES = 4 << 20
#: Partial counts a task holds before it sends them.
HELD_COUNTS = 300_000
#: Counts (a term in a source) of a shard, about.
SHARD_COUNTS = 65_536
#: Cells of a shard's columns computed at once; sums of pairs a task holds before it sends them.
CELLS = 1 << 21
PAIRS = 1 << 22


@dataclass(frozen=True)
class Audit:
    """Documents that a kept term needs, what is added to its counts, the whole of a share, and the
    strongest terms listed for a source."""

    documents: int = 10
    added: int = 2
    whole: int = 1_000_000_000
    terms: int = 10


# --- partial counts ----------------------------------------------------------------------------


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(rows, texts) of about a slice; of a longer text its pieces one by one, cut at separators."""
    sizes = pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64)
    begun, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > SLICE_BYTES:
            yield pa.array(np.arange(begun, row)), batch["text"].slice(begun, row - begun)
            begun, held = row, 0
        if size > SLICE_BYTES:
            data = batch["text"][row].as_buffer()
            at = 0
            while at < size:
                cut = _SEPARATOR.search(data, min(at + SLICE_BYTES, size))
                end = cut.start() if cut else size
                yield pa.array([row]), pa.array([bytes(data[at:end])], pa.large_binary()).cast(pa.large_string())
                at = end
            begun = row + 1
        else:
            held += size
    if held or begun < len(sizes):
        yield pa.array(np.arange(begun, len(sizes))), batch["text"].slice(begun)


def _summed(counts: pa.Table, keys: list[str]) -> pa.Table:
    values = [c for c in counts.column_names if c not in keys]
    found = counts.group_by(keys, use_threads=False).aggregate([(c, "sum") for c in values])
    return found.rename_columns({f"{c}_sum": c for c in values}).select([*keys, *values])


def _by_row(rows: pa.Array, texts: pa.Array) -> pa.Table:
    """(row, term, n) of some texts."""
    words = pc.split_pattern_regex(pc.ascii_lower(texts), SEPARATORS)
    term, row = pc.list_flatten(words), rows.take(pc.list_parent_indices(words))
    some = pc.greater(pc.binary_length(term), 0)
    encoded = term.filter(some).dictionary_encode()
    of_row = pa.table({"row": row.filter(some), "code": encoded.indices})
    counts = of_row.group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")])
    terms = encoded.dictionary.take(counts["code"].combine_chunks())
    return pa.table({"row": counts["row"], "term": terms, "n": counts["count_all"]})


_COUNTS = pa.schema(
    {"lang": pa.string(), "source": pa.string(), "term": pa.string(), "n": pa.int64(), "documents": pa.int64()}
)
_GROUP = ["lang", "source", "term"]


def _batch_counts(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    """Counts of a batch, a slice at a time; a group without terms has a row with a null term."""
    batch = batch.set_column(2, "text", batch["text"].cast(pa.large_string()))
    groups = pa.table({"lang": batch["lang"], "source": batch["source"]}).group_by(["lang", "source"]).aggregate([])
    n = groups.num_rows
    yield pa.table(
        [groups["lang"], groups["source"], pa.nulls(n, pa.string()), *[pa.array(np.zeros(n, np.int64))] * 2], schema=_COUNTS
    )
    long_row: list[pa.Table] = []

    def of_rows(by_row: pa.Table) -> pa.Table:
        row = by_row["row"].combine_chunks()
        columns = [batch["lang"].take(row), batch["source"].take(row), by_row["term"].cast(pa.string()), by_row["n"]]
        ones = pa.array(np.ones(by_row.num_rows, np.int64))
        return _summed(pa.table([*columns, ones], schema=_COUNTS), _GROUP)

    for rows, texts in _texts(batch):
        by_row = _by_row(rows, texts)
        # the pieces of a long text are one document
        single = by_row["row"][0].as_py() if len(rows) == 1 and by_row.num_rows else None
        if long_row and single != long_row[0]["row"][0].as_py():
            yield of_rows(_summed(pa.concat_tables(long_row), ["row", "term"]))
            long_row = []
        if single is None:
            if by_row.num_rows:
                yield of_rows(by_row)
        else:
            long_row = [_summed(pa.concat_tables([*long_row, by_row]), ["row", "term"])]
    if long_row:
        yield of_rows(long_row[0])


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        for counts in _batch_counts(batch):
            held.append(counts)
            rows += counts.num_rows
            if rows > HELD_COUNTS:
                held = [_summed(pa.concat_tables(held), _GROUP)]
                rows = held[0].num_rows
                if rows > HELD_COUNTS // 2:
                    yield from held[0].cast(_COUNTS).to_batches(max_chunksize=50_000)
                    held, rows = [], 0
    if held:
        yield from _summed(pa.concat_tables(held), _GROUP).cast(_COUNTS).to_batches(max_chunksize=50_000)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, documents): occurrences of each term in each group and its documents.

    A row is a document, whatever its id. Null text, lang and source are empty. A group has a row
    with a null term as well, so that it is known without any. Other columns are ignored.
    """
    read = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    ddl = "lang string, source string, term string, n long, documents long"
    partial = read.mapInArrow(_partial, ddl)
    return partial.groupBy(*_GROUP).agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


# --- divergences -------------------------------------------------------------------------------


def shares(counts: np.ndarray, totals: np.ndarray | int, terms: int, audit: Audit) -> np.ndarray:
    """1 + floor(whole * (count + added) / (total + added * terms)), digit by digit in 64 bits."""
    below = np.asarray(totals, np.int64) + audit.added * terms
    rest, found = counts + audit.added, np.zeros(np.broadcast(counts, below).shape, np.int64)
    found += (rest // below) * audit.whole
    rest = rest % below
    scale = audit.whole
    while scale > 1:
        step = min(10, scale)
        scale //= step
        rest = rest * step
        found += rest // below * scale
        rest = rest % below
    return found + 1


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _strongest(values: np.ndarray, terms: list[str], most: int) -> list[tuple[str, int]]:
    """The terms of the largest values, ties to the smaller by their bytes."""
    if len(values) > most:
        least = np.partition(values, -most)[-most]
        chosen = np.flatnonzero(values >= least)
    else:
        chosen = np.arange(len(values))
    named = sorted((-int(values[k]), terms[k].encode(), terms[k]) for k in chosen.tolist())
    return [(term, -value) for value, _, term in named[:most]]


_FOUND = "lang string, source string, part string, item string, value long"


def _divergences(audit: Audit):
    schema = pa.schema([(c, pa.int64() if c == "value" else pa.string()) for c in ("lang", "source", "part", "item", "value")])

    def of_shard(row: dict, sums: np.ndarray) -> Iterator[tuple]:
        """Adds a shard's part to the sums of pairs and gives its strongest terms."""
        names = [g["source"] for g in row["groups"]]
        totals = np.array([g["n"] for g in row["groups"]], np.int64)
        column = {name: k for k, name in enumerate(names)}
        most = max(1, CELLS // len(names))
        for at in range(0, len(row["terms"]), most):
            part = row["terms"][at : at + most]
            counts = np.zeros((len(part), len(names)), np.int64)
            for k, term in enumerate(part):
                for held in term["held"]:
                    counts[k, column[held["source"]]] = held["n"]
            own = shares(counts, totals[None, :], row["n_terms"], audit)
            whole = shares(np.array([t["n"] for t in part], np.int64), row["total"], row["n_terms"], audit)
            texts = [t["term"] for t in part]
            for k, name in enumerate(names):
                sums[k, k + 1 :] += _distance(own[:, k : k + 1], own[:, k + 1 :]).sum(0)
                more = np.flatnonzero((counts[:, k] > 0) & (own[:, k] > whole))
                values = _distance(own[more, k], whole[more])
                for term, value in _strongest(values, [texts[m] for m in more.tolist()], audit.terms):
                    yield row["lang"], name, "term", term, value

    def pairs(lang: str, names: list[str], sums: np.ndarray) -> Iterator[tuple]:
        for k, name in enumerate(names):
            for j in range(k + 1, len(names)):
                value = int(sums[k, j])
                yield lang, name, "pair", names[j], value
                yield lang, names[j], "pair", name, value

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[list[str], np.ndarray]] = {}
        rows: list[tuple] = []

        def sent() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, (names, held) in sums.items():
                for row in pairs(lang, names, held):
                    rows.append(row)
                    if len(rows) >= 50_000:
                        yield sent()
            sums.clear()

        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                row["terms"] = row["terms"] or []
                if row["lang"] not in sums:
                    if sum(h.size for _, h in sums.values()) + len(row["groups"]) ** 2 > PAIRS:
                        yield from flushed()
                    names = [g["source"] for g in row["groups"]]
                    sums[row["lang"]] = names, np.zeros((len(names), len(names)), np.int64)
                rows += of_shard(row, sums[row["lang"]][1])
                if len(rows) >= 50_000:
                    yield sent()
        yield from flushed()
        if rows:
            yield sent()

    return run


def divergences(docs: DataFrame, audit: Audit | None = None) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source of each language diverges.

    A language keeps the terms that enough of its documents have. A share of a term in a source, or
    in the language, is one more than the floor of ``whole`` times its count, some added, in that of
    all kept terms; two shares p and q are floor((p - q)^2 / (p + q)) apart. Part "pair": the sum of
    that over the kept terms, for each other source of the language (0 where no term is kept). Part
    "term": the terms that a source has more of than its language, by that distance, the first of
    them. Ranks begin at 1 for each source and part, ties to the smaller item by its bytes.

    A source alone in its language has no pairs; no documents give no rows.
    """
    audit = audit or Audit()
    counts = staged(term_counts(docs), "term-counts")
    of_term = counts.filter(F.col("term").isNotNull()).groupBy("lang", "term")
    held = F.collect_list(F.struct("source", "n")).alias("held")
    known = of_term.agg(F.sum("documents").alias("documents"), F.sum("n").alias("n"), held)
    kept = staged(known.filter(F.col("documents") >= audit.documents).drop("documents"), "kept-terms")

    in_source = kept.select("lang", F.explode("held").alias("h")).groupBy("lang", "h.source").agg(F.sum("h.n").alias("n"))
    groups = counts.select("lang", "source").distinct().join(in_source, ["lang", "source"], "left")
    group = F.struct("source", F.coalesce("n", F.lit(0)).alias("n"))
    sizes = kept.groupBy("lang").agg(
        F.count("*").alias("n_terms"), F.sum("n").alias("total"), F.sum(F.size("held").cast("long")).alias("n_counts")
    )
    langs = groups.groupBy("lang").agg(F.array_sort(F.collect_list(group)).alias("groups")).join(sizes, "lang", "left")
    langs = staged(langs.na.fill(0), "languages")

    spread = kept.join(langs.select("lang", (F.col("n_counts") / SHARD_COUNTS).cast("long").alias("most")), "lang")
    shard = F.pmod(F.xxhash64("term"), F.col("most") + 1).alias("shard")
    term = F.struct("term", "n", "held")
    shards = spread.groupBy("lang", shard).agg(F.collect_list(term).alias("terms")).drop("shard")
    found = langs.drop("n_counts").join(staged(shards, "term-shards"), "lang", "left").mapInArrow(_divergences(audit), _FOUND)
    added = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    place = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = added.withColumn("rank", F.row_number().over(place))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= audit.terms))
