"""Line deduplication by a deletion-neighbourhood join, in DataFrame operations alone.

A line goes when an equal line, or one within an edit distance of 1, stands earlier in the corpus.
Lines within one edit share a variant: the line itself or the line less one character. Emitting the
variants of every line would multiply the corpus by the length of its lines, so a coarser deletion
comes first: a pair within one edit agrees everywhere outside one block of the line. Lines that
share all but a block with another line emit the variants of that block, as hashed keys; equal
variants are joined to the earliest, and the edit distance of each pair is verified.

Nothing here gathers a group of copies: equal lines are reduced to their earliest place first, and
all the lines that share a variant are distinct and differ in one character of one block.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridmart.llm.common import staged

#: Shorter lines are too common by chance to tell copies; they always stay.
MIN_CHARS = 10
#: Longest block of a line; a line has two blocks at least.
BLOCK_CHARS = 256

#: Longer lines have blocks of exactly that length, and keys made of hashes of blocks.
LONG_CHARS = 4096

_LINE = ("_doc", "_row", "_no")


def _places(docs: DataFrame, min_chars: int) -> DataFrame:
    """Every line of at least ``min_chars`` characters with its place."""
    rows = docs.select(
        F.col("doc_id").alias("_doc"),
        _row_key().alias("_row"),
        F.posexplode(F.split("text", "\n", -1)).alias("_no", "_line"),
    )
    return rows.filter(F.length("_line") >= min_chars)


def _row_key() -> Column:
    """Tells rows apart that share an id but not their text."""
    return F.xxhash64("text")


def _count(c: Column) -> Column:
    return F.greatest(F.lit(2), F.ceil(c / BLOCK_CHARS)).cast("int")


def _width(c: Column) -> Column:
    return F.when(c > LONG_CHARS, BLOCK_CHARS).otherwise(F.ceil(c / _count(c))).cast("int")


def _blocks(line: Column, with_number: bool = True) -> Column:
    """All ways to leave one block out: (key of what is outside, whether this is the shorter length, block number).

    Lines of lengths c and c + 1 meet in class c, whose blocks are counted from both ends so that
    one more character inside a block moves nothing outside of it.
    """

    def of_line(n: Column) -> Column:
        def class_of(c: Column, short: bool) -> Column:
            fields = {"c": c, "count": _count(c), "width": _width(c), "short": F.lit(short)}
            return F.struct(*(value.alias(name) for name, value in fields.items()))

        def blocks_of(k: Column) -> Column:
            numbers = F.sequence(F.lit(0), k["count"] - 1)
            plain = F.transform(numbers, lambda j: block(k, j, outside(k, j)))
            return F.when(k["c"] > LONG_CHARS, of_long(k, numbers)).otherwise(plain)

        def outside(k: Column, j: Column) -> Column:
            before = F.least(j * k["width"], k["c"])
            after = F.greatest(k["c"] - (j + 1) * k["width"], F.lit(0))
            return F.xxhash64(k["c"], j, F.substring(line, F.lit(1), before), F.substring(line, n - after + 1, after))

        def of_long(k: Column, numbers: Column) -> Column:
            # the line is read once from either end: what is before a block, and after it, are hashes of hashes
            rest = (k["c"] % BLOCK_CHARS).cast("int")
            ends = F.struct(
                _chained(line, F.lit(0)).alias("before"),
                _chained(F.substring(F.reverse(line), rest + 1, n), F.xxhash64(F.right(line, rest))).alias("after"),
            )

            def keys(held: Column) -> Column:
                def key(j: Column) -> Column:
                    behind = F.floor(k["c"] / BLOCK_CHARS).cast("int") - j
                    after = F.when(k["c"] > (j + 1) * BLOCK_CHARS, F.get(held["after"], behind - 1))
                    return block(k, j, F.xxhash64(k["c"], j, F.get(held["before"], j), after))

                return F.transform(numbers, key)

            return F.transform(F.array(ends), keys)[0]

        def block(k: Column, j: Column, key: Column) -> Column:
            out = [key.alias("key"), k["short"].alias("short")]
            return F.struct(*out, *([j.alias("number")] if with_number else []))

        return F.flatten(F.transform(F.array(class_of(n, True), class_of(n - 1, False)), blocks_of))

    # a lambda's argument is computed once, whatever number of times it is named
    return F.transform(F.array(F.length(line)), of_line)[0]


def _chained(text: Column, seed: Column) -> Column:
    """Hashes of a text's first 0, 1, 2, ... blocks, each made of the one before and one block."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))

    def longer(held: Column, piece: Column) -> Column:
        return F.array_append(held, F.xxhash64(F.element_at(held, -1), piece))

    return F.aggregate(pieces, F.array(seed.cast("long")), longer)


def _inside(line: Column, short: Column, number: Column) -> Column:
    """The text of one block of a line."""
    n = F.length(line)
    c = F.when(short, n).otherwise(n - 1)
    before = F.least(number * _width(c), c)
    after = F.greatest(c - (number + 1) * _width(c), F.lit(0))
    return F.substring(line, before + 1, n - before - after)


def _identity(line: Column) -> list[Column]:
    """96 bits that stand for the line."""
    return [F.xxhash64(line).alias("_h"), F.hash(line).alias("_g")]


def _earliest(lines: DataFrame) -> DataFrame:
    """One row for each distinct line: its earliest place and its number."""
    place = F.struct(*_LINE)
    return staged(lines.groupBy("_h", "_g").agg(F.min(place).alias("first"), F.count("*").alias("n")), "line-firsts")


def _candidates(lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """(key, place): first places of the distinct lines that agree with another outside one block."""
    keyed = lines.select("_h", "_g", F.explode("keys").alias("k")).select("_h", "_g", "k.key", "k.short")
    shared = keyed.groupBy("key").agg(F.min("_h").alias("a"), F.max("_h").alias("b"), F.max("short").alias("any"))
    shared = staged(shared.filter((F.col("a") != F.col("b")) & F.col("any")).select("key"), "line-keys")
    members = keyed.select("_h", "_g", "key").join(shared, "key").distinct()
    return members.join(firsts.select("_h", "_g", F.col("first.*")), ["_h", "_g"]).select("key", *_LINE)


def _variants(docs: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hashed variants of the candidates' blocks, and the candidates' lines.

    A variant's ``_at`` is the place of the deleted character, -1 for the block as it is.
    """
    wanted = candidates.groupBy("_doc", "_row").agg(F.collect_list(F.struct("_no", "key")).alias("wanted"))
    texts = docs.select(F.col("doc_id").alias("_doc"), _row_key().alias("_row"), "text").dropDuplicates(["_doc", "_row"])
    found = _joined(texts, wanted, "inner").withColumn("_all", F.split("text", "\n", -1))
    found = found.select("_doc", "_row", "_all", F.explode("wanted").alias("w"))
    line = F.element_at("_all", F.col("w._no") + 1)
    found = staged(found.select("_doc", "_row", F.col("w._no").alias("_no"), "w.key", line.alias("line")), "line-texts")
    own = F.filter(_blocks(F.col("line")), lambda b: b["key"] == F.col("key"))
    mine = found.select(*_LINE, "key", "line", F.explode(own).alias("b"))
    block = _inside(F.col("line"), F.col("b.short"), F.col("b.number"))
    mine = mine.select("key", F.struct(*_LINE).alias("place"), block.alias("block"), "b.short")
    mine = mine.withColumn("size", F.length("block"))
    emitted = mine.withColumn("_at", F.explode(F.sequence(F.lit(-1), F.col("size") - 1)))
    emitted = emitted.filter(F.col("short") | (F.col("_at") >= 0))
    left = F.substring(F.col("block"), F.lit(1), F.col("_at"))
    right = F.right(F.col("block"), F.col("size") - F.col("_at") - 1)
    text = F.when(F.col("_at") < 0, F.col("block")).otherwise(F.concat(left, right))
    variants = emitted.select(F.xxhash64("key", text).alias("variant"), "_at", "short", "place")
    return variants, found.select(F.struct(*_LINE).alias("place"), "line").dropDuplicates(["place"])


def _within_one(one: Column, two: Column) -> Column:
    """Whether two lines are within one edit: what follows their common beginning and at most one
    character of either is the same. The beginning is found by halving, so that a check reads a line
    a few dozen times at most, where a table of distances grows with the square of its length."""
    sizes = F.length(one), F.length(two)

    def further(found: Column, step: Column) -> Column:
        to = found + step
        same = F.substring(one, F.lit(1), to) == F.substring(two, F.lit(1), to)
        return F.when((to <= F.least(*sizes)) & same, to).otherwise(found)

    steps = F.array(*(F.lit(1 << k) for k in range(30, -1, -1)))
    begin = F.aggregate(steps, F.lit(0), further)

    def rest(line: Column, own: Column, other: Column, at: Column) -> Column:
        return F.substring(line, at + 1 + F.when(own >= other, 1).otherwise(0), own)

    same = F.transform(F.array(begin), lambda at: rest(one, *sizes, at) == rest(two, *reversed(sizes), at))[0]
    return (F.abs(sizes[0] - sizes[1]) <= 1) & same


def _near(docs: DataFrame, lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """Places of first occurrences that have a distinct line within one edit before them."""
    variants, texts = _variants(docs, _candidates(lines, firsts))
    equal, deleted = F.col("_at") < 0, F.col("_at") >= 0
    alike = W.partitionBy("variant")
    same = W.partitionBy("variant", "_at", "short")

    def earliest(who: Column, within) -> Column:
        return F.min(F.when(who, F.col("place"))).over(within)

    # one character more or less: the block of the one is the variant of the other
    across = F.when(~F.col("short"), earliest(equal, alike)).when(equal, earliest(~F.col("short"), alike))
    # one character replaced: the same variant by deletion at the same place
    replaced = F.when(F.col("short") & deleted, earliest(F.col("short") & deleted, same))
    met = variants.withColumns({"_across": across, "_replaced": replaced})
    met = met.select("place", F.explode(F.array("_across", "_replaced")).alias("witness"))
    pairs = met.filter(F.col("witness") < F.col("place")).distinct()
    texts = staged(texts, "line-checked")
    checked = pairs.join(texts, "place").join(
        texts.select(F.col("place").alias("witness"), F.col("line").alias("other")), "witness"
    )
    return checked.filter(_within_one(F.col("line"), F.col("other"))).select("place.*").distinct()


def _joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """A join on the row's identity, in which a null id equals a null id."""
    other = right.withColumnsRenamed({"_doc": "_doc2", "_row": "_row2"})
    on = F.col("_doc").eqNullSafe(F.col("_doc2")) & F.col("_row").eqNullSafe(F.col("_row2"))
    return left.join(other, on, how).drop("_doc2", "_row2")


def _without_gone(all_lines: Column) -> Column:
    kept = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("_gone"))
    return F.array_join(F.transform(kept, lambda i: F.element_at(all_lines, i + 1)), "\n")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, max_edits: int = 1) -> DataFrame:
    """``docs`` with duplicate lines taken out of text, and n_lines and n_removed.

    Lines end at a line feed and are compared as they are. A line of at least ``min_chars``
    characters goes if an equal one, or one within ``max_edits`` (0 or 1) edits, stands earlier:
    in a document with a smaller doc_id or before it in the same one, a null id coming first.
    Earlier lines count whether or not they go themselves.

    Null texts stay null and have no lines; an empty text is one empty line. Rows that repeat an
    id and its text hold one place and are treated alike; rows that share only the id are ordered
    by a hash of the text. Columns called n_lines or n_removed are replaced, all others stay. No
    documents give no rows.
    """
    if max_edits not in (0, 1):
        raise ValueError("max_edits is 0 or 1")
    docs = docs.drop("n_lines", "n_removed")
    places = _places(docs, min_chars)
    keys = _blocks(F.col("_line"), with_number=False)
    lines = places.select(*_identity(F.col("_line")), *_LINE, *([keys.alias("keys")] if max_edits else []))
    lines = staged(lines, "lines")
    firsts = _earliest(lines)
    again = firsts.filter("n > 1").select("_h", "_g", "first")
    gone = [lines.join(again, ["_h", "_g"]).filter(F.struct(*_LINE) != F.col("first")).select(*_LINE)]
    if max_edits:
        gone.append(_near(docs, lines, firsts))
    removed = reduce(DataFrame.union, gone).groupBy("_doc", "_row").agg(F.collect_set("_no").alias("_gone"))
    whole = docs.withColumns({"_doc": F.col("doc_id"), "_row": _row_key()})
    found = _joined(whole, staged(removed, "lines-gone"), "left")
    # bound to a lambda's argument, so that the text is split once
    kept = F.transform(F.array(F.split("text", "\n", -1)), _without_gone)[0]
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    out = {
        "n_lines": F.coalesce(breaks + 1, F.lit(0)).cast("long"),
        "n_removed": F.coalesce(F.size("_gone"), F.lit(0)).cast("long"),
        "text": F.when(F.col("_gone").isNull(), F.col("text")).otherwise(kept),
    }
    return found.select(*[out["text"].alias(c) if c == "text" else F.col(c) for c in docs.columns], *[
        out[c].alias(c) for c in ("n_lines", "n_removed")
    ])
