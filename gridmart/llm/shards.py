"""Range sharding by sampled splitters.

Records are ordered by a key that keeps equal texts together. A size-weighted sample of keys gives
splitters at its quantiles; they cut the records into many small ranges. Ranges that hold too much
are subdivided by splitters sampled inside them. Sizes and counts of the ranges, a short list, then
say where each shard begins; a range that a shard boundary cuts is divided at that row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridmart.llm.common import staged

#: Ranges for each shard at least, and rows a range should hold at most.
RANGES_PER_SHARD = 8
ROWS_PER_RANGE = 500_000
#: Sampled keys for each range.
SAMPLES_PER_RANGE = 32
#: A range is overfull beyond this many times the mean, by bytes or by rows.
OVERFULL = 2.0
ROUNDS = 6

_KEY = ("_group", "_id", "_tie")


def _sortable(group, row_id, tie) -> np.ndarray:
    """The three longs as 24 bytes that sort as the longs do."""
    columns = [np.asarray(c, np.int64).view(np.uint64) ^ np.uint64(1 << 63) for c in (group, row_id, tie)]
    return np.ascontiguousarray(np.stack(columns, 1).astype(">u8")).view("S24").ravel()


def _sample(keyed: DataFrame, per_byte: float) -> pd.DataFrame:
    """Keys drawn with a chance in proportion to their size, with what each stands for.

    The draw hangs on a hash of the key, so a repeated attempt draws the same ones.
    """
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(per_byte))
    even = F.pmod(F.xxhash64(F.lit("draw"), *_KEY), F.lit(2**30)) / F.lit(float(2**30))
    weight = F.greatest(F.lit(1.0), F.col("size") * F.lit(per_byte))
    return keyed.filter(even < chance).select(*_KEY, weight.alias("weight")).toPandas()


def _quantiles(sample: pd.DataFrame, ranges: int) -> np.ndarray:
    """Sorted splitters that cut the sampled weight into ``ranges`` equal parts."""
    if sample.empty or ranges < 2:
        return np.empty(0, "S24")
    keys = _sortable(sample["_group"], sample["_id"], sample["_tie"])
    order = np.argsort(keys, kind="stable")
    total = np.cumsum(sample["weight"].to_numpy()[order])
    wanted = total[-1] * np.arange(1, ranges) / ranges
    return np.unique(keys[order][np.minimum(np.searchsorted(total, wanted), len(order) - 1)])


def _ranged(keyed: DataFrame, splitters: np.ndarray) -> DataFrame:
    """``keyed`` with the number of the range each key falls into."""
    sent = keyed.sparkSession.sparkContext.broadcast(splitters)

    @F.pandas_udf("long")
    def range_of(group: pd.Series, row_id: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(sent.value, _sortable(group, row_id, tie), side="right").astype(np.int64))

    return keyed.withColumn("_range", range_of(*_KEY))


def _measured(ranged: DataFrame) -> pd.DataFrame:
    sums = ranged.groupBy("_range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    return sums.toPandas().sort_values("_range", ignore_index=True)


def assign_shards(records: DataFrame, shards: int = 16, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``records`` (group long, id long, size long, any others) with shard and slot.

    Shards hold nearly equal sums of ``size``: each boundary lies within half a record of its
    place. Records are ordered by group, then id, so a group lies in one shard or, where its
    bytes need more room, in neighbouring ones. ``slot`` counts a shard's records from 0 without
    a gap. Null groups and ids count as 0 and null sizes as 0; rows that repeat others keep an
    order of their own from the time they were staged. No records give no rows.

    The driver holds the splitters and one line per range, some dozens of bytes for every
    ``rows_per_range`` rows.
    """
    tie = F.monotonically_increasing_id()
    group, row_id = (F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("group", "id"))
    named = records.select("*", group.alias("_group"), row_id.alias("_id"), tie.alias("_tie"))
    keyed = staged(named.withColumn("size", F.coalesce(F.col("size"), F.lit(0))), "shard-keys")
    whole = keyed.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    rows, total = whole["rows"], max(1, whole["bytes"] or 0)
    ranges = max(shards * RANGES_PER_SHARD, -(-rows // rows_per_range))
    splitters = _quantiles(_sample(keyed, ranges * SAMPLES_PER_RANGE / total), ranges)
    lines = _measured(_ranged(keyed, splitters))
    for _ in range(ROUNDS):
        most_bytes, most_rows = OVERFULL * total / ranges, max(OVERFULL * rows / ranges, rows_per_range)
        over = lines[((lines["bytes"] > most_bytes) | (lines["rows"] > most_rows)) & (lines["rows"] > 1)]
        if over.empty:
            break
        inside = _ranged(keyed, splitters).filter(F.col("_range").isin(over["_range"].tolist()))
        parts = int(np.ceil(np.maximum(over["bytes"] / most_bytes, over["rows"] / most_rows)).sum()) * 2
        # every row of an overfull range counts here, so that many small ones are divided as well
        even = inside.withColumn("size", F.col("size") + F.lit(max(1, total // max(1, rows))))
        weight = int(over["bytes"].sum()) + int(over["rows"].sum()) * max(1, total // max(1, rows))
        more = _quantiles(_sample(even, parts * SAMPLES_PER_RANGE / weight), parts)
        finer = np.unique(np.concatenate([splitters, more]))
        if len(finer) == len(splitters):
            break
        splitters = finer
        lines = _measured(_ranged(keyed, splitters))
    return _numbered(keyed, splitters, lines, total, shards)


def _numbered(keyed: DataFrame, splitters: np.ndarray, lines: pd.DataFrame, total: int, shards: int) -> DataFrame:
    spark = keyed.sparkSession
    lines["_byte0"] = lines["bytes"].cumsum() - lines["bytes"]
    lines["_row0"] = lines["rows"].cumsum() - lines["rows"]
    starts = spark.createDataFrame(
        [tuple(map(int, r)) for r in lines[["_range", "_byte0", "_row0"]].itertuples(index=False)],
        "_range long, _byte0 long, _row0 long",
    )
    placed = _ranged(keyed, splitters).join(F.broadcast(starts), "_range")
    inside = W.partitionBy("_range").orderBy(*_KEY)
    before = F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    middle = F.col("_byte0") + before + F.col("size") / 2
    placed = placed.withColumn("_row", F.col("_row0") + F.row_number().over(inside) - 1)
    placed = placed.withColumn("shard", F.least(F.floor(middle * shards / total), F.lit(shards - 1)).cast("int"))
    placed = staged(placed.drop("_range", "_byte0", "_row0", *_KEY), "shard-places")
    first = {r["shard"]: r["at"] for r in placed.groupBy("shard").agg(F.min("_row").alias("at")).collect()}
    known = F.array(*(F.lit(first.get(s, 0)).cast("long") for s in range(shards)))
    return placed.withColumn("slot", F.col("_row") - F.element_at(known, F.col("shard") + 1)).drop("_row")
