"""Idempotent inserts, upserts by key and incremental deltas over Parquet tables."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart import schemas, session
from gridmart.operators.loads import append_load, stored_loads
from gridmart.operators.snapshots import first_per_key, having, lacking, last_per_key
from gridmart.sources import versions
from gridmart.sources.raw import column_names

EPOCH = "1900-01-01"
BROADCAST_KEYS = 200_000
LISTED_PARTITIONS = 5_000


# ---- pure frames -------------------------------------------------------------------------


def insert_new(
    delta: DataFrame,
    existing: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    range_column: str | None = None,
) -> DataFrame:
    """Rows of ``delta`` whose key is not loaded yet; the first of equal keys wins.

    ``range_column`` (one of the keys) limits the look-up to the span the delta covers, so
    only those partitions of a large table are read. The loaded keys are made distinct
    before they meet the delta: a key that was stored many times costs one row per task.
    """
    loaded = existing
    if range_column:
        span = delta.select(F.struct(F.min(range_column).alias("low"), F.max(range_column).alias("high"))).scalar()
        loaded = loaded.filter(F.col(range_column).between(span["low"], span["high"]))
    fresh = first_per_key(delta, keys, order)
    return lacking(fresh, loaded.select(*keys).distinct(), keys)


def upsert(
    existing: DataFrame | None,
    delta: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    small_delta: bool = False,
) -> DataFrame:
    """Replace rows of equal key and add the rest; the latest row of the delta wins.

    ``existing`` holds one row per key. Columns that only one side has are kept and read
    NULL on the other (appended columns).

    ``small_delta`` tells that the delta's size has been checked: its keys are broadcast and
    the existing rows stay where they are. Otherwise both sides go through one shuffle by
    key, in which a row of the delta ranks before an existing one.
    """
    if existing is None:
        return last_per_key(delta, keys, order)
    if small_delta:
        newest = last_per_key(delta, keys, order)
        untouched = lacking(existing, newest.select(*keys).hint("broadcast"), keys)
        return untouched.unionByName(newest, allowMissingColumns=True)
    both = existing.withColumn("_fresh", F.lit(False)).unionByName(
        delta.withColumn("_fresh", F.lit(True)), allowMissingColumns=True
    )
    return last_per_key(both, keys, ["_fresh", *order]).drop("_fresh")


def since_watermark(
    source: DataFrame,
    target: DataFrame | None,
    column: str = "ingested_at",
    lookback_days: int = 0,
) -> DataFrame:
    """Source rows loaded after the newest row of the target (strictly after).

    The watermark is a scalar subquery and reaches the scan as a literal. ``lookback_days``
    re-reads that many days before it.
    """
    if target is None:
        return source
    kind = source.schema[column].dataType.simpleString()
    floor = F.lit(EPOCH).cast(kind)
    newest = F.coalesce(F.max(F.col(column)).cast(kind), floor)
    if lookback_days:
        newest = newest - F.expr(f"interval {int(lookback_days)} days")
    return source.filter(F.col(column) > target.select(newest.alias("mark")).scalar())


def recompute_touched(
    source: DataFrame,
    delta: DataFrame,
    aggregate: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    time_column: str,
) -> DataFrame:
    """Re-aggregate from the full source every key the delta touches.

    The source is cut to the days between the delta's first and last reading, aggregated by
    partial sums, and only then matched with the touched keys, so no raw row is shuffled
    for the match and a busy key costs nothing extra.
    """
    kind = source.schema[time_column].dataType

    def midnight(moment: Column) -> Column:
        return F.date_trunc("day", moment).cast(kind)

    # plain comparisons with the column itself, so that the bounds reach the scan
    first = delta.select(midnight(F.min(time_column))).scalar()
    after = delta.select(midnight(F.max(time_column) + F.expr("interval 1 day"))).scalar()
    span = source.filter((F.col(time_column) >= first) & (F.col(time_column) < after))
    touched = aggregate(delta).select(*keys)
    return having(aggregate(span), touched, keys)


# ---- stored tables -----------------------------------------------------------------------


@dataclass(frozen=True)
class MergeTarget:
    """Where a merged table lives and how its rows are told apart.

    The first column of ``order`` is the load time that watermarks are taken from.
    """

    path: str
    keys: tuple[str, ...]
    order: tuple[str, ...] = ("ingested_at",)
    partition_by: str | None = None


def existing_table(spark: SparkSession, target: MergeTarget) -> DataFrame | None:
    """The stored table in its current version; reading writes nothing."""
    return versions.read(spark, target.path)


def watermark(spark: SparkSession, target: MergeTarget) -> DataFrame | None:
    """The newest load time the table has taken in, for ``since_watermark``.

    A merge records it with its version, so that finding it does not scan the table.
    """
    version = versions.current(spark, target.path)
    if version is None:
        return None
    recorded = versions.recorded(spark, version, target.order[0])
    return versions.rows(spark, target.path, version) if recorded is None else recorded


def merge_table(spark: SparkSession, target: MergeTarget, delta: DataFrame) -> int:
    """Upsert ``delta`` into the stored table; returns the number of delta keys.

    The deduplicated delta is staged: it is computed once, and its size is known from then on. The
    merged rows of the partitions it touches are written beside the table's others, and one more
    version lists them in place of the old ones, with the schema and the watermark. A run that dies
    leaves the table as it was; of two that started from one version the second fails.
    """
    base = versions.current(spark, target.path)
    existing = None if base is None else versions.rows(spark, target.path, base)
    folder = session.scratch_path(spark, "delta")
    newest = last_per_key(delta, target.keys, target.order)
    newest.write.parquet(folder)
    staged = spark.read.schema(newest.schema).parquet(folder)
    size = staged.count()
    if size:
        if existing is not None and target.partition_by:
            existing = _touched_partitions(existing, staged, target.partition_by)
        merged = upsert(existing, staged, target.keys, small_delta=size <= BROADCAST_KEYS)
        merged = _clustered(merged, target)
        folders = versions.write_batch(merged, target.path, [target.partition_by] if target.partition_by else [])
        if base is not None and target.partition_by:
            touched = {versions.partition_of(f) for f in folders}
            folders = (*(f for f in base.folders if versions.partition_of(f) not in touched), *folders)
        seen = versions.newest_value(_with_recorded(spark, base, staged, target.order[0]), target.order[0])
        versions.commit(spark, target.path, base, folders, merged.schema, seen)
    session.remove_folder(spark, folder)
    return size


def _with_recorded(spark: SparkSession, base: versions.Version | None, staged: DataFrame, column: str) -> DataFrame:
    """Load times of a delta, and the newest one recorded before."""
    before = versions.recorded(spark, base, column) if base else None
    times = staged.select(column)
    return times if before is None else times.union(before.select(F.col(column).cast(staged.schema[column].dataType)))


def _clustered(df: DataFrame, target: MergeTarget) -> DataFrame:
    """Bring a partition's rows together so that a write makes few files per partition.

    ``rebalance`` lets the adaptive planner split a partition value that holds much of the
    table over several tasks and join small ones.
    """
    return df.hint("rebalance", target.partition_by) if target.partition_by else df


def _touched_partitions(existing: DataFrame, staged: DataFrame, column: str) -> DataFrame:
    """Existing rows of the partitions the delta touches.

    The values are listed only while they are few, which prunes the scan to exactly those
    folders; beyond that a semi join does the same without listing them.
    """
    values = staged.select(column).distinct()
    listed = [row[0] for row in values.limit(LISTED_PARTITIONS + 1).collect()]
    if len(listed) <= LISTED_PARTITIONS:
        among = F.col(column).isin([value for value in listed if value is not None])
        return existing.filter(among | F.col(column).isNull() if None in listed else among)
    return having(existing, values, [column])


def insert_into_table(
    spark: SparkSession,
    table: str,
    root: str,
    delta: DataFrame,
    order: Sequence[str],
    load_key: str,
    partition_by: str = "period",
) -> int:
    """Store the rows of ``delta`` whose load key the raw table lacks; returns how many.

    A load that is repeated under its ``load_key`` is compared with the other loads alone and
    replaces what it had stored.
    """
    path, keys = f"{root}/{table}", schemas.LOAD_KEYS[table]
    schemas.check_contract(delta, table, without=("id",))
    if session.path_exists(spark, path):
        stored = stored_loads(spark, table, root, without=load_key)
        fresh = insert_new(delta, stored, keys, order, range_column=partition_by)
    else:
        fresh = first_per_key(delta, keys, order)
    names = [name for name in column_names(table) if name != "id"]
    # ids follow the order of arrival: of two rows that later meet under one key the newer wins
    arrived = fresh.orderBy(*[F.asc_nulls_last(c) for c in order]).select(*names)
    return append_load(spark, path, arrived, load_key, [partition_by])
