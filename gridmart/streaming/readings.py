"""Structured Streaming paths for the frequent readings.

Each function starts a query and returns it. ``once=True`` works through everything that has
landed and stops; otherwise a batch runs every ``every`` interval. Checkpoints are arguments:
on a cluster they belong into a folder all executors reach.
"""

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from gridmart import schemas, session
from gridmart.operators import merge
from gridmart.operators.loads import append_load, stored_loads
from gridmart.plans import partials, silver
from gridmart.sources import landing

DEFAULT_INTERVAL = "15 minutes"


def stream_landing(spark: SparkSession, schema: str, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed JSON documents as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def stream_table(spark: SparkSession, schema, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A growing Parquet table as a stream of its new files."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _start(writer: DataStreamWriter, checkpoint: str, once: bool, every: str) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": every}
    query = writer.trigger(**trigger).start()
    if once:
        query.awaitTermination()
    return query


def _load_key(checkpoint: str, batch_id: int) -> str:
    """Names the load of one batch; a replay of the batch has the same."""
    return f"stream-{uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex[:12]}-{batch_id}"


def append_readings(
    rows: DataFrame,
    table_path: str,
    checkpoint: str,
    once: bool = True,
    every: str = DEFAULT_INTERVAL,
) -> StreamingQuery:
    """Append rows to a raw table, each batch as a load like any other: batch loads of the same
    table stay visible, ids are drawn from the same numbers, a replayed batch replaces itself."""

    def append_batch(batch: DataFrame, batch_id: int) -> None:
        append_load(batch.sparkSession, table_path, batch, _load_key(checkpoint, batch_id))

    return _start(rows.writeStream.foreachBatch(append_batch), checkpoint, once, every)


def landed_readings(documents: DataFrame, table: str) -> DataFrame:
    """Parsed and accepted readings of a landing stream, stamped with the load time."""
    return landing.stamped(landing.accepted(landing.normalise_readings(documents, table)))


def landed_forecasts(documents: DataFrame) -> DataFrame:
    """Flattened and accepted forecast points of a landing stream."""
    return landing.stamped(landing.accepted(landing.normalise_demand_forecast(documents)))


def daily_market_stream(readings: DataFrame, late_by: str | None = None) -> DataFrame:
    """Running daily market aggregate: one changing row per region and day.

    Without ``late_by`` no reading is ever too late; the state is one row per region and
    day. With it, days older than that are closed and their state is dropped.
    """
    timed = silver.market_readings(readings).withColumn("recorded_at", F.col("recorded_at").cast("timestamp"))
    if late_by:
        timed = timed.withWatermark("recorded_at", late_by)
    daily = timed.groupBy(F.window("recorded_at", "1 day"), "region").agg(*silver.market_measures())
    day = F.to_date(F.col("window.start")).alias("reading_date")
    return daily.select("region", day, *[c for c in daily.columns if c not in ("window", "region")])


def keep_merged(
    aggregate: DataFrame,
    target: merge.MergeTarget,
    checkpoint: str,
    once: bool = True,
    every: str = DEFAULT_INTERVAL,
) -> StreamingQuery:
    """Upsert the changed rows of a streaming aggregate into its table.

    An update carries the whole value of its key, not an increment, so a batch that is
    replayed after a failure writes the same rows again.
    """

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        merge.merge_table(batch.sparkSession, target, batch)

    writer = aggregate.writeStream.outputMode("update").foreachBatch(upsert_batch)
    return _start(writer, checkpoint, once, every)


def keep_partials(
    readings: DataFrame,
    model: partials.PartialModel,
    path: str,
    table: str,
    checkpoint: str,
    once: bool = True,
    every: str = DEFAULT_INTERVAL,
) -> StreamingQuery:
    """Keep a daily table current from partial rows at ``path``, without any stream state.

    Each batch is added to the sums of its days: readings of any age count, only the months of a
    batch are written, and a replayed batch is known by its number.
    """
    name = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex

    def add_batch(batch: DataFrame, batch_id: int) -> None:
        partials.take_in(batch.sparkSession, model, path, batch, (name, batch_id))
        partials.show(batch.sparkSession, model, path, table)

    return _start(readings.writeStream.foreachBatch(add_batch), checkpoint, once, every)


def insert_new_stream(
    rows: DataFrame,
    table: str,
    root: str,
    order: Sequence[str],
    checkpoint: str,
    once: bool = True,
    every: str = DEFAULT_INTERVAL,
) -> StreamingQuery:
    """Append only rows whose load key is new, across batches and restarts.

    A replayed batch replaces what it had stored.
    """

    def insert_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # staged once: the insert looks at the batch's span before it reads the batch itself
        folder = session.scratch_path(spark, "batch")
        batch.write.parquet(folder)
        staged = spark.read.schema(batch.schema).parquet(folder)
        merge.insert_into_table(spark, table, root, staged, order, _load_key(checkpoint, batch_id))
        session.remove_folder(spark, folder)

    return _start(rows.writeStream.foreachBatch(insert_batch), checkpoint, once, every)


def distinct_within(rows: DataFrame, keys: Sequence[str], event_time: str, late_by: str) -> DataFrame:
    """Suppress repeats that arrive within ``late_by`` of each other, with bounded state."""
    return rows.withWatermark(event_time, late_by).dropDuplicatesWithinWatermark(list(keys))


def refresh_days_stream(
    readings: DataFrame,
    model: silver.SilverModel,
    table: str,
    root: str,
    target: merge.MergeTarget,
    checkpoint: str,
    once: bool = True,
    every: str = DEFAULT_INTERVAL,
) -> StreamingQuery:
    """Append each batch to the raw table and re-aggregate the days it touches.

    Needs no stream state at all: late readings of any age are taken in.
    """

    def refresh_batch(batch: DataFrame, batch_id: int) -> None:
        spark, path, key = batch.sparkSession, f"{root}/{table}", _load_key(checkpoint, batch_id)
        if append_load(spark, path, batch, key):
            source = stored_loads(spark, table, root)
            delta = spark.read.schema(schemas.RAW_TABLES[table]).parquet(f"{path}/load={key}")
            built = merge.recompute_touched(source, delta, model.build, model.keys, model.time_column)
            merge.merge_table(spark, target, built)

    return _start(readings.writeStream.foreachBatch(refresh_batch), checkpoint, once, every)
