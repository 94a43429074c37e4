"""One way into a raw table for batch and stream loads: numbered appends that can be repeated.

Every load has a folder of its own, ``load=<key>``, and a range of ids of its own. Loading a key
again, as a replayed stream batch does, replaces what it wrote before.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart import schemas, session

_ROW = (1 << 33) - 1


def _beside(path: str) -> str:
    head, _, name = path.rstrip("/").rpartition("/")
    return f"{head}/_ids/{name}"


def reserve_ids(spark: SparkSession, path: str, load_key: str, rows: int) -> int:
    """The first of ``rows`` ids that no load of the table has had. One writer per table is assumed."""
    log, first = _beside(path), 1
    if session.path_exists(spark, log):
        first = spark.read.schema("load_key string, upto bigint").parquet(log).agg(F.max("upto")).first()[0] or 1
    entry = spark.createDataFrame([(load_key, first + rows)], "load_key string, upto bigint")
    entry.coalesce(1).write.mode("append").parquet(log)
    return first


def append_load(
    spark: SparkSession, path: str, rows: DataFrame, load_key: str, partition_by: Sequence[str] = ()
) -> int:
    """Store ``rows`` as the load ``load_key`` of the table at ``path``; returns how many.

    Rows without an id column get dense ids that follow the rows of each task: the driver holds
    one number per task, no table is searched for its largest id and no size is a limit. The
    rows are staged first, so that the count, the ids and the write see the same rows.
    """
    folder = session.scratch_path(spark, "load")
    place = F.monotonically_increasing_id()
    given = "id" in rows.columns
    placed = rows if given else rows.withColumns({"_task": F.shiftright(place, 33), "_row": place.bitwiseAND(F.lit(_ROW))})
    placed.write.parquet(folder)
    staged = spark.read.schema(placed.schema).parquet(folder)
    if given:
        added = staged.count()
    else:
        counts = [(r["_task"], r["n"]) for r in staged.groupBy("_task").agg(F.count("*").alias("n")).collect()]
        added = sum(n for _, n in counts)
    if added:
        if not given:
            first, starts = reserve_ids(spark, path, load_key, added), []
            for task, n in sorted(counts):
                starts.append((task, first))
                first += n
            starts = F.broadcast(spark.createDataFrame(starts, "_task bigint, _first bigint"))
            numbered = staged.join(starts, "_task").withColumn("id", F.col("_first") + F.col("_row"))
            staged = numbered.select("id", *rows.columns)
        writer = staged.hint("rebalance", *partition_by).write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{path}/load={load_key}")
    session.remove_folder(spark, folder)
    return added


def stored_loads(spark: SparkSession, table: str, root: str, without: str | None = None) -> DataFrame:
    """The raw table, without the load ``without`` if it has been stored before."""
    names = schemas.raw_schema(table).names
    stored = spark.read.schema(schemas.RAW_TABLES[table]).parquet(f"{root}/{table}")
    if without is not None and "load" in stored.columns:
        stored = stored.filter(F.col("load").cast("string") != without)
    return stored.select(*names)
