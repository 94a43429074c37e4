"""Which landed files a raw table has taken: by path, length and time of their last change.

A file is taken with a load. The load's files are recorded before it, and count once its folder is
complete, or once the load has said that none of their rows was stored; so neither a lost load nor a
repeated run takes or leaves a file twice. A file that is rewritten under its name is another file.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart import session

FILES = "load_key string, path string, length bigint, modified timestamp"
_KEY = ["path", "length", "modified"]


def _beside(table_path: str) -> str:
    head, _, name = table_path.rstrip("/").rpartition("/")
    return f"{head}/_files/{name}"


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """(path, length, modified) of the files below a landing; none of them is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing)
    return listed.select("path", "length", F.col("modificationTime").alias("modified"))


def taken_files(spark: SparkSession, table_path: str) -> DataFrame | None:
    """(path, length, modified) of the files whose loads are stored; None before the first."""
    ledger = _beside(table_path)
    if not session.path_exists(spark, ledger):
        return None
    recorded = spark.read.schema(FILES).parquet(ledger)
    stored = [f.rsplit("load=", 1)[-1] for f in session.child_folders(spark, table_path) if session.table_exists(spark, f)]
    done = recorded.filter(F.col("path").isNull()).select("load_key")
    if stored:
        done = done.union(spark.createDataFrame([(key,) for key in stored], "load_key string"))
    return recorded.filter(F.col("path").isNotNull()).join(done.distinct(), "load_key", "left_semi").select(*_KEY)


def new_files(spark: SparkSession, landing: str, table_path: str) -> DataFrame:
    """The landed files that no stored load of the table has taken."""
    listed, taken = landed_files(spark, landing), taken_files(spark, table_path)
    return listed if taken is None else listed.join(taken, _KEY, "left_anti")


def record(files: DataFrame, table_path: str, load_key: str) -> None:
    """Notes the files a load is about to take."""
    files.select(F.lit(load_key).alias("load_key"), *_KEY).coalesce(1).write.mode("append").parquet(_beside(table_path))


def record_empty(spark: SparkSession, table_path: str, load_key: str) -> None:
    """Notes that a load took its files and stored nothing."""
    row = spark.createDataFrame([(load_key, None, None, None)], FILES)
    row.coalesce(1).write.mode("append").parquet(_beside(table_path))


def paths(files: DataFrame) -> list[str]:
    """Paths to read the files by; characters that would be patterns stand for themselves."""
    return ["".join(f"\\{c}" if c in "\\[]{}*?" else c for c in row["path"]) for row in files.select("path").collect()]
