"""Table, view and report sinks."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.sources import versions


def refresh_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh: ``df``, which may read the table, becomes its next version.

    Readers keep the version they have; a run that dies leaves the one before.
    """
    versions.replace(df, path, partition_by)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def title(name: str) -> str:
    return name.replace("_", " ").title()


def write_report(df: DataFrame, path: str) -> None:
    """One CSV file with titled headers.

    For report queries, whose limit keeps them at most a few thousand rows; the sort order
    of the frame is kept because a single task writes it.
    """
    titled = df.select(*[F.col(name).alias(title(name)) for name in df.columns])
    titled.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_reports(reports: dict[str, DataFrame], root: str) -> list[str]:
    for name, df in reports.items():
        write_report(df, f"{root}/{name}")
    return list(reports)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A derived table in its current version."""
    stored = versions.read(spark, path)
    if stored is None:
        raise FileNotFoundError(f"{path} was not built yet")
    return stored
