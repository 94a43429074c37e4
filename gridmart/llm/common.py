"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.session import remove_folder, scratch_path


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_temporary: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables that ``staged`` writes inside go when the block ends: what is made of them has to be
    written by then."""
    _temporary.append([])
    try:
        yield
    finally:
        for path in _temporary.pop():
            remove_folder(spark, path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again.

    Cuts the lineage: what follows is recomputed from files every executor can read,
    never from another executor's disk. The shuffle files of the write go when it is done.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if _temporary:
        _temporary[-1].append(path)
    before = spark.conf.get(_CLEANED, "false")
    spark.conf.set(_CLEANED, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANED, before)
    return spark.read.schema(df.schema).parquet(path)


def crc_bucket(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 4: the fixed fold of the labelled rows."""
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 4
