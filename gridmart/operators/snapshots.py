"""First, last and latest rows per key, without gathering a key's rows in one task."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _matched(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A semi or anti join in which a NULL key part equals a NULL one."""
    renamed = other.select(*[F.col(k).alias(f"_other_{k}") for k in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_other_{k}")) for k in keys]
    return df.join(renamed, reduce(Column.__and__, on), how).select(*df.columns)


def having(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key ``other`` has, with their columns in their own order."""
    return _matched(df, other, keys, "left_semi")


def lacking(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key ``other`` lacks, with their columns in their own order."""
    return _matched(df, other, keys, "left_anti")


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # ``row_number() = 1`` keeps one row per key in every map task before the shuffle
    # (WindowGroupLimit), so a key that holds most of the rows moves one row per task.
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def _rest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[str]:
    return [name for name in df.columns if name not in {*keys, *order}]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The earliest row of each key. The remaining columns break ties, so reruns agree."""
    ranking = [F.asc_nulls_last(c) for c in [*order, *_rest(df, keys, order)]]
    return _one_per_key(df, keys, ranking)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The latest row of each key. The remaining columns break ties, so reruns agree."""
    ranking = [F.desc_nulls_last(c) for c in [*order, *_rest(df, keys, order)]]
    return _one_per_key(df, keys, ranking)


def newest_rows(df: DataFrame, column: str, source: DataFrame | None = None) -> DataFrame:
    """Rows whose ``column`` equals its maximum.

    The maximum is a scalar subquery: one partial aggregate, and a literal by the time the
    rows are scanned, so it also prunes files.
    """
    top = (source or df).select(F.max(column)).scalar()
    return df.filter(F.col(column) == top)


def newest_rows_per_key(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """All rows of each key that carry the key's maximum of ``column``.

    A window per key would sort a key's whole history in one task; the maximum is aggregated
    map-side instead and joined back.
    """
    newest = df.groupBy(*keys).agg(F.max(column).alias(column))
    return having(df, newest, [*keys, column])
