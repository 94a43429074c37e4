"""Rounding, guarded division, shares and changes over time."""

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def rounded(value: ColumnLike, digits: int) -> Column:
    """Round half away from zero, in decimals.

    Rounding a double directly disagrees at ties (1.005 to two digits), so the value is
    brought to eight digits first.
    """
    exact = _col(value).cast("decimal(38,8)")
    return F.round(exact, digits).cast(f"decimal(28,{digits})")


def ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Quotient in double precision; NULL for a zero denominator, which ANSI mode rejects."""
    return _col(numerator).cast("double") / F.nullif(_col(denominator).cast("double"), F.lit(0.0))


def mean(value: ColumnLike) -> Column:
    """Average from an exact sum; ``avg`` of a decimal keeps only four more digits."""
    return ratio(F.sum(_col(value)), F.count(_col(value)))


def safe_divide(numerator: ColumnLike, denominator: ColumnLike, default=0) -> Column:
    """Quotient, or ``default`` when the denominator is zero or NULL."""
    bottom = _col(denominator)
    usable = bottom.isNotNull() & (bottom != F.lit(0))
    return F.when(usable, _col(numerator) / F.nullif(bottom, F.lit(0))).otherwise(F.lit(default))


def share_pct(part: ColumnLike, whole: ColumnLike) -> Column:
    return rounded(ratio(part, whole) * 100, 2)


def pct_of_total(value: ColumnLike, by: Sequence[ColumnLike]) -> Column:
    """Percentage of the group's total.

    A window over ``by``: apply it to aggregated rows, where a group is as small as its
    dimension, and not to raw rows.
    """
    total = F.sum(_col(value)).over(Window.partitionBy(*by))
    return share_pct(value, total)


def change_pct(value: ColumnLike, earlier: Column) -> Column:
    """Percentage change against ``earlier``; NULL without an earlier value or if it is zero."""
    now = _col(value).cast("double")
    then = earlier.cast("double")
    return rounded((now - then) / F.nullif(then, F.lit(0.0)) * 100, 2)


def yoy_change_pct(
    value: ColumnLike, by: Sequence[ColumnLike], order: ColumnLike, rows: int = 12, *ties: ColumnLike
) -> Column:
    """Percentage change against the value ``rows`` rows earlier in the group (12 = a year).

    ``ties`` order rows that ``order`` does not tell apart.
    """
    series = Window.partitionBy(*by).orderBy(order, *[_col(t).asc_nulls_last() for t in ties])
    return change_pct(value, F.lag(_col(value), rows).over(series))
