"""Reporting periods (``YYYY-MM`` text) and code clean-up."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def period_year(period: Column) -> Column:
    return F.split_part(period, F.lit("-"), F.lit(1)).try_cast("int")


def period_month(period: Column) -> Column:
    return F.split_part(period, F.lit("-"), F.lit(2)).try_cast("int")


def period_date(period: Column) -> Column:
    """First day of the period; NULL for a month that does not exist."""
    month = period_month(period)
    return F.when(month.between(1, 12), F.make_date(period_year(period), month, F.lit(1)))


def code(value: Column) -> Column:
    """Codes compare upper-case and without surrounding blanks."""
    return F.upper(F.trim(value))


def trailing_period(as_of: dt.date | dt.datetime, days: int = 90) -> str:
    """Period in which a window of ``days`` before ``as_of`` starts."""
    return (as_of - dt.timedelta(days=days)).strftime("%Y-%m")
