"""Hourly forecast spine."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.functions.classify import confidence_at

MAX_HOURS = 168


def hourly_spine(issues: DataFrame, start: str, hours: int | Column) -> DataFrame:
    """Unfold each issue row into its next ``hours`` full hours (1 to 168) with confidence.

    A length outside that range, or NULL, raises: at once for a number, when the row is read for a
    column. The number of rows per issue is bounded by the horizon, so the unfolding stays in the
    task that holds the issue.
    """
    if isinstance(hours, int):
        if not 1 <= hours <= MAX_HOURS:
            raise ValueError(f"hours must be between 1 and {MAX_HOURS}")
        hours = F.lit(hours)
    fits = F.coalesce(hours.between(1, MAX_HOURS), F.lit(False))
    refused = F.raise_error(F.lit(f"hours must be between 1 and {MAX_HOURS}")).cast("int")
    length = F.when(fits, hours.cast("int")).otherwise(refused)
    ahead = F.explode(F.sequence(F.lit(0), length - 1)).alias("hours_ahead")
    unfolded = issues.select("*", ahead)
    # the start's own type is kept, with or without a time zone
    first = F.date_trunc("hour", F.col(start)).cast(issues.schema[start].dataType)
    at = first + F.make_dt_interval(hours=F.col("hours_ahead"))
    return unfolded.withColumns(
        {
            "forecast_hour": at,
            "confidence_pct": F.round(confidence_at(F.col("hours_ahead")).cast("decimal(18,8)"), 2).cast("decimal(5,2)"),
        }
    )
