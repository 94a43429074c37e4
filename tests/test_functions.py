import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridmart import functions as fn
from gridmart.sources import dims


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("number", "digits", "expected"),
    [(1.005, 2, "1.01"), (-1.005, 2, "-1.01"), (2.5, 0, "3"), (0.00005, 4, "0.0001"), (12.3449, 2, "12.34")],
)
def test_rounding_is_half_away_from_zero(spark, number, digits, expected):
    assert value(spark, fn.rounded(F.lit(number), digits)) == Decimal(expected)


def test_guarded_division(spark):
    assert value(spark, fn.ratio(F.lit(1), F.lit(4))) == 0.25
    assert value(spark, fn.ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, fn.safe_divide(F.lit(6), F.lit(3))) == 2
    assert value(spark, fn.safe_divide(F.lit(6), F.lit(0))) == 0
    assert value(spark, fn.safe_divide(F.lit(6), F.lit(None).cast("int"), default=-1)) == -1


def test_shares_sum_to_a_hundred_and_nulls_pass(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 3), ("b", 5), ("c", 0)], "k string, v int")
    shares = {(r.k, r.v): r.p for r in rows.withColumn("p", fn.pct_of_total("v", ["k"])).collect()}
    assert shares == {("a", 1): 25, ("a", 3): 75, ("b", 5): 100, ("c", 0): None}


def test_yearly_change_counts_rows(spark):
    rows = spark.createDataFrame([("a", n, 100 + n) for n in range(14)], "k string, n int, v int")
    changed = {r.n: r.y for r in rows.withColumn("y", fn.yoy_change_pct("v", ["k"], "n")).collect()}
    assert changed[11] is None
    assert changed[12] == Decimal("12.00")
    assert changed[13] == Decimal("11.88")


def test_change_against_zero_is_null(spark):
    assert value(spark, fn.change_pct(F.lit(5), F.lit(0))) is None


def test_period_parts(spark):
    period = F.lit("2024-07")
    assert value(spark, fn.period_year(period)) == 2024
    assert value(spark, fn.period_month(period)) == 7
    assert value(spark, fn.period_date(period)) == dt.date(2024, 7, 1)
    assert value(spark, fn.period_date(F.lit("2024-13"))) is None
    assert fn.trailing_period(dt.date(2024, 6, 30)) == "2024-04"


@pytest.mark.parametrize(
    ("fuel", "expected"),
    [("WWW", "renewable"), ("BIO", "renewable"), ("NUC", "low_carbon"), ("NG", "fossil"), ("OTH", "fossil"), ("ALL", "fossil")],
)
def test_fuel_category(spark, fuel, expected):
    assert value(spark, fn.fuel_category(F.lit(fuel))) == expected


@pytest.mark.parametrize(
    ("lifecycle", "expected"),
    [(0, "low"), (99.9, "low"), (100, "medium"), (499.9, "medium"), (500, "high"), (820, "high"), (-1, "high"), (None, None)],
)
def test_carbon_category(spark, lifecycle, expected):
    assert value(spark, fn.carbon_category(F.lit(lifecycle).cast("double"))) == expected


@pytest.mark.parametrize(
    ("spot", "expected"), [(26.9, "low"), (27, "normal"), (62.9, "normal"), (63, "high"), (112.4, "high"), (112.5, "critical")]
)
def test_price_signal(spark, spot, expected):
    assert value(spark, fn.price_signal(F.lit(spot), F.lit(45))) == expected


def test_unknown_members_fall_back(spark):
    assert value(spark, fn.known_or(F.lit("PJM"), dims.REGIONS, "ERCOT")) == "PJM"
    assert value(spark, fn.known_or(F.lit("MARS"), dims.REGIONS, "ERCOT")) == "ERCOT"
    assert value(spark, fn.known_or(F.lit(None).cast("string"), dims.REGIONS, "ERCOT")) == "ERCOT"


def test_dimensions(spark):
    assert dims.fuel_types(spark).count() == 12
    assert dims.price_regions(spark).count() == 31
    assert dims.summary_regions(spark).filter("state_code = 'TX'").count() == 2
    assert dims.summary_regions(spark, dedupe=True).count() == 14
    assert len(dims.STATES) == 49
    grid = dims.request_grid(spark)
    assert grid.count() == grid.distinct().count() == 63


def test_emission_factor_classes(spark):
    held = {r.fuel_type: r.category for r in dims.emission_factors(spark).collect()}
    assert len(held) == 10
    assert (held["coal"], held["natural_gas"], held["wind"], held["biomass"]) == ("high", "medium", "low", "medium")


def test_horizon(spark):
    from gridmart.operators.horizon import hourly_spine

    issue = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5, 40),)], "issued timestamp")
    rows = hourly_spine(issue, "issued", 168).orderBy("hours_ahead").collect()
    assert len(rows) == 168
    assert rows[0].forecast_hour == dt.datetime(2024, 1, 1, 5)
    assert rows[25].forecast_hour == dt.datetime(2024, 1, 2, 6)
    levels = [r.confidence_pct for r in rows]
    assert levels[0] == 99 and levels[10] == 96 and min(levels) == 50
    assert levels == sorted(levels, reverse=True)
    for hours in (0, 169):
        with pytest.raises(ValueError):
            hourly_spine(issue, "issued", hours)
    lengths = issue.select("issued", F.explode(F.array(F.lit(1), F.lit(168))).alias("hours"))
    assert hourly_spine(lengths, "issued", F.col("hours")).count() == 169
    for hours in (0, 169, None):
        with pytest.raises(Exception, match="hours must be between"):
            hourly_spine(issue, "issued", F.lit(hours).cast("int")).collect()
