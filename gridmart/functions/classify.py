"""Classification rules as CASE expressions."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fuel codes counted as renewable and as low carbon.
RENEWABLE_CODES = ["WWW", "WND", "SUN", "SOL", "HYC", "GEO", "BIO"]
LOW_CARBON_CODES = ["NUC"]

# Upper limits (exclusive) of the life-cycle classes, gCO2eq/kWh.
CARBON_LIMITS = [(100, "low"), (500, "medium")]

# Upper limits (exclusive) of spot price over base price.
SIGNAL_LIMITS = [(0.6, "low"), (1.4, "normal"), (2.5, "high")]


def fuel_category(fuel_code: Column) -> Column:
    """Every code outside the two lists counts as fossil, unknown codes included."""
    return (
        F.when(fuel_code.isin(RENEWABLE_CODES), "renewable")
        .when(fuel_code.isin(LOW_CARBON_CODES), "low_carbon")
        .otherwise("fossil")
    )


def carbon_category(lifecycle: Column) -> Column:
    """Class of a life-cycle intensity; a negative one is no class of its own and reads high."""
    named = F.when(lifecycle < 0, "high")
    for limit, name in CARBON_LIMITS:
        named = named.when(lifecycle < limit, name)
    return F.when(lifecycle.isNotNull(), named.otherwise("high"))


def price_signal(spot: Column, base: Column) -> Column:
    level = spot.cast("double") / base.cast("double")
    (first_limit, first_name), *others = SIGNAL_LIMITS
    named = F.when(level < first_limit, first_name)
    for limit, name in others:
        named = named.when(level < limit, name)
    return F.when(level.isNotNull(), named.otherwise("critical"))


def known_or(value: Column, members: Iterable[str], default: str) -> Column:
    """``value`` if it is one of ``members``, else ``default`` (also for NULL)."""
    return F.when(value.isin(list(members)), value).otherwise(default)


def confidence_at(hours_ahead: Column) -> Column:
    """Forecast confidence in percent: loses 0.3 points an hour and never falls below 50."""
    return F.greatest(F.lit(50.0), F.lit(99.0) - F.lit(0.3) * hours_ahead)
