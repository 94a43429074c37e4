"""Declared data-quality checks, run over a table in one scan."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart import schemas
from gridmart.functions.classify import CARBON_LIMITS
from gridmart.sources.dims import KNOWN_FUELS
from gridmart.sources.landing import outside


@dataclass(frozen=True)
class Check:
    column: str
    kind: str  # not_null, unique, accepted_values or accepted_range
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    severity: str = "error"

    def failed(self) -> Column:
        """True for a row that fails. A NULL passes everything but not_null."""
        value = F.col(self.column)
        if self.kind == "not_null":
            return value.isNull()
        if self.kind == "accepted_values":
            return ~value.isin(list(self.values))
        if self.kind == "accepted_range":
            return outside(value, self.low, self.high)
        raise ValueError(f"{self.kind} is not a row check")


def not_null(*columns: str) -> list[Check]:
    return [Check(column, "not_null") for column in columns]


def unique(column: str) -> Check:
    return Check(column, "unique")


def accepted_values(column: str, values: Sequence[str], severity: str = "error") -> Check:
    return Check(column, "accepted_values", values=tuple(values), severity=severity)


def accepted_range(column: str, low=None, high=None, severity: str = "error") -> Check:
    return Check(column, "accepted_range", low=low, high=high, severity=severity)


# Sector codes of the price table and fuel categories.
SECTORS = ["RES", "COM", "IND", "TRA", "ALL", "OTH"]
FUEL_CATEGORIES = ["renewable", "low_carbon", "fossil"]
CARBON_CATEGORIES = [name for _, name in CARBON_LIMITS] + ["high"]

# The checks of every table.
RAW_CHECKS = {
    schemas.GENERATION: [
        unique("id"),
        *not_null("id", "period", "state_code", "fuel_type_code", "ingested_at"),
    ],
    schemas.PRICES: [
        unique("id"),
        *not_null("id", "period", "state_code", "sector_id", "ingested_at"),
        accepted_values("sector_id", SECTORS),
    ],
    schemas.WEATHER: [unique("id"), *not_null("id", "region", "recorded_at")],
    schemas.CARBON: [unique("id"), *not_null("id", "region", "fuel_type", "recorded_at")],
    schemas.MARKET: [unique("id"), *not_null("id", "region", "recorded_at")],
    schemas.FORECAST: [
        unique("id"),
        *not_null("id", "region", "forecast_hour", "forecast_demand_mw"),
    ],
}
BRONZE_CHECKS = {
    "bronze_eia_generation": not_null("id", "period", "state_code", "fuel_type_code"),
    "bronze_eia_prices": not_null("id", "period", "state_code"),
    "bronze_weather": not_null("id", "region", "recorded_at"),
    "bronze_carbon_intensity": not_null("id", "region", "fuel_type"),
    "bronze_market_prices": not_null("id", "region", "recorded_at"),
}
SILVER_CHECKS = {
    "silver_generation_cleaned": not_null(
        "period", "state_code", "fuel_type_code", "generation_mwh", "period_year", "period_month"
    ),
    "silver_prices_cleaned": [
        *not_null("period", "state_code", "price_usd_per_mwh"),
        accepted_range("price_usd_per_mwh", 0, 5000),
    ],
    "silver_weather_aggregated": not_null("region", "reading_date", "avg_temperature_c"),
    "silver_carbon_reference": [
        *not_null("region", "fuel_type", "avg_direct_co2_per_mwh"),
        accepted_values("fuel_type", KNOWN_FUELS),
        accepted_range("avg_direct_co2_per_mwh", 0, 2000),
    ],
    "silver_market_aggregated": [
        *not_null("region", "reading_date", "avg_spot_price_usd_mwh"),
        accepted_range("avg_spot_price_usd_mwh", 0, 10000),
    ],
}
GOLD_CHECKS = {
    "gold_generation_by_fuel_monthly": [
        *not_null("period", "state_code", "fuel_type_code", "total_generation_mwh"),
        accepted_range("total_generation_mwh", 0, severity="warn"),
        accepted_range("pct_of_state_generation", 0, 100, severity="warn"),
        *not_null("fuel_category"),
        accepted_values("fuel_category", FUEL_CATEGORIES),
    ],
    "gold_price_trends": [
        *not_null("period", "state_code", "price_usd_per_mwh"),
        accepted_range("price_usd_per_mwh", 0, 10000),
    ],
    "gold_carbon_footprint": [
        *not_null("period", "state_code", "total_generation_mwh"),
        accepted_range("renewable_share_pct", 0, 100),
        accepted_range("clean_energy_share_pct", 0, 100),
        accepted_range("grid_carbon_intensity_gco2_kwh", 0, 2000),
    ],
    "gold_executive_summary": [
        *not_null("period", "state_code"),
        accepted_range("total_generation_mwh", 0),
        accepted_range("renewable_share_pct", 0, 100),
    ],
}
ALL_CHECKS = {**RAW_CHECKS, **BRONZE_CHECKS, **SILVER_CHECKS, **GOLD_CHECKS}


def run_checks(df: DataFrame, table: str, checks: Sequence[Check] | None = None) -> DataFrame:
    """Failures of every check of one table: (table_name, column_name, check_name, severity, failures)."""
    return run_checks_together(df, {table: ALL_CHECKS[table] if checks is None else checks})


def run_checks_together(df: DataFrame, declared: dict[str, Sequence[Check]], stored_ids: bool = False) -> DataFrame:
    """Checks declared under several names for the same rows, such as a table and the view over it.

    All row checks are counted in one aggregate over one scan. Uniqueness needs an aggregate of its
    own; it counts the values that occur more than once. ``stored_ids`` tells that they are read from
    files and were given out by loads: then their bits are counted first, which shuffles none of them.
    """
    everything = [(table, check) for table, checks in declared.items() for check in checks]
    by_row = [(table, check) for table, check in everything if check.kind != "unique"]
    by_value = [(table, check) for table, check in everything if check.kind == "unique"]
    parts = []
    if by_row:
        counted = df.agg(*[F.count_if(check.failed()).alias(f"c{i}") for i, (_, check) in enumerate(by_row)])
        lines = F.array(*[_line(table, check, F.col(f"c{i}")) for i, (table, check) in enumerate(by_row)])
        parts.append(counted.select(F.inline(lines)))
    for table, check in by_value:
        repeated = repeated_values(df, check.column, stored_ids).agg(F.count(F.lit(1)).alias("n"))
        parts.append(repeated.select(F.inline(F.array(_line(table, check, F.col("n"))))))
    return reduce(DataFrame.unionByName, parts)


def repeated_values(df: DataFrame, column: str, dense: bool = True) -> DataFrame:
    """Values that occur more than once, NULL left out.

    ``dense`` whole numbers, as loads give them out, are first counted as bits: tasks send a bitmap
    for each range of 32,768 numbers instead of the numbers. Only ranges that hold more rows than
    bits are looked at by value, and no value is shuffled where there is no such range. The frame is
    read up to three times, so it should be a scan.
    """
    values = df.filter(F.col(column).isNotNull()).select(column)
    if dense and values.schema[column].dataType.typeName() in ("long", "integer"):
        bits = F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(column)))
        ranges = values.groupBy(F.bitmap_bucket_number(column).alias("_range"))
        full = ranges.agg(F.count(F.lit(1)).alias("n"), bits.alias("bits")).filter("n > bits").select("_range")
        suspect = values.filter(full.select(F.count(F.lit(1)) > 0).scalar())
        values = suspect.withColumn("_range", F.bitmap_bucket_number(column)).join(full, "_range", "left_semi")
    return values.groupBy(column).count().filter("count > 1").select(column)


def _line(table: str, check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_name"),
        F.lit(check.severity).alias("severity"),
        failures.alias("failures"),
    )


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """The reports of several tables together, one scan each."""
    return reduce(DataFrame.unionByName, [run_checks(df, name) for name, df in tables.items()])


class QualityError(Exception):
    """Raised when a check of severity error failed."""


def enforce(report: DataFrame) -> DataFrame:
    """Raise if an error-level check failed; warnings only stay in the report.

    The report, a row for each declared check, is computed once; what is returned holds its rows.
    """
    rows = report.collect()
    broken = [r for r in rows if r.severity == "error" and r.failures > 0]
    if broken:
        raise QualityError(
            "; ".join(f"{r.table_name}.{r.column_name} {r.check_name}: {r.failures}" for r in broken)
        )
    return report.sparkSession.createDataFrame(rows, report.schema)
