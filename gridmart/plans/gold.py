"""Gold marts. None of them sorts: a stored table has no order, so queries sort on reading."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmart.functions import (
    change_pct,
    fuel_category,
    mean,
    pct_of_total,
    period_date,
    period_month,
    period_year,
    ratio,
    rounded,
    share_pct,
    yoy_change_pct,
)
from gridmart.schemas import ENERGY, TONNES
from gridmart.sources import dims

PARITY_DIVISOR = 1_000_000  # the published formula
PHYSICAL_DIVISOR = 1_000  # g/kWh times MWh is kilograms, a thousand of which make a tonne


def _with_period_parts(df: DataFrame) -> DataFrame:
    """Year, month and date follow from the period: derived per group, not per raw row."""
    period = F.col("period")
    return df.withColumns(
        {
            "period_year": period_year(period),
            "period_month": period_month(period),
            "period_date": period_date(period),
        }
    )


def latest_carbon(carbon: DataFrame, per_fuel: bool = False) -> DataFrame:
    """One row per fuel type: its readings on the newest day it has any.

    ``matches`` is the number of those readings (one per region); ``per_fuel`` counts them
    as one averaged reading. Days are summed up first and the newest day's sums are kept,
    so the readings are read once and need no join with their own maximum.
    """
    direct, lifecycle = "avg_direct_co2_per_mwh", "avg_lifecycle_co2_per_mwh"
    days = carbon.groupBy(F.col("fuel_type").alias("carbon_fuel_type"), "reading_date").agg(
        F.sum(direct).cast("decimal(12,4)").alias("direct_sum"),
        mean(direct).alias("direct_mean"),
        mean(lifecycle).alias("lifecycle_mean"),
        F.count(F.lit(1)).alias("readings"),
    )
    newest = F.max_by(F.struct("direct_sum", "direct_mean", "lifecycle_mean", "readings"), "reading_date")
    rows = days.groupBy("carbon_fuel_type").agg(newest.alias("newest")).select("carbon_fuel_type", "newest.*")
    return rows.withColumn("matches", F.lit(1).cast("bigint") if per_fuel else F.col("readings"))


def generation_by_fuel(
    generation: DataFrame,
    carbon: DataFrame,
    carbon_join: str = "reference",
    co2_divisor: int = PARITY_DIVISOR,
) -> DataFrame:
    """Monthly generation per state and fuel with carbon intensity, CO2 and state share.

    The published mart joins each generation row with every region's reading of the fuel's
    newest day, so its sums count a row once per region (``carbon_join="reference"``).
    That is the plain sum times the number of readings: generation is summed before the
    join and multiplied after it, and no row is repeated. ``"preaggregated"`` averages the
    readings per fuel first, so that the sums stay true.
    """
    if carbon_join not in ("reference", "preaggregated"):
        raise ValueError(f"unknown carbon_join: {carbon_join}")
    spark = generation.sparkSession
    monthly = (
        generation.filter(F.col("sector_id") == "99")
        .groupBy("period", "state_code", "state_description", "fuel_type_code", "fuel_type_description")
        .agg(F.sum("generation_mwh").alias("generated"))
    )
    fuels = dims.fuel_types(spark)
    intensity = latest_carbon(carbon, per_fuel=carbon_join == "preaggregated")
    by_code = fuels.join(intensity, "carbon_fuel_type", "left")
    # at most one row per fuel code, and the code list is fixed
    joined = monthly.join(F.broadcast(by_code), "fuel_type_code", "left")
    total = (F.col("generated") * F.coalesce("matches", F.lit(1))).cast(ENERGY)
    joined = joined.withColumn("total_generation_mwh", total)
    rows = _with_period_parts(joined).select(
        "period",
        "period_year",
        "period_month",
        "period_date",
        "state_code",
        "state_description",
        "fuel_type_code",
        "fuel_type_description",
        "total_generation_mwh",
        rounded("direct_mean", 8).alias("avg_direct_co2_per_mwh"),
        rounded("lifecycle_mean", 8).alias("avg_lifecycle_co2_per_mwh"),
        _tonnes(co2_divisor).alias("estimated_co2_tonnes"),
    )
    return rows.withColumns(
        {
            "pct_of_state_generation": pct_of_total("total_generation_mwh", ["period", "state_code"]),
            "fuel_category": fuel_category(F.col("fuel_type_code")),
        }
    )


def _tonnes(divisor: int) -> Column:
    """MWh times the mean of the matched intensities (a NULL one counts as 0), exactly."""
    grams = F.col("total_generation_mwh") * F.coalesce("direct_sum", F.lit(0).cast("decimal(12,4)"))
    parts = (F.coalesce("readings", F.lit(1)) * divisor).cast("decimal(13,0)")
    return rounded(grams / parts, 2).cast(TONNES)


RETAIL_COLUMNS = (
    "period",
    "period_year",
    "period_month",
    "period_date",
    "state_code",
    "state_description",
    "sector_id",
    "sector_name",
    "price_usd_per_mwh",
    "price_cents_per_kwh",
    "revenue_million_dollars",
    "sales_million_kwh",
    "customers",
)


def retail_changes(prices: DataFrame, calendar: bool = False) -> DataFrame:
    """Retail prices with yearly and monthly change and rolling mean.

    ``prices`` holds one row per period, state and sector, so a window holds one sector's
    months. Changes count rows, as published; ``calendar=True`` compares with the same month
    a year and a month before instead, whatever rows are missing in between.
    """
    series = Window.partitionBy("state_code", "sector_id").orderBy("period_date")
    price = F.col("price_usd_per_mwh")
    rolling = F.avg(price).over(series.rowsBetween(-11, 0))
    if calendar:
        year_before, month_before = _months_before(series, 12), _months_before(series, 1)
    else:
        year_before, month_before = F.lag(price, 12).over(series), F.lag(price, 1).over(series)
    return prices.select(
        *RETAIL_COLUMNS,
        change_pct(price, year_before).alias("price_yoy_change_pct"),
        change_pct(price, month_before).alias("price_mom_change_pct"),
        rounded(rolling, 2).alias("rolling_12m_avg_price_usd_mwh"),
    )


def price_trends(prices: DataFrame, market: DataFrame, calendar: bool = False) -> DataFrame:
    """Retail prices with their changes, the wholesale prices of the region and the spread."""
    trends = retail_changes(prices, calendar)
    regions = F.broadcast(dims.price_regions(prices.sparkSession))
    wholesale = market.select(
        "region",
        F.col("reading_date").alias("period_date"),
        F.col("avg_spot_price_usd_mwh").alias("wholesale_spot_price_usd_mwh"),
        F.col("avg_peak_price_usd_mwh").alias("wholesale_peak_price_usd_mwh"),
    )
    spot = F.coalesce("wholesale_spot_price_usd_mwh", F.lit(0))
    return (
        trends.join(regions, "state_code", "left")
        .join(wholesale, ["region", "period_date"], "left")
        .select(
            *trends.columns,
            "region",
            "wholesale_spot_price_usd_mwh",
            "wholesale_peak_price_usd_mwh",
            rounded(F.col("price_usd_per_mwh") - spot, 2).alias("retail_wholesale_spread_usd_mwh"),
        )
    )


def _months_before(series, months: int) -> Column:
    """Price exactly ``months`` earlier in the same series: a range frame of one month value."""
    index = F.col("period_year") * 12 + F.col("period_month")
    frame = Window.partitionBy("state_code", "sector_id").orderBy(index).rangeBetween(-months, -months)
    return F.max("price_usd_per_mwh").over(frame)


def carbon_footprint(by_fuel: DataFrame) -> DataFrame:
    """Generation, CO2, clean shares and intensity per state and month."""
    energy = F.col("total_generation_mwh")

    def in_category(name: str) -> Column:
        inside = F.when(F.col("fuel_category") == name, energy).otherwise(F.lit(0).cast(ENERGY))
        return F.sum(inside).cast(ENERGY)

    def of_fuel(*codes: str) -> Column:
        return F.max(F.when(F.col("fuel_type_code").isin(*codes), energy))

    totals = by_fuel.groupBy("period", "state_code", "state_description").agg(
        F.sum(energy).cast(ENERGY).alias("total_generation_mwh"),
        F.sum("estimated_co2_tonnes").cast(TONNES).alias("total_co2_tonnes"),
        in_category("renewable").alias("renewable_generation_mwh"),
        in_category("low_carbon").alias("low_carbon_generation_mwh"),
        in_category("fossil").alias("fossil_generation_mwh"),
        of_fuel("NG").alias("natural_gas_mwh"),
        of_fuel("COL").alias("coal_mwh"),
        of_fuel("NUC").alias("nuclear_mwh"),
        of_fuel("WWW", "WND").alias("wind_mwh"),
        of_fuel("SUN", "SOL").alias("solar_mwh"),
        of_fuel("HYC").alias("hydro_mwh"),
    )
    clean = F.col("renewable_generation_mwh") + F.col("low_carbon_generation_mwh")
    per_mwh = ratio("total_co2_tonnes", energy)
    metrics = _with_period_parts(totals).withColumn("_co2_per_mwh", per_mwh)
    return metrics.select(
        "period",
        "period_year",
        "period_month",
        "period_date",
        "state_code",
        "state_description",
        "total_generation_mwh",
        "total_co2_tonnes",
        "renewable_generation_mwh",
        "low_carbon_generation_mwh",
        "fossil_generation_mwh",
        "natural_gas_mwh",
        "coal_mwh",
        "nuclear_mwh",
        "wind_mwh",
        "solar_mwh",
        "hydro_mwh",
        share_pct("renewable_generation_mwh", energy).alias("renewable_share_pct"),
        share_pct(clean, energy).alias("clean_energy_share_pct"),
        rounded(ratio(F.col("total_co2_tonnes") * 1000, energy), 2).alias("grid_carbon_intensity_gco2_kwh"),
        yoy_change_pct("_co2_per_mwh", ["state_code"], "period_date", 12, "state_description").alias(
            "carbon_intensity_yoy_change_pct"
        ),
    )


def executive_summary(
    footprint: DataFrame,
    trends: DataFrame,
    market: DataFrame,
    weather: DataFrame,
    dedupe_dims: bool = False,
) -> DataFrame:
    """The wide monthly mart. Of ``trends`` the retail side is enough. The published state list names Texas twice, and so does the
    result unless ``dedupe_dims``."""
    residential = trends.filter(F.col("sector_id") == "RES").select(
        "state_code",
        "period",
        F.col("price_usd_per_mwh").alias("residential_price_usd_mwh"),
        F.col("price_cents_per_kwh").alias("residential_price_cents_kwh"),
        F.col("price_yoy_change_pct").alias("residential_price_yoy_change_pct"),
        "rolling_12m_avg_price_usd_mwh",
    )
    regions = F.broadcast(dims.summary_regions(footprint.sparkSession, dedupe_dims))
    wholesale = market.select(
        F.col("region").alias("grid_region"),
        F.col("reading_date").alias("period_date"),
        F.col("avg_spot_price_usd_mwh").alias("wholesale_spot_price_usd_mwh"),
        F.col("avg_peak_price_usd_mwh").alias("wholesale_peak_price_usd_mwh"),
        "avg_demand_mw",
        "peak_demand_mw",
        "price_volatility_pct",
    )
    climate = weather.select(
        F.col("region").alias("grid_region"),
        F.col("reading_date").alias("period_date"),
        "avg_temperature_c",
        "avg_wind_speed_ms",
        "avg_solar_irradiance_wm2",
    )
    earned = ratio(
        F.col("renewable_generation_mwh") * F.coalesce("residential_price_usd_mwh", F.lit(0)),
        F.lit(1_000_000),
    )
    wide = (
        footprint.join(residential, ["state_code", "period"], "left")
        .join(regions, "state_code", "left")
        .withColumn("grid_region", F.coalesce("region", F.lit("OTHER")))
        .join(wholesale, ["grid_region", "period_date"], "left")
        .join(climate, ["grid_region", "period_date"], "left")
    )
    return wide.select(
        "period",
        "period_year",
        "period_month",
        "period_date",
        "state_code",
        "state_description",
        "grid_region",
        "total_generation_mwh",
        "renewable_generation_mwh",
        "low_carbon_generation_mwh",
        "fossil_generation_mwh",
        "renewable_share_pct",
        "clean_energy_share_pct",
        "natural_gas_mwh",
        "coal_mwh",
        "nuclear_mwh",
        "wind_mwh",
        "solar_mwh",
        "hydro_mwh",
        "total_co2_tonnes",
        "grid_carbon_intensity_gco2_kwh",
        "carbon_intensity_yoy_change_pct",
        "residential_price_usd_mwh",
        "residential_price_cents_kwh",
        "residential_price_yoy_change_pct",
        "rolling_12m_avg_price_usd_mwh",
        "wholesale_spot_price_usd_mwh",
        "wholesale_peak_price_usd_mwh",
        "avg_demand_mw",
        "peak_demand_mw",
        "price_volatility_pct",
        "avg_temperature_c",
        "avg_wind_speed_ms",
        "avg_solar_irradiance_wm2",
        rounded(earned, 4).alias("renewable_revenue_million_usd"),
    )


# The order each mart is published in. NULLs sort as in the published marts:
# last when ascending, first when descending unless said otherwise.
PUBLISHED_ORDER = {
    "gold_generation_by_fuel_monthly": ["period desc", "state_code asc", "total_generation_mwh desc"],
    "gold_price_trends": ["period desc", "state_code asc", "sector_id asc"],
    "gold_carbon_footprint": ["period desc", "total_co2_tonnes desc"],
    "gold_executive_summary": ["period desc", "total_generation_mwh desc nulls last"],
}
_DIRECTIONS = {
    "asc": F.asc_nulls_last,
    "desc": F.desc_nulls_first,
    "desc nulls last": F.desc_nulls_last,
}


def in_published_order(mart: DataFrame, name: str) -> DataFrame:
    """Sort a mart for reading (a range shuffle: leave it out where order does not matter)."""
    keys = []
    for entry in PUBLISHED_ORDER[name]:
        column, _, direction = entry.partition(" ")
        keys.append(_DIRECTIONS[direction](column))
    return mart.orderBy(*keys)
