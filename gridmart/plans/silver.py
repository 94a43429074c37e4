"""Silver models: cleaned facts and daily aggregates, each a frame-to-frame function."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.functions import code, mean, period_date, period_month, period_year, ratio, rounded
from gridmart.schemas import ENERGY


def _filled(column: str) -> Column:
    return F.col(column).isNotNull() & (F.trim(column) != "")


def clean_generation(bronze: DataFrame) -> DataFrame:
    """Generation in MWh under tidy codes; rows without a value or a state are left out."""
    usable = F.col("generation_mwh").isNotNull() & _filled("state_code")
    period = F.col("period")
    return bronze.filter(usable).select(
        "id",
        "ingested_at",
        "period",
        period_year(period).alias("period_year"),
        period_month(period).alias("period_month"),
        period_date(period).alias("period_date"),
        code(F.col("state_code")).alias("state_code"),
        F.trim("state_description").alias("state_description"),
        code(F.col("sector_id")).alias("sector_id"),
        F.trim("sector_description").alias("sector_description"),
        code(F.col("fuel_type_code")).alias("fuel_type_code"),
        F.trim("fuel_type_description").alias("fuel_type_description"),
        # thousand MWh to MWh
        (F.col("generation_mwh") * 1000).cast(ENERGY).alias("generation_mwh"),
        F.lit("MWh").alias("generation_units_normalised"),
        "source",
    )


def clean_prices(bronze: DataFrame) -> DataFrame:
    """Positive retail prices in USD/MWh under tidy codes; missing amounts read 0."""
    cents = F.col("price_cents_per_kwh")
    period = F.col("period")
    amounts = ["revenue_million_dollars", "sales_million_kwh", "customers"]
    return bronze.filter((cents > 0) & _filled("state_code")).select(
        "id",
        "ingested_at",
        "period",
        period_year(period).alias("period_year"),
        period_month(period).alias("period_month"),
        period_date(period).alias("period_date"),
        code(F.col("state_code")).alias("state_code"),
        F.trim("state_description").alias("state_description"),
        code(F.col("sector_id")).alias("sector_id"),
        F.trim("sector_name").alias("sector_name"),
        # one cent per kWh is ten dollars per MWh
        (cents * 10).cast("decimal(14,4)").alias("price_usd_per_mwh"),
        cents.alias("price_cents_per_kwh"),
        *[F.coalesce(F.col(name), F.lit(0).cast(kind)).alias(name) for name, kind in _kinds(bronze, amounts)],
        "source",
    )


def _kinds(df: DataFrame, names: list[str]) -> list[tuple[str, str]]:
    return [(name, df.schema[name].dataType.simpleString()) for name in names]


def _by_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("reading_date", F.to_date("recorded_at"))


def daily_weather(bronze: DataFrame) -> DataFrame:
    """Weather per region and day."""
    readings = bronze.filter(F.col("temperature_c").isNotNull() & F.col("region").isNotNull())
    return (
        _by_day(readings)
        .groupBy("region", "reading_date")
        .agg(
            rounded(mean("temperature_c"), 2).alias("avg_temperature_c"),
            rounded(F.min("temperature_c"), 2).alias("min_temperature_c"),
            rounded(F.max("temperature_c"), 2).alias("max_temperature_c"),
            rounded(mean("wind_speed_ms"), 2).alias("avg_wind_speed_ms"),
            rounded(F.max("wind_speed_ms"), 2).alias("max_wind_speed_ms"),
            rounded(mean("solar_irradiance_wm2"), 2).alias("avg_solar_irradiance_wm2"),
            rounded(F.max("solar_irradiance_wm2"), 2).alias("peak_solar_irradiance_wm2"),
            rounded(mean("humidity_pct"), 2).alias("avg_humidity_pct"),
            rounded(mean("cloud_cover_pct"), 2).alias("avg_cloud_cover_pct"),
            F.count(F.lit(1)).alias("reading_count"),
            F.max("ingested_at").alias("ingested_at"),
        )
    )


def market_measures() -> list[Column]:
    """Aggregates of the daily market model, shared by the batch and the streaming path."""
    spot = F.col("spot_price_usd_mwh")
    average = mean(spot)
    # stddev of a single reading is NULL and stays NULL
    volatility = F.when(average > 0, rounded(ratio(F.stddev_samp(spot), average) * 100, 2)).otherwise(
        F.lit(0).cast("decimal(28,2)")
    )
    return [
        rounded(average, 4).alias("avg_spot_price_usd_mwh"),
        rounded(F.min(spot), 4).alias("min_spot_price_usd_mwh"),
        rounded(F.max(spot), 4).alias("max_spot_price_usd_mwh"),
        rounded(mean("peak_price_usd_mwh"), 4).alias("avg_peak_price_usd_mwh"),
        rounded(mean("off_peak_price_usd_mwh"), 4).alias("avg_off_peak_price_usd_mwh"),
        rounded(mean("demand_mw"), 2).alias("avg_demand_mw"),
        rounded(F.max("demand_mw"), 2).alias("peak_demand_mw"),
        rounded(mean("demand_forecast_mw"), 2).alias("avg_demand_forecast_mw"),
        volatility.alias("price_volatility_pct"),
        F.count(F.lit(1)).alias("reading_count"),
        F.max("ingested_at").alias("ingested_at"),
    ]


def market_readings(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("spot_price_usd_mwh").isNotNull() & F.col("region").isNotNull())


def daily_market(bronze: DataFrame) -> DataFrame:
    """Wholesale prices, volatility and demand per region and day."""
    return _by_day(market_readings(bronze)).groupBy("region", "reading_date").agg(*market_measures())


def daily_carbon(bronze: DataFrame) -> DataFrame:
    """Carbon intensity per region, fuel type and day, with the day's latest category.

    A latest-value aggregate cannot be hashed and would sort every reading. The category is
    therefore made a grouping key of the first, hashed pass; the latest one is picked among
    the few categories of a day. Categories last seen at the same instant are told apart by
    the newest row id each has that day. A NULL category counts like any other.
    """
    readings = bronze.filter(F.col("fuel_type").isNotNull() & F.col("region").isNotNull())
    day = ["region", "fuel_type", "reading_date"]
    per_category = (
        _by_day(readings.withColumn("fuel_type", F.lower(F.trim("fuel_type"))))
        .groupBy(*day, "carbon_intensity_category")
        .agg(
            F.sum("direct_co2_per_mwh").alias("direct"),
            F.count("direct_co2_per_mwh").alias("direct_n"),
            F.sum("lifecycle_co2_per_mwh").alias("lifecycle"),
            F.count("lifecycle_co2_per_mwh").alias("lifecycle_n"),
            F.count(F.lit(1)).alias("n"),
            F.max("recorded_at").alias("last_reading"),
            F.max("id").alias("last_id"),
            F.max("ingested_at").alias("ingested_at"),
        )
    )
    return per_category.groupBy(*day).agg(
        rounded(_mean("direct"), 4).alias("avg_direct_co2_per_mwh"),
        rounded(_mean("lifecycle"), 4).alias("avg_lifecycle_co2_per_mwh"),
        F.max_by("carbon_intensity_category", F.struct("last_reading", "last_id")).alias(
            "carbon_intensity_category"
        ),
        F.sum("n").alias("reading_count"),
        F.max("ingested_at").alias("ingested_at"),
    )


def _mean(name: str) -> Column:
    """Mean of a column from its partial sums and counts."""
    return ratio(F.sum(name), F.sum(f"{name}_n"))


@dataclass(frozen=True)
class SilverModel:
    name: str
    source: str
    build: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    order: tuple[str, ...]
    partition_by: str | None = None
    time_column: str | None = None  # set for aggregates: when a reading was taken


# Unique keys of the silver tables.
MODELS = {
    model.name: model
    for model in [
        SilverModel(
            "silver_generation_cleaned",
            "bronze_eia_generation",
            clean_generation,
            ("period", "state_code", "sector_id", "fuel_type_code"),
            ("ingested_at", "id"),
            partition_by="period",
        ),
        SilverModel(
            "silver_prices_cleaned",
            "bronze_eia_prices",
            clean_prices,
            ("period", "state_code", "sector_id"),
            ("ingested_at", "id"),
            partition_by="period",
        ),
        SilverModel(
            "silver_weather_aggregated",
            "bronze_weather",
            daily_weather,
            ("region", "reading_date"),
            ("ingested_at",),
            time_column="recorded_at",
        ),
        SilverModel(
            "silver_market_aggregated",
            "bronze_market_prices",
            daily_market,
            ("region", "reading_date"),
            ("ingested_at",),
            time_column="recorded_at",
        ),
        SilverModel(
            "silver_carbon_reference",
            "bronze_carbon_intensity",
            daily_carbon,
            ("region", "fuel_type", "reading_date"),
            ("ingested_at",),
            time_column="recorded_at",
        ),
    ]
}
