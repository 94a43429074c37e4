"""Fixed schemas, keys and limits of the raw tables, and the contract check on them."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Exact numeric types of the derived tables. Sums stay in decimals so that a result never
# depends on the order in which Spark happens to add the rows.
ENERGY = "decimal(22,4)"
TONNES = "decimal(22,2)"

GENERATION = "eia_electricity_generation"
PRICES = "eia_electricity_prices"
WEATHER = "enrichment_weather"
CARBON = "enrichment_carbon_intensity"
MARKET = "enrichment_market_prices"
FORECAST = "enrichment_demand_forecast"
AUDIT = "ingestion_audit_log"

# Column names and types every raw table is stored with.
RAW_TABLES = {
    GENERATION: """
        id bigint, ingested_at timestamp, period string, state_code string,
        state_description string, sector_id string, sector_description string,
        fuel_type_code string, fuel_type_description string,
        generation_mwh decimal(18,4), generation_units string, source string,
        api_request_id string""",
    PRICES: """
        id bigint, ingested_at timestamp, period string, state_code string,
        state_description string, sector_id string, sector_name string,
        price_cents_per_kwh decimal(10,4), revenue_million_dollars decimal(18,4),
        sales_million_kwh decimal(18,4), customers bigint, source string,
        api_request_id string""",
    WEATHER: """
        id bigint, ingested_at timestamp, region string, temperature_c decimal(6,2),
        wind_speed_ms decimal(6,2), solar_irradiance_wm2 decimal(8,2),
        humidity_pct decimal(5,2), cloud_cover_pct decimal(5,2),
        weather_condition string, recorded_at timestamp, source string""",
    CARBON: """
        id bigint, ingested_at timestamp, region string, fuel_type string,
        direct_co2_per_mwh decimal(10,4), lifecycle_co2_per_mwh decimal(10,4),
        carbon_intensity_category string, recorded_at timestamp, source string""",
    MARKET: """
        id bigint, ingested_at timestamp, region string,
        spot_price_usd_mwh decimal(10,4), peak_price_usd_mwh decimal(10,4),
        off_peak_price_usd_mwh decimal(10,4), demand_mw decimal(12,2),
        demand_forecast_mw decimal(12,2), price_signal string,
        recorded_at timestamp, source string""",
    FORECAST: """
        id bigint, ingested_at timestamp, region string, forecast_hour timestamp,
        forecast_demand_mw decimal(12,2), temperature_c decimal(6,2),
        confidence_pct decimal(5,2), recorded_at timestamp, source string""",
    AUDIT: """
        id bigint, run_id string, asset_name string, source string,
        records_written int, started_at timestamp, completed_at timestamp,
        status string, error_message string""",
}

# The keys on which a row may be loaded only once.
LOAD_KEYS = {
    GENERATION: ["period", "state_code", "sector_id", "fuel_type_code"],
    PRICES: ["period", "state_code", "sector_id"],
}

# Longest text each column accepts. Longer text is quarantined.
TEXT_LIMITS = {
    "period": 10,
    "state_code": 5,
    "state_description": 100,
    "sector_id": 10,
    "sector_description": 100,
    "sector_name": 100,
    "fuel_type_code": 10,
    "fuel_type_description": 100,
    "generation_units": 50,
    "api_request_id": 100,
}

# Columns that must be filled.
REQUIRED = {
    GENERATION: ["ingested_at", "period", "state_code", "sector_id", "fuel_type_code", "source"],
    PRICES: ["ingested_at", "period", "state_code", "sector_id", "source"],
    WEATHER: ["ingested_at", "region", "recorded_at", "source"],
    CARBON: ["ingested_at", "region", "fuel_type", "recorded_at", "source"],
    MARKET: ["ingested_at", "region", "recorded_at", "source"],
    FORECAST: ["ingested_at", "region", "forecast_hour", "forecast_demand_mw", "recorded_at", "source"],
    AUDIT: ["run_id", "asset_name", "source", "records_written", "started_at", "status"],
}

AUDIT_STATES = ["running", "success", "failed"]


def raw_schema(table: str) -> T.StructType:
    """The StructType of a raw table (needs a running session to parse the DDL)."""
    return T.StructType.fromDDL(RAW_TABLES[table])


def contract_violations(df: DataFrame, table: str, without: Sequence[str] = ()) -> list[str]:
    """Columns of ``table`` (but those in ``without``) that ``df`` lacks or holds with another type."""
    held = {field.name: field.dataType for field in df.schema}
    problems = []
    for field in raw_schema(table):
        if field.name in without:
            continue
        if field.name not in held:
            problems.append(f"{table}.{field.name}: missing")
        elif held[field.name] != field.dataType:
            problems.append(
                f"{table}.{field.name}: {held[field.name].simpleString()} "
                f"instead of {field.dataType.simpleString()}"
            )
    return problems


def check_contract(df: DataFrame, table: str, without: Sequence[str] = ()) -> DataFrame:
    """``df``; fails if it breaks the contract of ``table``. Every load checks its rows."""
    problems = contract_violations(df, table, without)
    if problems:
        raise ValueError("; ".join(problems))
    return df
