"""Literal dimensions: small fixed relations, at most a few dozen rows each."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions.classify import carbon_category

# Grid regions.
REGIONS = ["ERCOT", "CAISO", "PJM", "MISO", "NYISO", "NEISO", "SPP", "WECC", "SERC"]
DEFAULT_REGION = "ERCOT"

# States whose data are ingested.
STATES = [
    "AL", "AZ", "AR", "CA", "CO", "CT", "DE", "DC", "FL", "GA", "ID", "IL", "IN", "IA", "KS",
    "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM",
    "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA",
    "WA", "WV", "WI", "WY",
]

# Generation fuel code to carbon fuel type.
FUEL_TYPES = [
    ("NG", "natural_gas"),
    ("COL", "coal"),
    ("NUC", "nuclear"),
    ("HYC", "hydro"),
    ("WWW", "wind"),
    ("SUN", "solar_pv"),
    ("PET", "petroleum"),
    ("GEO", "geothermal"),
    ("OTH", "other"),
    ("BIO", "biomass"),
    ("WND", "wind"),
    ("SOL", "solar_pv"),
]

# Grid region of each state, as the price trends know them.
PRICE_REGIONS = [
    ("TX", "ERCOT"), ("CA", "CAISO"), ("NY", "NYISO"), ("PA", "PJM"), ("OH", "PJM"),
    ("IL", "MISO"), ("MI", "MISO"), ("MN", "MISO"), ("FL", "SERC"), ("GA", "SERC"),
    ("NC", "SERC"), ("VA", "PJM"), ("MA", "NEISO"), ("CT", "NEISO"), ("RI", "NEISO"),
    ("ME", "NEISO"), ("NH", "NEISO"), ("VT", "NEISO"), ("KS", "SPP"), ("OK", "SPP"),
    ("NE", "SPP"), ("CO", "WECC"), ("AZ", "WECC"), ("NM", "WECC"), ("WA", "WECC"),
    ("OR", "WECC"), ("NV", "WECC"), ("ID", "WECC"), ("MT", "WECC"), ("WY", "WECC"),
    ("UT", "WECC"),
]

# The shorter list of the executive summary. TX stands in it twice, which
# doubles the Texas rows of that mart; ``summary_regions(dedupe=True)`` avoids it.
SUMMARY_REGIONS = [
    ("TX", "ERCOT"), ("CA", "CAISO"), ("NY", "NYISO"), ("PA", "PJM"), ("OH", "PJM"),
    ("IL", "MISO"), ("MI", "MISO"), ("MN", "MISO"), ("FL", "SERC"), ("GA", "SERC"),
    ("NC", "SERC"), ("VA", "PJM"), ("MA", "NEISO"), ("CT", "NEISO"), ("TX", "ERCOT"),
]

# Base price (USD/MWh) of each region.
BASE_PRICES = [
    ("ERCOT", 45),
    ("CAISO", 55),
    ("PJM", 40),
    ("MISO", 32),
    ("NYISO", 50),
    ("NEISO", 48),
    ("SPP", 30),
    ("WECC", 42),
    ("SERC", 38),
]

# Fuel type, direct and life-cycle emissions (gCO2eq/kWh), description.
EMISSION_FACTORS = [
    ("coal", 820.0, 820.0, "Conventional coal combustion — highest carbon intensity fuel"),
    ("natural_gas", 490.0, 490.0, "Combined-cycle natural gas — approximately 40% cleaner than coal"),
    ("petroleum", 650.0, 650.0, "Oil-based generation — high carbon intensity, typically peakers"),
    ("nuclear", 0.0, 12.0, "Zero direct emissions; lifecycle includes construction and fuel processing"),
    ("hydro", 0.0, 4.0, "Near-zero direct emissions; lifecycle includes reservoir methane"),
    ("wind", 0.0, 7.0, "Zero direct emissions; very low lifecycle (manufacturing and install)"),
    ("solar_pv", 0.0, 20.0, "Zero direct emissions; lifecycle includes panel manufacturing"),
    ("biomass", 230.0, 230.0, "Carbon-neutral in theory; direct combustion emissions are significant"),
    ("geothermal", 38.0, 38.0, "Low but non-zero direct emissions from geothermal fluid"),
    ("other", 400.0, 400.0, "Mixed/unclassified generation sources"),
]
KNOWN_FUELS = [row[0] for row in EMISSION_FACTORS]
DEFAULT_FUEL = "other"

# Fuels for which carbon readings are requested.
REQUESTED_FUELS = ["coal", "natural_gas", "nuclear", "wind", "solar_pv", "hydro", "petroleum"]


def _quoted(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "\\'") + "'"
    return f"cast({value} as double)" if isinstance(value, float) else str(value)


def literal_relation(spark: SparkSession, rows, names: list[str]) -> DataFrame:
    """An inline VALUES relation: a local relation whose exact size the planner knows."""
    body = ", ".join("(" + ", ".join(_quoted(v) for v in row) + ")" for row in rows)
    return spark.sql(f"select * from values {body} as t({', '.join(names)})")


def fuel_types(spark: SparkSession) -> DataFrame:
    return literal_relation(spark, FUEL_TYPES, ["fuel_type_code", "carbon_fuel_type"])


def price_regions(spark: SparkSession) -> DataFrame:
    return literal_relation(spark, PRICE_REGIONS, ["state_code", "region"])


def summary_regions(spark: SparkSession, dedupe: bool = False) -> DataFrame:
    rows = dict.fromkeys(SUMMARY_REGIONS) if dedupe else SUMMARY_REGIONS
    return literal_relation(spark, rows, ["state_code", "region"])


def base_prices(spark: SparkSession) -> DataFrame:
    return literal_relation(spark, BASE_PRICES, ["region", "base_price_usd_mwh"])


def emission_factors(spark: SparkSession) -> DataFrame:
    """Reference factors of every fuel with their class."""
    names = ["fuel_type", "direct_co2_gco2_per_kwh", "lifecycle_co2_gco2_per_kwh", "description"]
    table = literal_relation(spark, EMISSION_FACTORS, names)
    return table.withColumn("category", carbon_category(F.col("lifecycle_co2_gco2_per_kwh")))


def request_grid(
    spark: SparkSession,
    regions: list[str] | None = None,
    fuels: list[str] | None = None,
) -> DataFrame:
    """Every requested region and fuel pair: the region list unfolded by the fuel list."""
    fuel_list = F.array(*[F.lit(fuel) for fuel in fuels or REQUESTED_FUELS])
    region_rows = literal_relation(spark, [(r,) for r in regions or REGIONS], ["region"])
    return region_rows.select("region", F.explode(fuel_list).alias("fuel_type"))
