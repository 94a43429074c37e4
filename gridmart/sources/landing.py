"""Landed JSON files: page envelopes, readings and nested forecasts to raw-table rows.

Field values are taken as text first and cast with ``try_cast``: a value that does not parse
marks its row as rejected instead of failing the job.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart import schemas

# A page holds a list of loose records. They are read as maps because the same field comes in
# several spellings that differ only in case.
PAGE_SCHEMA = "response struct<total: string, data: array<map<string, string>>>"

READING_SCHEMAS = {
    schemas.WEATHER: """
        region string, temperature_c string, wind_speed_ms string, solar_irradiance_wm2 string,
        humidity_pct string, cloud_cover_pct string, weather_condition string, recorded_at string""",
    schemas.CARBON: """
        region string, fuel_type string, direct_co2_per_mwh string, lifecycle_co2_per_mwh string,
        carbon_intensity_category string, recorded_at string""",
    schemas.MARKET: """
        region string, spot_price_usd_mwh string, peak_price_usd_mwh string,
        off_peak_price_usd_mwh string, demand_mw string, demand_forecast_mw string,
        price_signal string, recorded_at string""",
}

DEMAND_POINT = """
    forecast_hour: string, forecast_demand_mw: string, temperature_c: string,
    confidence_pct: string"""
DEMAND_FORECAST_SCHEMA = f"""
    region string, generated_at string, forecast_hours string,
    forecast array<struct<{DEMAND_POINT}>>"""
WEATHER_POINT = """
    forecast_hour: string, temperature_c: string, wind_speed_ms: string,
    solar_irradiance_wm2: string, humidity_pct: string, cloud_cover_pct: string,
    weather_condition: string, precipitation_mm: string"""
WEATHER_FORECAST_SCHEMA = f"""
    region string, generated_at string, forecast_hours string,
    forecast array<struct<{WEATHER_POINT}>>"""

# Bounds of the readings (inclusive; None = open).
READING_BOUNDS = {
    schemas.WEATHER: {
        "wind_speed_ms": (0, None),
        "solar_irradiance_wm2": (0, None),
        "humidity_pct": (0, 100),
        "cloud_cover_pct": (0, 100),
    },
    schemas.CARBON: {
        "direct_co2_per_mwh": (0, None),
        "lifecycle_co2_per_mwh": (0, None),
    },
    schemas.MARKET: {
        "demand_mw": (0, None),
        "demand_forecast_mw": (0, None),
    },
    schemas.FORECAST: {
        "forecast_demand_mw": (0, None),
        "confidence_pct": (0, 100),
    },
}


# ---- scans -------------------------------------------------------------------------------


#: In which order records arrived.
ARRIVAL = ["landed_at", "name_length", "file_name", "seq", "pos"]


def read_pages(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Page envelopes to one row per record, with its place in the landing.

    One document per line keeps the files splittable; ``multi_line`` is for pretty-printed
    pages. Files follow each other by the time of their last change; of one time by their whole
    path, shorter ones first, so that page 2 comes before page 10. ``seq`` rises with the line
    inside a file.
    """
    pages = spark.read.schema(PAGE_SCHEMA).option("multiLine", multi_line).json(path)
    numbered = pages.select(
        F.col("_metadata.file_modification_time").alias("landed_at"),
        F.length("_metadata.file_path").alias("name_length"),
        F.col("_metadata.file_path").alias("file_name"),
        F.monotonically_increasing_id().alias("seq"),
        "response",
    )
    return numbered.select(*ARRIVAL[:-1], F.posexplode("response.data").alias("pos", "record"))


def read_readings(spark: SparkSession, table: str, path: str | list[str], multi_line: bool = False) -> DataFrame:
    return spark.read.schema(READING_SCHEMAS[table]).option("multiLine", multi_line).json(path)


def read_forecasts(
    spark: SparkSession, path: str | list[str], schema: str = DEMAND_FORECAST_SCHEMA, multi_line: bool = False
) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


# ---- field helpers -----------------------------------------------------------------------


def _first_filled(record: Column, *names: str, last_resort: Column | None = None) -> Column:
    """First non-empty spelling of a field; an empty string falls through like a missing one."""
    *early, last = names
    options = [F.nullif(record[name], F.lit("")) for name in early]
    if last_resort is None:
        return F.coalesce(*options, record[last])
    return F.coalesce(*options, F.nullif(record[last], F.lit("")), last_resort)


def _number(text: Column, kind: str) -> Column:
    return text.try_cast(kind)


def _whole(text: Column) -> Column:
    """Integer part of a number, cut towards zero."""
    return text.try_cast("decimal(38,18)").try_cast("bigint")


def _reasons(checks: dict[str, Column]) -> Column:
    """Names of the failed checks, NULL when all passed."""
    failed = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks.items()]))
    return F.when(F.size(failed) > 0, F.array_join(failed, "; "))


def _taken(rows: DataFrame, fields: dict[str, Column], kept: list[str]) -> DataFrame:
    """The ``kept`` columns with ``fields`` beside them, each computed once per row.

    The fields come out of a generator, which the optimizer does not dissolve: otherwise every
    check, filter and output column would repeat the look-ups and casts it is made of.
    """
    row = F.struct(*[value.alias(name) for name, value in fields.items()])
    return rows.select(*kept, F.explode(F.array(row)).alias("_row")).select(*kept, "_row.*")


def _unparsed(text: Column, value: Column) -> Column:
    return text.isNotNull() & value.isNull()


def _too_long(columns: list[str]) -> dict[str, Column]:
    return {
        f"{name} too long": F.coalesce(F.length(name) > schemas.TEXT_LIMITS[name], F.lit(False))
        for name in columns
        if name in schemas.TEXT_LIMITS
    }


def bad_period(period: Column) -> Column:
    return period.isNull() | ~period.rlike(r"^\d{4}-\d{2}$")


# ---- records to rows ---------------------------------------------------------------------


def normalise_generation(records: DataFrame, request_id: str | None = None) -> DataFrame:
    """Generation records to raw columns plus ``reject_reason`` (NULL = accepted)."""
    record = F.col("record")
    fields = {
        "period": record["period"],
        "state_code": _first_filled(record, "location", "stateid", last_resort=F.lit("")),
        "state_description": _first_filled(record, "stateDescription", "locationDescription"),
        "sector_id": _first_filled(record, "sectorid", "sectorId", last_resort=F.lit("")),
        "sector_description": record["sectorDescription"],
        "fuel_type_code": _first_filled(record, "fueltypeid", "fuelTypeId", last_resort=F.lit("")),
        "fuel_type_description": record["fuelTypeDescription"],
        "generation_mwh": _number(record["generation"], "decimal(18,4)"),
        "generation_units": record["generation-units"],
    }
    texts = {"generation": ("generation_mwh", record["generation"])}
    return _checked_records(records, fields, texts, request_id)


def normalise_prices(records: DataFrame, request_id: str | None = None) -> DataFrame:
    """Price records to raw columns plus ``reject_reason`` (NULL = accepted)."""
    record = F.col("record")
    fields = {
        "period": record["period"],
        "state_code": _first_filled(record, "stateid", "stateId", last_resort=F.lit("")),
        "state_description": record["stateDescription"],
        "sector_id": _first_filled(record, "sectorid", "sectorId", last_resort=F.lit("")),
        "sector_name": record["sectorName"],
        "price_cents_per_kwh": _number(record["price"], "decimal(10,4)"),
        "revenue_million_dollars": _number(record["revenue"], "decimal(18,4)"),
        "sales_million_kwh": _number(record["sales"], "decimal(18,4)"),
        "customers": _whole(record["customers"]),
    }
    texts = {
        "price": ("price_cents_per_kwh", record["price"]),
        "revenue": ("revenue_million_dollars", record["revenue"]),
        "sales": ("sales_million_kwh", record["sales"]),
        "customers": ("customers", record["customers"]),
    }
    return _checked_records(records, fields, texts, request_id)


def _checked_records(
    records: DataFrame,
    fields: dict[str, Column],
    texts: dict[str, tuple[str, Column]],
    request_id: str | None,
) -> DataFrame:
    """Add the fields and the verdict; ``texts`` names the number each text was parsed to."""
    given = {f"_text_{name}": text for name, (_, text) in texts.items()}
    rows = _taken(records, {**fields, **given}, records.columns)
    checks = {
        "bad period": bad_period(F.col("period")),
        **{f"bad {name}": _unparsed(F.col(f"_text_{name}"), F.col(number)) for name, (number, _) in texts.items()},
        **_too_long(list(fields)),
    }
    return rows.select(
        *records.columns,
        *fields,
        F.lit("eia_api").alias("source"),
        F.lit(request_id).cast("string").alias("api_request_id"),
        _reasons(checks).alias("reject_reason"),
    )


def normalise_readings(readings: DataFrame, table: str) -> DataFrame:
    """Weather, carbon or market readings to raw columns plus ``reject_reason``."""
    return _typed(readings, table, source="enrichment_api")


def flatten_forecast(forecasts: DataFrame) -> DataFrame:
    """One row per forecast point under its parent's region and issue time.

    A document without points gives no rows; a point without an optional field reads NULL.
    """
    points = forecasts.select("region", "generated_at", F.explode("forecast").alias("point"))
    return points.select("region", "generated_at", "point.*")


def normalise_demand_forecast(forecasts: DataFrame) -> DataFrame:
    points = flatten_forecast(forecasts).withColumnRenamed("generated_at", "recorded_at")
    return _typed(points, schemas.FORECAST, source="enrichment_api")


def _typed(rows: DataFrame, table: str, source: str) -> DataFrame:
    """Cast text columns to the raw types, noting what did not parse or broke a bound."""
    fields = [f for f in schemas.raw_schema(table) if f.name in rows.columns]
    names = [f.name for f in fields]
    kept = [name for name in rows.columns if name not in names]
    values = {f.name: F.col(f.name).try_cast(f.dataType) for f in fields}
    given = {f"_text_{name}": F.col(name) for name in names}
    taken = _taken(rows, {**values, **given}, kept)
    checks = {}
    for field in fields:
        if field.dataType.typeName() != "string":
            checks[f"bad {field.name}"] = _unparsed(F.col(f"_text_{field.name}"), F.col(field.name))
        if field.name in schemas.REQUIRED[table]:
            checks[f"no {field.name}"] = F.col(f"_text_{field.name}").isNull()
    for name, (low, high) in READING_BOUNDS[table].items():
        checks[f"{name} out of bounds"] = F.coalesce(outside(F.col(name), low, high), F.lit(False))
    return taken.select(*kept, *names, F.lit(source).alias("source"), _reasons(checks).alias("reject_reason"))


def outside(value: Column, low, high) -> Column:
    """True outside the inclusive bounds; NULL for a NULL value."""
    sides = []
    if low is not None:
        sides.append(value < low)
    if high is not None:
        sides.append(value > high)
    return reduce(lambda a, b: a | b, sides)


def out_of_bounds(readings: DataFrame, table: str) -> DataFrame:
    """Readings that break a bound, with the names of the broken columns."""
    checks = {
        name: F.coalesce(outside(F.col(name), low, high), F.lit(False))
        for name, (low, high) in READING_BOUNDS[table].items()
    }
    marked = readings.withColumn("broken", _reasons(checks))
    return marked.filter(F.col("broken").isNotNull())


# ---- accepted and rejected ---------------------------------------------------------------


def accepted(normalised: DataFrame) -> DataFrame:
    return normalised.filter(F.col("reject_reason").isNull()).drop("reject_reason", "record")


def rejected(normalised: DataFrame) -> DataFrame:
    return normalised.filter(F.col("reject_reason").isNotNull())


def strict(normalised: DataFrame) -> DataFrame:
    """Fail the batch at the first row that breaks a rule, instead of setting it aside."""
    verdict = F.when(
        F.col("reject_reason").isNotNull(),
        F.raise_error(F.concat(F.lit("rejected row: "), F.col("reject_reason"))).cast("boolean"),
    ).otherwise(F.lit(True))
    return normalised.filter(verdict).drop("reject_reason", "record")


def stamped(rows: DataFrame, ingested_at=None) -> DataFrame:
    """Add the load time: the given one or the start of the query."""
    stamp = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    return rows.withColumn("ingested_at", stamp)
