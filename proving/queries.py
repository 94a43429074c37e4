"""Every operator as a query over the given tables."""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart import schemas, session
from gridmart.functions import (
    carbon_category,
    code,
    known_or,
    mean,
    pct_of_total,
    price_signal,
    rounded,
    safe_divide,
    trailing_period,
    yoy_change_pct,
)
from gridmart.operators import merge, quality
from gridmart.operators.audit import current_state
from gridmart.operators.horizon import hourly_spine
from gridmart.operators.loads import append_load
from gridmart.operators.snapshots import newest_rows, newest_rows_per_key
from gridmart.plans import gold, partials, reports, silver
from gridmart.plans.daily import Lake
from gridmart.sources import dims, landing, versions
from gridmart.sources.raw import BRONZE_VIEWS, bronze, column_names, facets, page, page_after, read_raw
from gridmart.sources.sinks import publish_view, read_table, refresh_table, write_report
from gridmart.streaming import readings as streams
from proving import adapters

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the queries, shared with their SQL counterparts.
AS_OF_YEAR = 2000
MIX_SINCE = 1996
TABLES_SINCE = 1997
SPLIT_DAY = 15  # rows loaded up to this day of a month are stored, later ones are new
SPLIT_TIME = "2024-01-20 00:00:00"  # the same for the readings
LOOKBACK_DAYS = 7
FACET_RANGE = ("1996-03", "1998-10")
FACET_STATES = ["TX", "CA", "NY"]
PAGE_NUMBER, PAGE_SIZE = 2, 5000
HORIZON_HOURS = 24

_QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    _QUERIES[build.__name__] = build
    return build


def queries() -> dict[str, Query]:
    return {name: _exporting(build) for name, build in _QUERIES.items()}


def _exporting(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return exported(build(spark, folder))

    run.__name__ = build.__name__
    return run


def exported(df: DataFrame) -> DataFrame:
    """Decimals as doubles and instants as plain timestamps, as the checks compare them."""
    shown = []
    for field in df.schema:
        kind = field.dataType.typeName()
        column = F.col(f"`{field.name}`")
        if kind == "decimal":
            column = column.cast("double")
        elif kind == "timestamp":
            column = column.cast("timestamp_ntz")
        shown.append(column.alias(field.name))
    return df.select(*shown)


# ---- shared inputs -----------------------------------------------------------------------


def _bronze(spark: SparkSession, folder: str, view: str) -> DataFrame:
    return bronze(adapters.raw(spark, folder, BRONZE_VIEWS[view]), view)


def _silver(spark: SparkSession, folder: str, name: str) -> DataFrame:
    model = silver.MODELS[name]
    return model.build(_bronze(spark, folder, model.source))


def _by_fuel(spark: SparkSession, folder: str, **options) -> DataFrame:
    return gold.generation_by_fuel(
        _silver(spark, folder, "silver_generation_cleaned"),
        _silver(spark, folder, "silver_carbon_reference"),
        **options,
    )


def _trends(spark: SparkSession, folder: str, **options) -> DataFrame:
    return gold.price_trends(
        _silver(spark, folder, "silver_prices_cleaned"),
        _silver(spark, folder, "silver_market_aggregated"),
        **options,
    )


def _footprint(spark: SparkSession, folder: str) -> DataFrame:
    return gold.carbon_footprint(_by_fuel(spark, folder))


def _summary(spark: SparkSession, folder: str, **options) -> DataFrame:
    return gold.executive_summary(
        _footprint(spark, folder),
        gold.retail_changes(_silver(spark, folder, "silver_prices_cleaned")),
        _silver(spark, folder, "silver_market_aggregated"),
        _silver(spark, folder, "silver_weather_aggregated"),
        **options,
    )


# ---- silver and gold ---------------------------------------------------------------------


@_query
def g1_generation_cleaned(spark, folder):
    return _silver(spark, folder, "silver_generation_cleaned")


@_query
def g2_prices_cleaned(spark, folder):
    return _silver(spark, folder, "silver_prices_cleaned")


@_query
def g3_weather_daily(spark, folder):
    return _silver(spark, folder, "silver_weather_aggregated")


@_query
def g4_market_daily(spark, folder):
    return _silver(spark, folder, "silver_market_aggregated")


@_query
def g5_carbon_daily(spark, folder):
    return _silver(spark, folder, "silver_carbon_reference")


@_query
def g6_generation_by_fuel(spark, folder):
    return _by_fuel(spark, folder)


@_query
def g6_preaggregated(spark, folder):
    return _by_fuel(spark, folder, carbon_join="preaggregated", co2_divisor=gold.PHYSICAL_DIVISOR)


@_query
def g7_price_trends(spark, folder):
    return _trends(spark, folder)


@_query
def g7_calendar(spark, folder):
    return _trends(spark, folder, calendar=True)


@_query
def g8_carbon_footprint(spark, folder):
    return _footprint(spark, folder)


@_query
def g9_executive_summary(spark, folder):
    return _summary(spark, folder)


@_query
def g9_deduplicated(spark, folder):
    return _summary(spark, folder, dedupe_dims=True)


# ---- reports -----------------------------------------------------------------------------


@_query
def r1_kpis(spark, folder):
    return reports.kpi_scorecard(_summary(spark, folder), AS_OF_YEAR)


@_query
def r1_kpi_sheet(spark, folder):
    return reports.kpi_scorecard(_summary(spark, folder), AS_OF_YEAR, digits=False)


@_query
def r2_generation_mix(spark, folder):
    return reports.generation_mix(_by_fuel(spark, folder), MIX_SINCE)


@_query
def r2_mix_sheet(spark, folder):
    return reports.generation_mix_sheet(_by_fuel(spark, folder))


@_query
def r2_category_share(spark, folder):
    return reports.category_share(reports.generation_mix(_by_fuel(spark, folder), MIX_SINCE))


@_query
def r3_price_table(spark, folder):
    return reports.price_table(_trends(spark, folder), TABLES_SINCE)


@_query
def r3_price_sheet(spark, folder):
    return reports.price_sheet(_trends(spark, folder))


@_query
def r3_sector_trend(spark, folder):
    return reports.sector_trend(reports.price_rows(_trends(spark, folder), TABLES_SINCE))


@_query
def r3_yoy_distribution(spark, folder):
    return reports.yoy_distribution(reports.price_rows(_trends(spark, folder), TABLES_SINCE))


@_query
def r4_carbon_table(spark, folder):
    return reports.carbon_table(_footprint(spark, folder), TABLES_SINCE)


@_query
def r4_carbon_sheet(spark, folder):
    return reports.carbon_sheet(_footprint(spark, folder))


@_query
def r4_top_states(spark, folder):
    return reports.top_states(reports.carbon_rows(_footprint(spark, folder), TABLES_SINCE))


@_query
def r4_national_trend(spark, folder):
    return reports.national_trend(reports.carbon_rows(_footprint(spark, folder), TABLES_SINCE))


@_query
def r5_market_table(spark, folder):
    return reports.market_table(_silver(spark, folder, "silver_market_aggregated"))


@_query
def r5_market_sheet(spark, folder):
    return reports.market_sheet(_silver(spark, folder, "silver_market_aggregated"))


@_query
def r5_latest_snapshot(spark, folder):
    return reports.market_snapshot(reports.market_rows(_silver(spark, folder, "silver_market_aggregated")))


@_query
def r6_audit_summary(spark, folder):
    return reports.audit_summary(adapters.raw(spark, folder, schemas.AUDIT))


@_query
def l7_audit_state(spark, folder):
    return current_state(adapters.raw(spark, folder, schemas.AUDIT), ["run_id", "asset_name"])


# ---- snapshots ---------------------------------------------------------------------------


@_query
def j3_newest_per_fuel(spark, folder):
    """Daily carbon rows of each fuel's newest day, one per region."""
    return newest_rows_per_key(_silver(spark, folder, "silver_carbon_reference"), ["fuel_type"], "reading_date")


@_query
def k1_ordered_trends(spark, folder):
    return gold.in_published_order(_trends(spark, folder), "gold_price_trends")


@_query
def k2_ordered_summary(spark, folder):
    return gold.in_published_order(_summary(spark, folder), "gold_executive_summary")


@_query
def k5_newest_readings(spark, folder):
    return newest_rows(_bronze(spark, folder, "bronze_market_prices"), "recorded_at")


# ---- scans and dimensions ----------------------------------------------------------------


@_query
def s1_bronze_views(spark, folder):
    lines = None
    for view in BRONZE_VIEWS:
        rows = publish_view(_bronze(spark, folder, view), view)
        line = spark.table(view).agg(
            F.lit(view).alias("view_name"),
            F.lit(len(rows.columns)).alias("column_count"),
            F.count(F.lit(1)).alias("row_count"),
            F.max("ingested_at").alias("newest"),
        )
        lines = line if lines is None else lines.unionByName(line)
    return lines


@_query
def s9_period_facets(spark, folder):
    start, end = FACET_RANGE
    return facets(adapters.raw(spark, folder, schemas.GENERATION), start, end, FACET_STATES)


@_query
def s10_page(spark, folder):
    return page(adapters.raw(spark, folder, schemas.GENERATION), PAGE_NUMBER, PAGE_SIZE)


@_query
def s10_seek_page(spark, folder):
    """The same page, found by the last row of the page before it."""
    rows = adapters.raw(spark, folder, schemas.GENERATION)
    before = page(rows, PAGE_NUMBER - 1, PAGE_SIZE)
    last = before.orderBy("period", *[F.desc_nulls_first(c) for c in before.columns if c != "period"]).first()
    return page_after(rows, last.asDict(), PAGE_SIZE)


@_query
def s12_full_refresh(spark, folder):
    """A table that is refreshed twice, the second time by more rows than the first."""
    path = f"{session.scratch_path(spark, 's12')}/prices"
    rows = adapters.raw(spark, folder, schemas.PRICES)
    refresh_table(rows.filter(F.col("sector_id") == "RES"), path, ["period"])
    refresh_table(rows, path, ["period"])
    return read_table(spark, path).select(*rows.columns)


@_query
def s12_version_reads(spark, folder):
    """A reader of a version that two later ones have followed."""
    path = f"{session.scratch_path(spark, 's12')}/prices"
    rows = adapters.raw(spark, folder, schemas.PRICES)
    refresh_table(rows.filter(F.col("sector_id") == "RES"), path, ["period"])
    held = read_table(spark, path)
    refresh_table(rows, path, ["period"])
    refresh_table(rows.filter(F.col("sector_id") == "IND"), path)
    return held


@_query
def s18_report_sheet(spark, folder):
    """A report written as a titled sheet, read back by its titles."""
    sheet = reports.market_sheet(_silver(spark, folder, "silver_market_aggregated"))
    path = f"{session.scratch_path(spark, 's18')}/markets"
    write_report(sheet, path)
    read = spark.read.option("header", True).csv(path)
    kinds = {f.name: f.dataType for f in sheet.schema}
    titles = {title.lower().replace(" ", "_"): title for title in read.columns}
    return read.select(*(F.col(titles[name]).cast(kind).alias(name) for name, kind in kinds.items()))


PAGE_RECORDS = 200
# Gzip files are not split: these keep one at about 25 MB of text.
PAGES_PER_FILE = 1000
READINGS_PER_FILE = 100_000


def _land(documents: DataFrame, path: str, per_file: int) -> None:
    """Adds JSON documents (one text column) to a landing, one to a line, as gzip files."""
    writer = documents.write.mode("append").option("compression", "gzip")
    writer.option("maxRecordsPerFile", per_file).text(path)


def _generation_pages(rows: DataFrame) -> DataFrame:
    """Page envelopes of raw generation rows, as JSON text.

    The rows are dealt out by page before they are collected: a list is as long as its rows, so
    lists made before the shuffle move as much, and large tasks sort and spill them to make them.
    """
    record = F.struct(
        F.col("period"),
        F.col("state_code").alias("location"),
        F.col("state_description").alias("stateDescription"),
        F.col("sector_id").alias("sectorid"),
        F.col("sector_description").alias("sectorDescription"),
        F.col("fuel_type_code").alias("fueltypeid"),
        F.col("fuel_type_description").alias("fuelTypeDescription"),
        F.col("generation_mwh").cast("string").alias("generation"),
        F.col("generation_units").alias("generation-units"),
    )
    dealt = rows.withColumn("page", F.floor(F.col("id") / PAGE_RECORDS)).repartition("page")
    pages = dealt.groupBy("page").agg(F.collect_list(record).alias("data"))
    return pages.select(F.to_json(F.struct(F.struct("data").alias("response"))))


@_query
def s7_landed_pages(spark, folder):
    """Generation landed as page envelopes of some records each, read, normalised and accepted."""
    path = f"{session.scratch_path(spark, 's7')}/pages"
    _land(_generation_pages(adapters.raw(spark, folder, schemas.GENERATION)), path, PAGES_PER_FILE)
    landed = landing.accepted(landing.normalise_generation(landing.read_pages(spark, path), request_id="fixture"))
    return landed.select(*[c for c in column_names(schemas.GENERATION) if c not in ("id", "ingested_at")])


def _land_market(readings: DataFrame, path: str) -> None:
    names = [c for c in column_names(schemas.MARKET) if c not in ("id", "ingested_at", "source")]
    _land(readings.select(F.to_json(F.struct(*names))), path, READINGS_PER_FILE)


@_query
def s8_landed_readings(spark, folder):
    """Market readings that land twice, each landing loaded by two runs: files are taken once."""
    base = session.scratch_path(spark, "s8")
    lake, readings = Lake(spark, f"{base}/lake"), adapters.raw(spark, folder, schemas.MARKET)
    for odd in (0, 1):
        _land_market(readings.filter(F.col("id") % 2 == odd), f"{base}/landing")
        for run in ("first", "again"):
            lake.load_landed(schemas.MARKET, f"{base}/landing", f"{run}-{odd}")
    return lake.raw_table(schemas.MARKET).drop("id", "ingested_at")


@_query
def l9_empty_guard(spark, folder):
    """Loads of some readings and of none: the empty one leaves no event."""
    base = session.scratch_path(spark, "l9")
    lake, readings = Lake(spark, f"{base}/lake"), adapters.raw(spark, folder, schemas.MARKET)
    names = [c for c in column_names(schemas.MARKET) if c not in ("id", "ingested_at", "source")]
    texts = readings.select(*(F.col(c).cast("string").alias(c) for c in names))
    lake.load_readings(schemas.MARKET, texts, "some")
    lake.load_readings(schemas.MARKET, texts.filter(F.col("region") == "nowhere"), "none")
    return current_state(lake.audit.read()).select("run_id", "asset_name", "status", "records_written")


@_query
def s11_trailing(spark, folder):
    return facets(adapters.raw(spark, folder, schemas.PRICES), trailing_period(dt.date(2000, 6, 30), 90))


@_query
def s16_factors(spark, folder):
    readings = _bronze(spark, folder, "bronze_carbon_intensity")
    measured = readings.groupBy(F.lower(F.trim("fuel_type")).alias("fuel_type")).agg(
        F.count(F.lit(1)).alias("readings"), rounded(mean("direct_co2_per_mwh"), 4).alias("mean_direct")
    )
    factors = dims.emission_factors(spark)
    off = (F.col("mean_direct").cast("double") / F.nullif("direct_co2_gco2_per_kwh", F.lit(0.0)) - 1) * 100
    return factors.join(measured, "fuel_type", "left").select(
        "fuel_type",
        "direct_co2_gco2_per_kwh",
        "lifecycle_co2_gco2_per_kwh",
        "category",
        "description",
        F.coalesce("readings", F.lit(0)).alias("readings"),
        "mean_direct",
        rounded(off, 2).alias("off_factor_pct"),
    )


@_query
def s17_grid(spark, folder):
    """Which region and fuel pairs of the request grid have readings, and how many."""
    readings = _bronze(spark, folder, "bronze_carbon_intensity")
    held = readings.groupBy("region", F.lower(F.trim("fuel_type")).alias("fuel_type")).agg(
        F.count(F.lit(1)).alias("readings"), F.max("recorded_at").cast("date").alias("newest")
    )
    grid = dims.request_grid(spark)
    return grid.join(held, ["region", "fuel_type"], "left").withColumn(
        "readings", F.coalesce("readings", F.lit(0))
    )


# ---- loading -----------------------------------------------------------------------------


def _split_loads(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows stored earlier in a month and rows that come in later, for the same periods."""
    day = F.dayofmonth("ingested_at")
    return df.filter(day <= SPLIT_DAY), df.filter(day > SPLIT_DAY)


def _inserted(spark: SparkSession, folder: str, table: str) -> DataFrame:
    stored, fresh = _split_loads(adapters.raw(spark, folder, table))
    return merge.insert_new(fresh, stored, schemas.LOAD_KEYS[table], ["ingested_at", "id"], "period")


@_query
def l5_insert_new(spark, folder):
    return _inserted(spark, folder, schemas.GENERATION)


@_query
def l6_insert_prices(spark, folder):
    return _inserted(spark, folder, schemas.PRICES)


_PLACE_FIELDS = ["period", "stateid", "stateDescription", "sectorid", "sectorId"]
_GENERATION_FIELDS = [
    *_PLACE_FIELDS,
    "location",
    "locationDescription",
    "fueltypeid",
    "fuelTypeId",
    "fuelTypeDescription",
    "generation",
    "generation-units",
]
_PRICE_FIELDS = [*_PLACE_FIELDS, "sectorName", "price", "revenue", "sales", "customers"]


def _records(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """Loose records as they land: JSON text with missing, empty and malformed fields."""
    events = adapters.given(spark, folder, "events")
    state = F.expr(f"split_part('{adapters.STATES}', ',', cast(user_id % 25 as int) + 1)")
    event = F.col("event_id")
    number = F.regexp_extract("props", r'"k": ([0-9]+)', 1)
    month = F.substring(F.col("ts").cast("string"), 1, 7)
    fields = {
        "period": F.when(event % 29 == 0, None).when(event % 31 == 0, "2024/01").otherwise(month),
        "location": F.when(F.col("user_id") % 4 == 0, "").otherwise(state),
        "stateid": F.when(F.col("user_id") % 8 == 0, None).otherwise(state),
        "stateDescription": F.when(event % 3 == 0, "").otherwise(F.concat(F.lit("State "), state)),
        "locationDescription": F.concat(F.lit("Place "), state),
        "sectorid": F.when(event % 5 == 0, "99"),
        "sectorId": F.when(event % 5 != 0, "RES"),
        "fueltypeid": F.when(event % 7 == 0, "").otherwise("NG"),
        "fuelTypeId": F.lit("SUN"),
        "fuelTypeDescription": F.col("event_type"),
        "generation": F.when(event % 23 == 0, "abc").when(event % 37 == 0, "").when(event % 41 == 0, None).otherwise(number),
        "generation-units": F.lit("thousand megawatthours"),
        "sectorName": F.col("event_type"),
        "price": F.when(event % 19 == 0, "n/a").otherwise(F.concat(number, F.lit(".25"))),
        "revenue": F.concat(number, F.lit("00.5")),
        "sales": F.when(event % 17 == 0, None).otherwise(number),
        "customers": F.when(event % 43 == 0, "many").otherwise(F.concat(number, F.lit(".9"))),
    }
    # put together as text, since a struct cannot hold two names that differ only in case
    pairs = [F.concat(F.lit(f'"{name}": "'), fields[name], F.lit('"')) for name in names]
    head, tail = F.lit('{"response": {"total": 1, "data": [{'), F.lit("}]}}")
    text = F.concat(head, F.concat_ws(", ", *pairs), tail)
    pages = events.select("event_id", F.from_json(text, landing.PAGE_SCHEMA).alias("page"))
    return pages.select("event_id", F.explode("page.response.data").alias("record"))


@_query
def l1_normalise(spark, folder):
    rows = landing.normalise_generation(_records(spark, folder, _GENERATION_FIELDS), request_id="fixture")
    return landing.accepted(rows)


@_query
def l2_normalise_prices(spark, folder):
    rows = landing.normalise_prices(_records(spark, folder, _PRICE_FIELDS), request_id="fixture")
    return landing.accepted(rows)


@_query
def l3_quarantine(spark, folder):
    generation = landing.rejected(
        landing.normalise_generation(_records(spark, folder, _GENERATION_FIELDS))
    )
    prices = landing.rejected(landing.normalise_prices(_records(spark, folder, _PRICE_FIELDS)))
    kept = ["event_id", "period", "state_code", "sector_id", "reject_reason"]
    return (
        generation.select(F.lit("generation").alias("kind"), *kept)
        .unionByName(prices.select(F.lit("prices").alias("kind"), *kept))
    )


def _forecast_documents(events: DataFrame) -> DataFrame:
    """One forecast document per event, as JSON text: zero to three points, some without optional fields."""
    region = F.expr(f"split_part('{adapters.REGIONS}', ',', cast(user_id % 9 as int) + 1)")
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    points = F.transform(
        F.sequence(F.lit(1), F.lit(3)),
        lambda i: F.struct(
            (hour + F.make_dt_interval(hours=i)).cast("string").alias("forecast_hour"),
            (F.col("user_id") % 1000 * 100 + i).cast("string").alias("forecast_demand_mw"),
            F.when(i != 2, (F.col("event_id") % 40).cast("string")).alias("temperature_c"),
            (F.lit(99) - i).cast("string").alias("confidence_pct"),
        ),
    )
    count = (F.col("event_id") % 4).cast("int")
    shown = F.when(F.col("event_id") % 8 != 4, F.slice(points, F.lit(1), count))
    document = F.struct(region.alias("region"), hour.cast("string").alias("generated_at"), shown.alias("forecast"))
    return events.select(F.to_json(document).alias("text"))


def _parsed_forecasts(documents: DataFrame) -> DataFrame:
    return documents.select(F.from_json("text", landing.DEMAND_FORECAST_SCHEMA).alias("d")).select("d.*")


@_query
def l8_flatten(spark, folder):
    documents = _forecast_documents(adapters.given(spark, folder, "events"))
    return landing.accepted(landing.normalise_demand_forecast(_parsed_forecasts(documents)))


# ---- merging -----------------------------------------------------------------------------


@_query
def u1_upsert(spark, folder):
    """Cleaned rows of later loads over those of earlier ones, one row per key."""
    stored, fresh = _split_loads(_silver(spark, folder, "silver_generation_cleaned"))
    model = silver.MODELS["silver_generation_cleaned"]
    existing = merge.last_per_key(stored, model.keys, model.order)
    return merge.upsert(existing, fresh, model.keys, model.order)


def _stored_market(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    readings = _bronze(spark, folder, "bronze_market_prices")
    earlier = readings.filter(F.col("ingested_at") < F.lit(SPLIT_TIME).cast("timestamp_ntz"))
    return readings, silver.daily_market(earlier)


@_query
def u2_watermark(spark, folder):
    readings, stored = _stored_market(spark, folder)
    return merge.since_watermark(readings, stored)


@_query
def u5_lookback(spark, folder):
    readings, stored = _stored_market(spark, folder)
    return merge.since_watermark(readings, stored, lookback_days=LOOKBACK_DAYS)


@_query
def u1_replace_delta(spark, folder):
    readings, stored = _stored_market(spark, folder)
    delta = silver.daily_market(merge.since_watermark(readings, stored))
    return merge.upsert(stored, delta, ["region", "reading_date"])


@_query
def u1_recompute_touched(spark, folder):
    readings, stored = _stored_market(spark, folder)
    keys = ["region", "reading_date"]
    delta = merge.since_watermark(readings, stored)
    again = merge.recompute_touched(readings, delta, silver.daily_market, keys, "recorded_at")
    return merge.upsert(stored, again, keys)


@_query
def u1_merge_partials(spark, folder):
    """Daily markets from partial rows: what is read later is added, nothing is read twice."""
    base, kept = session.scratch_path(spark, "partials"), partials.models()["silver_market_aggregated"]
    readings = _bronze(spark, folder, "bronze_market_prices")
    late = F.col("ingested_at") >= F.lit(SPLIT_TIME).cast("timestamp_ntz")
    for part in (~late, late):
        partials.take_in(spark, kept, f"{base}/partials", readings.filter(part))
        partials.show(spark, kept, f"{base}/partials", f"{base}/table")
    return read_table(spark, f"{base}/table")


@_query
def u1_carbon_partials(spark, folder):
    """The same of carbon readings, whose latest category goes with the day."""
    base, kept = session.scratch_path(spark, "partials"), partials.models()["silver_carbon_reference"]
    readings = _bronze(spark, folder, "bronze_carbon_intensity")
    for third in range(3):
        partials.take_in(spark, kept, f"{base}/partials", readings.filter(F.col("id") % 3 == third))
    partials.show(spark, kept, f"{base}/partials", f"{base}/table")
    return read_table(spark, f"{base}/table")


@_query
def u3_appended_columns(spark, folder):
    """A merge whose rows have a column that the stored ones lack."""
    readings, stored = _stored_market(spark, folder)
    target = merge.MergeTarget(f"{session.scratch_path(spark, 'u3')}/table", ("region", "reading_date"))
    merge.merge_table(spark, target, stored.drop("peak_demand_mw"))
    merge.merge_table(spark, target, silver.daily_market(merge.since_watermark(readings, stored)))
    return merge.existing_table(spark, target)


# ---- data quality ------------------------------------------------------------------------


@_query
def d_raw_quality(spark, folder):
    return quality.quality_report({t: adapters.raw(spark, folder, t) for t in quality.RAW_CHECKS})


@_query
def d2_repeated_ids(spark, folder):
    """Ids of readings, some of them stored twice: found by their bits, looked up by value."""
    readings = adapters.raw(spark, folder, schemas.MARKET).select("id")
    again = readings.filter(F.col("id") % 1009 == 0)
    return quality.repeated_values(readings.union(again), "id")


@_query
def d_bronze_quality(spark, folder):
    return quality.quality_report({v: _bronze(spark, folder, v) for v in quality.BRONZE_CHECKS})


@_query
def d_silver_quality(spark, folder):
    return quality.quality_report({m: _silver(spark, folder, m) for m in quality.SILVER_CHECKS})


@_query
def d_gold_quality(spark, folder):
    marts = {
        "gold_generation_by_fuel_monthly": _by_fuel,
        "gold_price_trends": _trends,
        "gold_carbon_footprint": _footprint,
        "gold_executive_summary": _summary,
    }
    return quality.quality_report({name: build(spark, folder) for name, build in marts.items()})


@_query
def d7_reading_bounds(spark, folder):
    """Readings outside the model's bounds; humidity and cloud cover are shifted to break some."""
    readings = _bronze(spark, folder, "bronze_weather")
    shifted = readings.withColumns(
        {
            "humidity_pct": F.col("humidity_pct") + 20,
            "cloud_cover_pct": F.col("cloud_cover_pct") - 10,
        }
    )
    broken = landing.out_of_bounds(shifted, schemas.WEATHER)
    return broken.select("id", "region", "humidity_pct", "cloud_cover_pct", "broken")


# ---- rules -------------------------------------------------------------------------------


@_query
def e1_price_signal(spark, folder):
    readings = _bronze(spark, folder, "bronze_market_prices")
    based = readings.join(F.broadcast(dims.base_prices(spark)), "region", "left")
    signal = price_signal(F.col("spot_price_usd_mwh"), F.col("base_price_usd_mwh"))
    return based.select("id", "region", "spot_price_usd_mwh", "base_price_usd_mwh", signal.alias("signal"))


@_query
def e2_carbon_category(spark, folder):
    readings = _bronze(spark, folder, "bronze_carbon_intensity")
    shifted = F.col("lifecycle_co2_per_mwh") - 5
    return readings.select("id", shifted.alias("lifecycle"), carbon_category(shifted).alias("category"))


@_query
def e3_fallback(spark, folder):
    readings = _bronze(spark, folder, "bronze_weather")
    odd = F.col("id") % 5 == 0
    region = code(F.when(odd, F.col("weather_condition")).otherwise(F.lower("region")))
    fuel = F.lower(F.trim(F.when(odd, F.lit(" COAL ")).otherwise(F.col("weather_condition"))))
    return readings.select(
        "id",
        known_or(region, dims.REGIONS, dims.DEFAULT_REGION).alias("region"),
        known_or(fuel, dims.KNOWN_FUELS, dims.DEFAULT_FUEL).alias("fuel_type"),
    )


@_query
def e4_horizon(spark, folder):
    """A forecast spine for every region and day with readings, from its newest hour on."""
    readings = adapters.raw(spark, folder, schemas.FORECAST)
    day = F.to_date("forecast_hour").alias("issue_date")
    issues = readings.groupBy("region", day).agg(F.max("forecast_hour").alias("issued_at"))
    return hourly_spine(issues, "issued_at", HORIZON_HOURS)


@_query
def e4_varying_horizon(spark, folder):
    """A forecast spine whose length differs from issue to issue."""
    readings = adapters.raw(spark, folder, schemas.FORECAST)
    day = F.to_date("forecast_hour").alias("issue_date")
    issues = readings.groupBy("region", day).agg(F.max("forecast_hour").alias("issued_at"))
    return hourly_spine(issues, "issued_at", F.dayofmonth("issue_date") * 5)


# ---- helpers on native tables ------------------------------------------------------------


def _money(column: str):
    return F.sum(F.col(column).cast("decimal(18,2)"))


@_query
def w2_pct_of_total(spark, folder):
    orders = adapters.given(spark, folder, "orders")
    totals = orders.groupBy(F.year("o_orderdate").alias("order_year"), "o_orderstatus").agg(
        _money("o_totalprice").alias("total")
    )
    return totals.withColumn("pct", pct_of_total("total", ["order_year"]))


@_query
def w7_yoy(spark, folder):
    orders = adapters.given(spark, folder, "orders")
    month = F.trunc("o_orderdate", "month").cast("date").alias("order_month")
    totals = orders.groupBy("o_orderpriority", month).agg(_money("o_totalprice").alias("total"))
    return totals.withColumn("yoy_pct", yoy_change_pct("total", ["o_orderpriority"], "order_month"))


@_query
def p15_safe_divide(spark, folder):
    lines = adapters.given(spark, folder, "lineitem")

    def moved(condition):
        quantity = F.when(condition, F.col("l_quantity").cast("decimal(18,2)")).otherwise(F.lit(0))
        return F.sum(quantity).cast("double")

    totals = lines.groupBy("l_partkey").agg(
        moved(F.col("l_returnflag") == "R").alias("returned"), moved(F.col("l_returnflag") == "A").alias("accepted")
    )
    return totals.withColumn("returned_per_accepted", rounded(safe_divide("returned", "accepted", 0.0), 4))


# ---- streams -----------------------------------------------------------------------------


def _file(folder: str, table: str) -> str:
    """A pattern that names the table whether it is one file or a folder of files."""
    return f"{folder}/{table}.parquet*"


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = adapters.given(spark, folder, "events").schema
    return streams.stream_table(spark, schema, _file(folder, "events"))


def _market_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Market readings of the event stream, with the time of the event as reading time."""
    events = _event_stream(spark, folder)
    rows = spark.sql(adapters.MARKET, events=events)
    timed = rows.withColumn("recorded_at", F.col("ingested_at").cast("timestamp"))
    return timed.withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))


@_query
def x1_stream_readings(spark, folder):
    base = session.scratch_path(spark, "x1")
    rows = _market_stream(spark, folder).select(*column_names(schemas.MARKET))
    streams.append_readings(rows, f"{base}/{schemas.MARKET}", f"{base}/checkpoint")
    return read_raw(spark, schemas.MARKET, base)


@_query
def x2_stream_daily(spark, folder):
    base = session.scratch_path(spark, "x2")
    target = merge.MergeTarget(f"{base}/table", ("region", "reading_date"))
    daily = streams.daily_market_stream(_market_stream(spark, folder))
    streams.keep_merged(daily, target, f"{base}/checkpoint")
    return merge.existing_table(spark, target)


@_query
def x2_stream_partials(spark, folder):
    """Daily markets kept by partial rows: no stream state, readings of any age."""
    base, kept = session.scratch_path(spark, "x2"), partials.models()["silver_market_aggregated"]
    rows = _market_stream(spark, folder)
    streams.keep_partials(rows, kept, f"{base}/partials", f"{base}/table", f"{base}/checkpoint")
    return read_table(spark, f"{base}/table")


@_query
def x3_stream_insert(spark, folder):
    base = session.scratch_path(spark, "x3")
    schema = adapters.given(spark, folder, "lineitem").schema
    lines = streams.stream_table(spark, schema, _file(folder, "lineitem"))
    rows = spark.sql(adapters.GENERATION, lineitem=lines)
    rows = rows.withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))
    renamed = rows.withColumnRenamed("id", "seq")
    table = schemas.GENERATION
    streams.insert_new_stream(renamed, table, f"{base}/raw", ["ingested_at", "seq"], f"{base}/checkpoint")
    return read_raw(spark, table, f"{base}/raw").drop("id")


@_query
def x4_stream_forecast(spark, folder):
    base = session.scratch_path(spark, "x4")
    documents = _forecast_documents(_event_stream(spark, folder))
    points = landing.accepted(landing.normalise_demand_forecast(_parsed_forecasts(documents)))
    streams.append_readings(points, f"{base}/table", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/table").select(*points.columns)


@_query
def x5_batch_and_stream(spark, folder):
    """Even readings come by a stream, odd ones in a batch, into one table."""
    base = session.scratch_path(spark, "x5")
    names = [name for name in column_names(schemas.MARKET) if name != "id"]
    even = _market_stream(spark, folder).filter(F.col("id") % 2 == 0).select(*names)
    streams.append_readings(even, f"{base}/{schemas.MARKET}", f"{base}/checkpoint")
    odd = adapters.raw(spark, folder, schemas.MARKET).filter(F.col("id") % 2 == 1)
    timed = odd.withColumn("recorded_at", F.col("ingested_at")).select(*names)
    append_load(spark, f"{base}/{schemas.MARKET}", timed, "batch-1")
    stored = read_raw(spark, schemas.MARKET, base)
    repeats = stored.groupBy("id").agg(F.count(F.lit(1)).alias("times"))
    return stored.join(repeats, "id").select(*names, (F.col("times") == 1).alias("numbered_once"))
