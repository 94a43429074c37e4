"""The daily run and its parts on hand-made landings."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from samples import (
    CARBON,
    FORECAST,
    GENERATION,
    MARKET,
    PRICE,
    SOLAR,
    SOLAR_CARBON,
    WEATHER,
    envelope,
    land,
)

from gridmart import schemas
from gridmart.operators import quality
from gridmart.operators.audit import AuditLog, current_state, valid_states
from gridmart.plans import gold, silver
from gridmart.plans.daily import Lake, run_daily
from gridmart.sources import landing
from gridmart.sources.dims import REGIONS
from gridmart.sources.raw import register_bronze
from gridmart.sources.sinks import append_table, write_report

DAY_1 = dt.datetime(2024, 2, 1, 6)
DAY_2 = dt.datetime(2024, 2, 2, 6)


def pages(spark, folder, name, *records):
    return landing.read_pages(spark, land(folder, name, envelope(*records)))


def states(lake):
    rows = current_state(lake.audit.read()).orderBy("id").collect()
    return [(r.asset_name, r.status, r.records_written) for r in rows]


def test_second_load_inserts_nothing(spark, lake, tmp_path):
    records = pages(spark, tmp_path / "in", "a", GENERATION, SOLAR, GENERATION | {"generation": "1"})
    assert lake.load_generation(records, "run-1") == 2
    assert lake.load_generation(records, "run-2") == 0
    stored = lake.view("bronze_eia_generation")
    assert {r.generation_mwh for r in stored.collect()} == {Decimal("52000.5000"), Decimal("999.5000")}
    assert states(lake) == [(schemas.GENERATION, "success", 2), (schemas.GENERATION, "success", 0)]
    assert schemas.contract_violations(stored, schemas.GENERATION) == []


def test_revisions_are_ignored_and_new_keys_added(spark, lake, tmp_path):
    lake.load_prices(pages(spark, tmp_path / "1", "a", PRICE), "run-1")
    revised = pages(spark, tmp_path / "2", "a", PRICE | {"price": "99"}, PRICE | {"sectorid": "COM"})
    assert lake.load_prices(revised, "run-2") == 1
    held = {r.sector_id: r.price_cents_per_kwh for r in lake.view("bronze_eia_prices").collect()}
    assert held == {"RES": Decimal("9.7500"), "COM": Decimal("9.7500")}
    ids = [r.id for r in lake.view("bronze_eia_prices").collect()]
    assert len(set(ids)) == 2


def test_window_and_states_limit_a_load(spark, lake, tmp_path):
    records = pages(spark, tmp_path / "in", "a", GENERATION | {"period": "2023-01"}, GENERATION, GENERATION | {"location": "CA"})
    assert lake.load_generation(records, "r", since="2023-11", until="2024-02", states=["TX"]) == 1


def test_rejected_rows_are_kept_apart(spark, lake, tmp_path):
    records = pages(spark, tmp_path / "in", "a", GENERATION, GENERATION | {"generation": "abc"})
    assert lake.load_generation(records, "run-1") == 1
    rejected = spark.read.parquet(f"{lake.rejected}/{schemas.GENERATION}").collect()
    assert [r.reject_reason for r in rejected] == ["bad generation"]


def test_failed_load_is_audited_and_raised(spark, lake, tmp_path):
    records = pages(spark, tmp_path / "in", "a", GENERATION | {"generation": "abc"})
    with pytest.raises(Exception, match="bad generation"):
        lake.load_generation(records, "run-1", strict=True)
    row = current_state(lake.audit.read()).first()
    assert (row.status, row.records_written) == ("failed", 0)
    assert 0 < len(row.error_message) <= 1000


def test_empty_landing_leaves_no_trace(spark, lake, tmp_path):
    assert lake.load_generation(pages(spark, tmp_path / "in", "a"), "run-1") == 0
    assert not (tmp_path / "lake").exists()


def test_readings_and_forecasts_append(spark, lake, tmp_path):
    path = land(tmp_path / "w", "a", WEATHER, WEATHER | {"region": "PJM"})
    weather = landing.read_readings(spark, schemas.WEATHER, path)
    assert lake.load_readings(schemas.WEATHER, weather, "run-1") == 2
    assert lake.load_readings(schemas.WEATHER, weather, "run-2") == 2
    stored = lake.view("bronze_weather")
    assert stored.count() == stored.select("id").distinct().count() == 4
    forecasts = landing.read_forecasts(spark, land(tmp_path / "f", "a", FORECAST))
    assert lake.load_forecasts(forecasts, "run-3") == 2
    assert states(lake)[-1] == (schemas.FORECAST, "success", 2)


def test_audit_rejects_unknown_states(spark, tmp_path):
    log = AuditLog(spark, str(tmp_path))
    started = log.start("run", "asset", "source")
    with pytest.raises(ValueError):
        log._append({**started, "status": "invalid_status"})
    assert valid_states(log.read()).count() == 1
    with pytest.raises(Exception, match="unknown audit status"):
        valid_states(log.read().withColumn("status", F.lit("invalid_status"))).collect()


# ---- silver ------------------------------------------------------------------------------


def market_rows(spark, *rows):
    """(id, day of loading, region, reading time, spot price)"""
    columns = "id bigint, ingested_at timestamp, region string, recorded_at timestamp, spot double"
    made = spark.createDataFrame(rows, columns)
    filled = made.withColumns(
        {
            "spot_price_usd_mwh": F.col("spot").cast("decimal(10,4)"),
            "peak_price_usd_mwh": (F.col("spot") * 2).cast("decimal(10,4)"),
            "off_peak_price_usd_mwh": F.lit(1).cast("decimal(10,4)"),
            "demand_mw": F.lit(100).cast("decimal(12,2)"),
            "demand_forecast_mw": F.lit(100).cast("decimal(12,2)"),
            "price_signal": F.lit("normal"),
            "source": F.lit("enrichment_api"),
        }
    )
    return filled.select(*[f.name for f in schemas.raw_schema(schemas.MARKET)])


NOON = dt.datetime(2024, 1, 1, 12)


def test_daily_market_numbers(spark):
    rows = market_rows(
        spark,
        (1, DAY_1, "PJM", NOON, 10.0),
        (2, DAY_1, "PJM", NOON, 20.0),
        (3, DAY_1, "PJM", NOON, None),
        (4, DAY_1, "SPP", NOON, 5.0),
        (5, DAY_1, "WECC", NOON, 0.0),
        (6, DAY_1, None, NOON, 7.0),
    )
    held = {r.region: r for r in silver.daily_market(rows).collect()}
    assert set(held) == {"PJM", "SPP", "WECC"}
    assert held["PJM"].avg_spot_price_usd_mwh == 15
    assert held["PJM"].price_volatility_pct == Decimal("47.14")
    assert held["PJM"].reading_count == 2
    assert held["SPP"].price_volatility_pct is None
    assert held["WECC"].price_volatility_pct == 0


def test_latest_carbon_category_keeps_null(spark):
    columns = """id bigint, ingested_at timestamp, region string, fuel_type string, recorded_at timestamp,
        carbon_intensity_category string, direct_co2_per_mwh decimal(10,4), lifecycle_co2_per_mwh decimal(10,4)"""
    late = NOON + dt.timedelta(hours=3)
    rows = [
        (1, DAY_1, "PJM", " Coal ", NOON, "high", Decimal(800), Decimal(800)),
        (2, DAY_1, "PJM", "coal", late, None, Decimal(820), Decimal(840)),
        (3, DAY_1, "SPP", "coal", late, "low", Decimal(1), None),
        (4, DAY_1, "SPP", "coal", late, "medium", Decimal(2), None),
    ]
    held = {r.region: r for r in silver.daily_carbon(spark.createDataFrame(rows, columns)).collect()}
    assert (held["PJM"].fuel_type, held["PJM"].carbon_intensity_category) == ("coal", None)
    assert (held["PJM"].avg_direct_co2_per_mwh, held["PJM"].avg_lifecycle_co2_per_mwh) == (810, 820)
    assert held["SPP"].carbon_intensity_category == "medium"
    assert held["SPP"].avg_lifecycle_co2_per_mwh is None


def test_colliding_silver_keys_keep_the_latest(spark, lake, tmp_path):
    records = pages(spark, tmp_path / "in", "a", GENERATION, GENERATION | {"location": " tx ", "generation": "7"})
    assert lake.load_generation(records, "run-1", ingested_at=DAY_1) == 2
    assert lake.refresh_silver("silver_generation_cleaned") == 1
    row = lake.staged("silver_generation_cleaned").first()
    assert (row.state_code, row.generation_mwh) == ("TX", Decimal("7000.0000"))


def test_silver_is_incremental(spark, lake, tmp_path):
    lake.load_prices(pages(spark, tmp_path / "1", "a", PRICE), "run-1", ingested_at=DAY_1)
    assert lake.refresh_silver("silver_prices_cleaned") == 1
    assert lake.refresh_silver("silver_prices_cleaned") == 0
    more = pages(spark, tmp_path / "2", "a", PRICE | {"period": "2024-02"}, PRICE | {"period": "2024-03", "price": "0"})
    lake.load_prices(more, "run-2", ingested_at=DAY_2)
    assert lake.refresh_silver("silver_prices_cleaned") == 1
    rows = lake.staged("silver_prices_cleaned").orderBy("period").collect()
    assert [(r.period, r.price_usd_per_mwh) for r in rows] == [("2024-01", Decimal("97.5")), ("2024-02", Decimal("97.5"))]


def load_market(lake, *rows):
    append_table(market_rows(lake.spark, *rows), f"{lake.raw}/{schemas.MARKET}")


def daily(lake):
    rows = lake.staged("silver_market_aggregated").collect()
    return {(r.region, r.reading_date.day): (float(r.avg_spot_price_usd_mwh), r.reading_count) for r in rows}


TWO_LOADS = (
    [(1, DAY_1, "PJM", NOON, 10.0), (2, DAY_1, "PJM", NOON, 20.0), (3, DAY_1, "SPP", NOON, 5.0)],
    [(4, DAY_2, "PJM", NOON, 60.0), (5, DAY_2, "PJM", NOON + dt.timedelta(days=1), 8.0)],
)


@pytest.mark.parametrize(
    ("mode", "touched_day"),
    [("replace_delta", (60.0, 1)), ("recompute_touched", (30.0, 3)), ("merge_partials", (30.0, 3))],
)
def test_late_readings_of_a_stored_day(lake, mode, touched_day):
    for rows in TWO_LOADS:
        load_market(lake, *rows)
        lake.refresh_silver("silver_market_aggregated", incremental_mode=mode)
    assert daily(lake) == {("PJM", 1): touched_day, ("SPP", 1): (5.0, 1), ("PJM", 2): (8.0, 1)}


def test_recomputed_days_equal_a_full_refresh(lake):
    for rows in TWO_LOADS:
        load_market(lake, *rows)
        lake.refresh_silver("silver_market_aggregated", incremental_mode="recompute_touched")
    incremental = daily(lake)
    lake.refresh_silver("silver_market_aggregated", full_refresh=True)
    assert daily(lake) == incremental


def test_modes_may_follow_each_other(lake):
    for rows, mode in zip((*TWO_LOADS, [(6, DAY_2 + dt.timedelta(days=1), "PJM", NOON, 90.0)]), ("merge_partials", "recompute_touched", "merge_partials")):
        load_market(lake, *rows)
        lake.refresh_silver("silver_market_aggregated", incremental_mode=mode)
    assert daily(lake) == {("PJM", 1): (45.0, 4), ("SPP", 1): (5.0, 1), ("PJM", 2): (8.0, 1)}


def test_unknown_mode(lake):
    with pytest.raises(ValueError):
        lake.refresh_silver("silver_market_aggregated", incremental_mode="guess")


# ---- gold --------------------------------------------------------------------------------


def golden_inputs(spark, lake, tmp_path, regions):
    lake.load_generation(pages(spark, tmp_path / "g", "a", GENERATION, SOLAR), "run", ingested_at=DAY_1)
    readings = [c | {"region": r} for r in regions for c in (CARBON, SOLAR_CARBON)]
    older = CARBON | {"recorded_at": "2023-12-01T00:00:00Z", "direct_co2_per_mwh": 1.0}
    path = land(tmp_path / "c", "a", *readings, older)
    lake.load_readings(schemas.CARBON, landing.read_readings(spark, schemas.CARBON, path), "run")
    generation = silver.clean_generation(lake.view("bronze_eia_generation"))
    return generation, silver.daily_carbon(lake.view("bronze_carbon_intensity"))


@pytest.mark.parametrize(
    ("regions", "gas", "sun", "tonnes"),
    [
        (["ERCOT"], "52000500", "999500", "23660.23"),
        (REGIONS, "468004500", "8995500", "212942.05"),
    ],
)
def test_carbon_join_golden(spark, lake, tmp_path, regions, gas, sun, tonnes):
    generation, carbon = golden_inputs(spark, lake, tmp_path, regions)
    by_fuel = gold.generation_by_fuel(generation, carbon)
    held = {r.fuel_type_code: r for r in by_fuel.collect()}
    assert held["NG"].total_generation_mwh == Decimal(gas)
    assert held["SUN"].total_generation_mwh == Decimal(sun)
    assert held["NG"].estimated_co2_tonnes == Decimal(tonnes)
    assert held["SUN"].estimated_co2_tonnes == 0
    assert (held["NG"].pct_of_state_generation, held["SUN"].pct_of_state_generation) == (Decimal("98.11"), Decimal("1.89"))
    state = gold.carbon_footprint(by_fuel).first()
    assert state.grid_carbon_intensity_gco2_kwh == Decimal("0.45")
    assert (state.renewable_share_pct, state.natural_gas_mwh) == (Decimal("1.89"), Decimal(gas))
    physical = gold.generation_by_fuel(generation, carbon, co2_divisor=gold.PHYSICAL_DIVISOR)
    assert gold.carbon_footprint(physical).first().grid_carbon_intensity_gco2_kwh == Decimal("446.42")


def test_preaggregated_carbon_keeps_true_sums(spark, lake, tmp_path):
    generation, carbon = golden_inputs(spark, lake, tmp_path, REGIONS)
    held = {r.fuel_type_code: r for r in gold.generation_by_fuel(generation, carbon, "preaggregated").collect()}
    assert held["NG"].total_generation_mwh == Decimal("52000500")
    assert held["NG"].estimated_co2_tonnes == Decimal("23660.23")
    with pytest.raises(ValueError):
        gold.generation_by_fuel(generation, carbon, "guess")


def trend_inputs(spark, months):
    rows = [(p, int(p[:4]), int(p[5:]), dt.date(int(p[:4]), int(p[5:]), 1), "TX", Decimal(v)) for p, v in months]
    prices = spark.createDataFrame(
        rows, "period string, period_year int, period_month int, period_date date, state_code string, price decimal(14,4)"
    ).withColumns(
        {
            "state_description": F.lit("Texas"),
            "sector_id": F.lit("RES"),
            "sector_name": F.lit("Residential"),
            "price_usd_per_mwh": F.col("price"),
            "price_cents_per_kwh": (F.col("price") / 10).cast("decimal(10,4)"),
            "revenue_million_dollars": F.lit(0),
            "sales_million_kwh": F.lit(0),
            "customers": F.lit(0),
        }
    )
    market = spark.createDataFrame(
        [("ERCOT", dt.date(2024, 1, 1), Decimal(45), Decimal(90)), ("ERCOT", dt.date(2024, 1, 2), Decimal(1), Decimal(2))],
        """region string, reading_date date, avg_spot_price_usd_mwh decimal(28,4),
        avg_peak_price_usd_mwh decimal(28,4)""",
    )
    return prices, market


def test_trends_count_rows_unless_told_to_use_the_calendar(spark):
    months = [f"2023-{m:02d}" for m in range(1, 13) if m != 3] + ["2024-01", "2024-02"]
    prices, market = trend_inputs(spark, [(p, 100 + i) for i, p in enumerate(months)])
    by_rows = {r.period: r for r in gold.price_trends(prices, market).collect()}
    by_date = {r.period: r for r in gold.price_trends(prices, market, calendar=True).collect()}
    assert by_rows["2024-01"].price_yoy_change_pct is None
    assert by_date["2024-01"].price_yoy_change_pct == Decimal("11.00")
    assert by_rows["2024-02"].price_yoy_change_pct == Decimal("12.00")
    assert by_date["2024-02"].price_yoy_change_pct == Decimal("10.89")
    assert by_rows["2023-04"].price_mom_change_pct == Decimal("0.99")
    assert by_date["2023-04"].price_mom_change_pct is None
    assert by_rows["2023-02"].rolling_12m_avg_price_usd_mwh == Decimal("100.50")
    january = by_rows["2024-01"]
    assert (january.wholesale_spot_price_usd_mwh, january.retail_wholesale_spread_usd_mwh) == (45, Decimal("66.00"))
    assert by_rows["2024-02"].retail_wholesale_spread_usd_mwh == Decimal("112.00")


def test_published_order_places_nulls(spark):
    rows = spark.createDataFrame([("1", 5), ("2", None), ("2", 7), (None, 1)], "period string, total_co2_tonnes int").withColumn(
        "total_generation_mwh", F.col("total_co2_tonnes")
    )
    by_carbon = gold.in_published_order(rows, "gold_carbon_footprint").collect()
    assert [(r.period, r.total_co2_tonnes) for r in by_carbon] == [(None, 1), ("2", None), ("2", 7), ("1", 5)]
    by_energy = gold.in_published_order(rows, "gold_executive_summary").collect()
    assert [(r.period, r.total_co2_tonnes) for r in by_energy] == [(None, 1), ("2", 7), ("2", None), ("1", 5)]


# ---- the whole run -----------------------------------------------------------------------


def landed(tmp_path):
    return {
        schemas.GENERATION: land(tmp_path / "in" / "g", "a", envelope(GENERATION, SOLAR)),
        schemas.PRICES: land(tmp_path / "in" / "p", "a", envelope(PRICE)),
        schemas.WEATHER: land(tmp_path / "in" / "w", "a", WEATHER),
        schemas.CARBON: land(tmp_path / "in" / "c", "a", CARBON, SOLAR_CARBON),
        schemas.MARKET: land(tmp_path / "in" / "m", "a", MARKET),
        schemas.FORECAST: land(tmp_path / "in" / "f", "a", FORECAST),
    }


def test_daily_run_twice(spark, tmp_path):
    root = str(tmp_path / "lake")
    places = landed(tmp_path)
    report = run_daily(spark, places, root, DAY_1, "run-1", report_root=str(tmp_path / "reports"))
    assert report.count() == 91
    assert report.agg(F.sum("failures")).first()[0] == 0
    lake = Lake(spark, root)
    summary = lake.mart("gold_executive_summary").collect()
    assert [(r.state_code, r.grid_region) for r in summary] == [("TX", "ERCOT"), ("TX", "ERCOT")]
    assert summary[0].residential_price_usd_mwh == Decimal("97.5")
    assert (summary[0].wholesale_spot_price_usd_mwh, summary[0].avg_temperature_c) == (38, Decimal("17.25"))
    assert summary[0].renewable_revenue_million_usd == Decimal("97.4513")
    sheet = next((tmp_path / "reports" / "kpi_scorecard").glob("*.csv")).read_text().splitlines()
    assert sheet[0].startswith("Total Gen Twh,Avg Renewable Pct")
    assert len(sheet) == 2
    counts = {table: lake.raw_table(table).count() for table in places}
    run_daily(spark, places, root, DAY_2, "run-2", incremental_mode="merge_partials")
    assert {table: lake.raw_table(table).count() for table in places} == counts
    assert lake.mart("gold_executive_summary").collect() == summary
    assert register_bronze(spark, lake.raw)[0] == "bronze_eia_generation"
    assert spark.table("bronze_eia_prices").count() == 1


def test_parts_of_a_run_and_reports_before_any_mart(spark, tmp_path):
    root = str(tmp_path / "lake")
    assert run_daily(spark, landed(tmp_path), root, DAY_1, "run-1", parts=["load"], report_root=str(tmp_path / "reports")) is None
    lake = Lake(spark, root)
    whole = {"audit_summary", "kpi_scorecard", "executive_summary_sheet"}  # these have a row of no rows, or events
    assert {name for name, df in lake.reports(2024).items() if df.count()} == whole
    run_daily(spark, {}, root, DAY_1, "run-1", parts=["silver", "gold"])
    assert lake.mart("gold_executive_summary").count() == 2
    with pytest.raises(ValueError):
        run_daily(spark, {}, root, DAY_1, "run-1", parts=["everything"])


# ---- quality -----------------------------------------------------------------------------


def test_declared_checks():
    kinds = [c.kind for checks in quality.ALL_CHECKS.values() for c in checks]
    assert len(kinds) == 91
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 71,
        "unique": 6,
        "accepted_values": 3,
        "accepted_range": 11,
    }


def test_checks_count_failures_and_only_errors_raise(spark):
    rows = spark.createDataFrame([(1, "a", 5), (1, "b", -1), (None, None, None), (2, "z", 11)], "id int, k string, v int")
    checks = [
        quality.unique("id"),
        *quality.not_null("id", "k"),
        quality.accepted_values("k", ["a", "b"]),
        quality.accepted_range("v", 0, 10, severity="warn"),
        quality.accepted_range("v", 5),
    ]
    report = quality.run_checks(rows, "t", checks)
    held = {(r.column_name, r.check_name, r.severity): r.failures for r in report.collect()}
    assert held == {
        ("id", "unique", "error"): 1,
        ("id", "not_null", "error"): 1,
        ("k", "not_null", "error"): 1,
        ("k", "accepted_values", "error"): 1,
        ("v", "accepted_range", "warn"): 2,
        ("v", "accepted_range", "error"): 1,
    }
    with pytest.raises(quality.QualityError, match="t.id unique: 1"):
        quality.enforce(report)
    only_warnings = quality.run_checks(rows, "t", [checks[4]])
    assert quality.enforce(only_warnings).count() == 1


def test_row_checks_share_one_scan(spark, tmp_path):
    spark.range(10).select("id", F.lit("x").alias("region"), F.lit(1).alias("recorded_at")).write.parquet(str(tmp_path / "t"))
    report = quality.run_checks(spark.read.parquet(str(tmp_path / "t")), "bronze_weather")
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_report_headers(spark, tmp_path):
    write_report(spark.createDataFrame([(1, "x")], "total_gen_twh int, state_code string"), str(tmp_path / "r"))
    (written,) = (tmp_path / "r").glob("*.csv")
    assert written.read_text().splitlines() == ["Total Gen Twh,State Code", "1,x"]


def test_repeated_numbers_are_found_by_their_bits(spark):
    ids = [*range(-40_000, 40_000, 7), 5, 5, 5, -1, 0, 1, 32_768, 32_769, 10**12, 10**12 + 1, 10**12, None, None, -40_000]
    rows = spark.createDataFrame([(i,) for i in ids], "id long").repartition(5)
    expected = sorted(v for v in {i for i in ids if i is not None} if ids.count(v) > 1)
    assert sorted(r["id"] for r in quality.repeated_values(rows, "id").collect()) == expected
    clean = quality.repeated_values(spark.range(100_000), "id")
    assert clean.count() == 0
    texts = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "id string")
    assert [r["id"] for r in quality.repeated_values(texts, "id").collect()] == ["a"]

