import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from samples import CARBON, FORECAST, GENERATION, MARKET, PRICE, WEATHER, envelope, land

from gridmart import schemas
from gridmart.sources import landing


def without(record, *names):
    return {k: v for k, v in record.items() if k not in names}


def generation(spark, tmp_path, *records):
    path = land(tmp_path / "pages", "page", envelope(*records))
    return landing.normalise_generation(landing.read_pages(spark, path), request_id="r1")


def prices(spark, tmp_path, *records):
    path = land(tmp_path / "pages", "page", envelope(*records))
    return landing.normalise_prices(landing.read_pages(spark, path))


def test_pages_unfold_in_order(spark, tmp_path):
    land(tmp_path / "p", "page-1", envelope(GENERATION, GENERATION | {"period": "2024-02"}), envelope())
    path = land(tmp_path / "p", "page-2", envelope(GENERATION | {"period": "2024-03"}), {"response": {}}, {})
    rows = landing.read_pages(spark, path).orderBy(*landing.ARRIVAL).collect()
    assert [r.record["period"] for r in rows] == ["2024-01", "2024-02", "2024-03"]


def test_files_arrive_by_their_time_then_by_number(spark, tmp_path):
    for name, period, at in [("page-10", "2024-10", 5), ("page-2", "2024-02", 5), ("page-1", "2024-01", 9), ("z", "2024-12", 1)]:
        land(tmp_path / "p", name, envelope(GENERATION | {"period": period}))
        os.utime(tmp_path / "p" / f"{name}.json", (at, at))
    rows = landing.read_pages(spark, str(tmp_path / "p")).orderBy(*landing.ARRIVAL).collect()
    assert [r.record["period"] for r in rows] == ["2024-12", "2024-02", "2024-10", "2024-01"]


def test_pretty_printed_page(spark, tmp_path):
    (tmp_path / "page.json").write_text(json.dumps(envelope(GENERATION), indent=2))
    assert landing.read_pages(spark, str(tmp_path), multi_line=True).count() == 1


def test_generation_row(spark, tmp_path):
    row = landing.accepted(generation(spark, tmp_path, GENERATION)).first()
    assert (row.period, row.state_code, row.sector_id, row.fuel_type_code) == ("2024-01", "TX", "99", "NG")
    assert row.generation_mwh == Decimal("52000.5000")
    assert (row.generation_units, row.source, row.api_request_id) == ("thousand megawatthours", "eia_api", "r1")


@pytest.mark.parametrize(
    ("record", "column", "expected"),
    [
        (GENERATION | {"location": "", "stateid": "CA"}, "state_code", "CA"),
        (without(GENERATION, "location") | {"stateid": "CA"}, "state_code", "CA"),
        (without(GENERATION, "location"), "state_code", ""),
        (without(GENERATION, "sectorid") | {"sectorId": "RES"}, "sector_id", "RES"),
        (without(GENERATION, "fueltypeid") | {"fuelTypeId": "SUN"}, "fuel_type_code", "SUN"),
        (GENERATION | {"stateDescription": "", "locationDescription": "Lone Star"}, "state_description", "Lone Star"),
        (GENERATION | {"generation": 12}, "generation_mwh", Decimal("12.0000")),
        (GENERATION | {"generation": "-3.5"}, "generation_mwh", Decimal("-3.5000")),
        (GENERATION | {"generation": None}, "generation_mwh", None),
        (without(GENERATION, "generation"), "generation_mwh", None),
    ],
)
def test_field_spellings_and_gaps(spark, tmp_path, record, column, expected):
    rows = landing.accepted(generation(spark, tmp_path, record)).collect()
    assert [r[column] for r in rows] == [expected]


@pytest.mark.parametrize(
    ("record", "reason"),
    [
        (without(GENERATION, "period"), "bad period"),
        (GENERATION | {"period": "2024"}, "bad period"),
        (GENERATION | {"generation": "abc"}, "bad generation"),
        (GENERATION | {"generation": ""}, "bad generation"),
        (GENERATION | {"location": "TOOLONG"}, "state_code too long"),
        (GENERATION | {"period": "x", "generation": "y"}, "bad period; bad generation"),
    ],
)
def test_malformed_rows_are_set_aside(spark, tmp_path, record, reason):
    rows = generation(spark, tmp_path, GENERATION, record)
    assert landing.accepted(rows).count() == 1
    assert [r.reject_reason for r in landing.rejected(rows).collect()] == [reason]


def test_strict_fails_the_batch(spark, tmp_path):
    rows = generation(spark, tmp_path, GENERATION, GENERATION | {"generation": "abc"})
    with pytest.raises(Exception, match="bad generation"):
        landing.strict(rows).collect()
    assert landing.strict(generation(spark, tmp_path, GENERATION)).count() == 1


def test_price_row(spark, tmp_path):
    row = landing.accepted(prices(spark, tmp_path, PRICE | {"customers": "12.9"})).first()
    assert row.price_cents_per_kwh == Decimal("9.7500")
    assert row.customers == 12
    assert landing.accepted(prices(spark, tmp_path, PRICE | {"customers": "-12.9"})).first().customers == -12
    assert landing.accepted(prices(spark, tmp_path, without(PRICE, "customers"))).first().customers is None


@pytest.mark.parametrize("field", ["price", "revenue", "sales", "customers"])
def test_price_numbers_must_parse(spark, tmp_path, field):
    assert landing.rejected(prices(spark, tmp_path, PRICE | {field: "n/a"})).count() == 1


@pytest.mark.parametrize(
    ("table", "reading"), [(schemas.WEATHER, WEATHER), (schemas.CARBON, CARBON), (schemas.MARKET, MARKET)]
)
def test_readings_take_the_raw_types(spark, tmp_path, table, reading):
    path = land(tmp_path / "r", "a", reading)
    rows = landing.normalise_readings(landing.read_readings(spark, table, path), table)
    good = landing.accepted(rows)
    types = {f.name: f.dataType for f in schemas.raw_schema(table)}
    assert all(types[f.name] == f.dataType for f in good.schema)
    assert good.first().recorded_at == dt.datetime(2024, 1, 1, 10)
    assert good.first().source == "enrichment_api"


@pytest.mark.parametrize(
    ("table", "reading", "reason"),
    [
        (schemas.WEATHER, WEATHER | {"humidity_pct": 101}, "humidity_pct out of bounds"),
        (schemas.WEATHER, WEATHER | {"temperature_c": "hot"}, "bad temperature_c"),
        (schemas.WEATHER, without(WEATHER, "region"), "no region"),
        (schemas.CARBON, CARBON | {"direct_co2_per_mwh": -1}, "direct_co2_per_mwh out of bounds"),
        (schemas.MARKET, MARKET | {"demand_mw": -0.5}, "demand_mw out of bounds"),
        (schemas.MARKET, MARKET | {"recorded_at": "yesterday"}, "bad recorded_at"),
    ],
)
def test_bad_readings(spark, tmp_path, table, reading, reason):
    path = land(tmp_path / "r", "a", reading)
    rows = landing.normalise_readings(landing.read_readings(spark, table, path), table)
    assert [r.reject_reason for r in landing.rejected(rows).collect()] == [reason]


def test_forecast_points(spark, tmp_path):
    documents = [FORECAST, FORECAST | {"forecast": []}, without(FORECAST, "forecast")]
    path = land(tmp_path / "f", "a", *documents)
    rows = landing.accepted(landing.normalise_demand_forecast(landing.read_forecasts(spark, path)))
    first, second = rows.orderBy("forecast_hour").collect()
    assert (first.forecast_demand_mw, first.temperature_c, first.confidence_pct) == (
        Decimal("90000.50"),
        Decimal("21.50"),
        Decimal("99.00"),
    )
    assert (second.temperature_c, second.confidence_pct) == (None, None)
    assert first.recorded_at == second.recorded_at == dt.datetime(2024, 1, 1, 10)


def test_weather_forecast_unfolds_like_any_other(spark, tmp_path):
    point = without(WEATHER, "region", "recorded_at") | {"forecast_hour": "2024-01-02T00:00:00Z", "precipitation_mm": 0.4}
    document = {"region": "SPP", "generated_at": "2024-01-01T10:00:00Z", "forecast_hours": 1, "forecast": [point]}
    path = land(tmp_path / "f", "a", document)
    row = landing.flatten_forecast(landing.read_forecasts(spark, path, landing.WEATHER_FORECAST_SCHEMA)).first()
    assert (row.region, row.precipitation_mm, row.weather_condition) == ("SPP", "0.4", WEATHER["weather_condition"])


def test_out_of_bounds_names_the_columns(spark):
    schema = "id int, wind_speed_ms int, solar_irradiance_wm2 int, humidity_pct int, cloud_cover_pct int"
    rows = spark.createDataFrame([(1, 0, 0, 0, 100), (2, -1, 0, 101, 5), (3, None, None, None, None)], schema)
    broken = landing.out_of_bounds(rows, schemas.WEATHER).collect()
    assert [(r.id, r.broken) for r in broken] == [(2, "wind_speed_ms; humidity_pct")]


def test_contract(spark):
    empty = spark.createDataFrame([], schemas.RAW_TABLES[schemas.MARKET])
    assert schemas.check_contract(empty, schemas.MARKET) is empty
    changed = empty.drop("region").withColumn("demand_mw", empty.demand_mw.cast("double"))
    assert schemas.contract_violations(changed, schemas.MARKET) == [
        "enrichment_market_prices.region: missing",
        "enrichment_market_prices.demand_mw: double instead of decimal(12,2)",
    ]
    with pytest.raises(ValueError):
        schemas.check_contract(changed, schemas.MARKET)
