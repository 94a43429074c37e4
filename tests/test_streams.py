import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from samples import FORECAST, GENERATION, MARKET, envelope, land

from gridmart import schemas
from gridmart.operators import merge
from gridmart.plans import silver
from gridmart.sources import landing
from gridmart.streaming import readings as streams


def market(hour, spot, **other):
    return MARKET | {"recorded_at": f"2024-01-01T{hour:02d}:00:00Z", "spot_price_usd_mwh": spot} | other


def landing_stream(spark, table, path):
    return streams.stream_landing(spark, landing.READING_SCHEMAS[table], path)


def stored(spark, place):
    rows = merge.existing_table(spark, place).collect()
    return {(r.region, r.reading_date.day): (r.avg_spot_price_usd_mwh, r.reading_count) for r in rows}


def test_readings_are_appended_once(spark, tmp_path):
    source, table, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "checkpoint")
    land(source, "1", market(1, 10.0), market(2, "many"))

    def run():
        documents = landing_stream(spark, schemas.MARKET, str(source))
        streams.append_readings(streams.landed_readings(documents, schemas.MARKET), table, checkpoint)
        return spark.read.parquet(table).count()

    assert run() == 1
    assert run() == 1
    land(source, "2", market(3, 30.0))
    assert run() == 2


def test_daily_rows_follow_the_readings(spark, tmp_path):
    source, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    place = merge.MergeTarget(str(tmp_path / "daily"), ("region", "reading_date"))

    def run():
        rows = streams.landed_readings(landing_stream(spark, schemas.MARKET, str(source)), schemas.MARKET)
        streams.keep_merged(streams.daily_market_stream(rows), place, checkpoint)
        return stored(spark, place)

    land(source, "1", market(1, 10.0), market(2, 20.0), market(1, 7.0, region="SPP"))
    assert run() == {("ERCOT", 1): (15, 2), ("SPP", 1): (7, 1)}
    # a later batch for the same day counts its earlier readings too
    land(source, "2", market(0, 60.0))
    assert run() == {("ERCOT", 1): (30, 3), ("SPP", 1): (7, 1)}


def test_daily_stream_equals_the_batch_model(spark, tmp_path):
    source = land(tmp_path / "in", "1", *[market(h, 10.0 + h * h) for h in range(24)])
    place = merge.MergeTarget(str(tmp_path / "daily"), ("region", "reading_date"))
    rows = streams.landed_readings(landing_stream(spark, schemas.MARKET, source), schemas.MARKET)
    streams.keep_merged(streams.daily_market_stream(rows, late_by="2 days"), place, str(tmp_path / "c"))
    batch = landing.accepted(
        landing.normalise_readings(landing.read_readings(spark, schemas.MARKET, source), schemas.MARKET)
    )
    expected = silver.daily_market(landing.stamped(batch)).drop("ingested_at")
    held = merge.existing_table(spark, place).select(*expected.columns)
    assert held.collect() == expected.collect()


def test_replayed_batch_changes_nothing(spark, tmp_path):
    place = merge.MergeTarget(str(tmp_path / "daily"), ("region", "reading_date"))
    schema = "region string, reading_date date, avg_spot_price_usd_mwh decimal(28,4), reading_count bigint, ingested_at timestamp"
    batch = spark.createDataFrame([("PJM", dt.date(2024, 1, 1), Decimal(5), 2, dt.datetime(2024, 1, 2))], schema)
    for _ in range(2):
        merge.merge_table(spark, place, batch)
    assert stored(spark, place) == {("PJM", 1): (5, 2)}


def test_stateless_refresh_takes_readings_of_any_age(spark, tmp_path):
    source, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    place = merge.MergeTarget(str(tmp_path / "daily"), ("region", "reading_date"))
    model = silver.MODELS["silver_market_aggregated"]

    def run():
        rows = streams.landed_readings(landing_stream(spark, schemas.MARKET, str(source)), schemas.MARKET)
        streams.refresh_days_stream(rows, model, schemas.MARKET, str(tmp_path / "raw"), place, checkpoint)
        return stored(spark, place)

    land(source, "1", market(1, 10.0), market(1, 9.0, recorded_at="2024-01-20T00:00:00Z"))
    assert run() == {("ERCOT", 1): (10, 1), ("ERCOT", 20): (9, 1)}
    land(source, "2", market(2, 20.0))
    assert run() == {("ERCOT", 1): (15, 2), ("ERCOT", 20): (9, 1)}


def test_repeats_are_suppressed_across_batches(spark, tmp_path):
    source, root, checkpoint = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "checkpoint")

    def run():
        pages = streams.stream_landing(spark, landing.PAGE_SCHEMA, str(source))
        records = pages.select(F.posexplode("response.data").alias("pos", "record"))
        rows = landing.stamped(landing.accepted(landing.normalise_generation(records)))
        streams.insert_new_stream(rows, schemas.GENERATION, root, ["pos"], checkpoint)
        return spark.read.parquet(f"{root}/{schemas.GENERATION}").collect()

    land(source, "1", envelope(GENERATION, GENERATION | {"generation": "1"}))
    assert [r.generation_mwh for r in run()] == [Decimal("52000.5000")]
    land(source, "2", envelope(GENERATION | {"generation": "2"}, GENERATION | {"period": "2024-02"}))
    rows = run()
    assert sorted((r.period, r.generation_mwh) for r in rows) == [
        ("2024-01", Decimal("52000.5000")),
        ("2024-02", Decimal("52000.5000")),
    ]
    assert len({r.id for r in rows}) == 2


def test_repeats_within_a_watermark(spark, tmp_path):
    source = land(tmp_path / "in", "1", market(1, 10.0), market(1, 10.0), market(2, 10.0))
    rows = streams.landed_readings(landing_stream(spark, schemas.MARKET, source), schemas.MARKET)
    distinct = streams.distinct_within(rows, ["region", "recorded_at"], "recorded_at", "1 hour")
    streams.append_readings(distinct, str(tmp_path / "table"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 2


def test_forecast_stream(spark, tmp_path):
    source = land(tmp_path / "in", "1", FORECAST, FORECAST | {"forecast": []})
    documents = streams.stream_landing(spark, landing.DEMAND_FORECAST_SCHEMA, source)
    streams.append_readings(streams.landed_forecasts(documents), str(tmp_path / "table"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 2
