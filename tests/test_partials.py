import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridmart import schemas
from gridmart.plans import partials, silver
from gridmart.sources import versions

START = dt.datetime(2024, 1, 30)


def readings(spark, table, n, seed):
    """Random readings of a few regions and days, with gaps."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        row = {}
        for f in schemas.raw_schema(table):
            kind = f.dataType.typeName()
            if f.name == "id":
                row[f.name] = seed * 100_000 + k
            elif f.name == "region":
                row[f.name] = rng.choice(["PJM", "SPP", None])
            elif f.name == "fuel_type":
                row[f.name] = rng.choice([" Coal ", "wind", None])
            elif f.name == "carbon_intensity_category":
                row[f.name] = rng.choice(["low", "high", None])
            elif f.name == "ingested_at":
                row[f.name] = START + dt.timedelta(days=100 + seed)
            elif kind.startswith("timestamp"):
                row[f.name] = START + dt.timedelta(hours=6 * rng.randint(0, 20))
            elif kind == "decimal":
                row[f.name] = rng.choice([None, Decimal(rng.randint(-500, 5000)) / 100, Decimal(0)])
            else:
                row[f.name] = "x"
        rows.append(row)
    return spark.createDataFrame(rows, schemas.raw_schema(table))


def held(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("name", partials.NAMES)
def test_loads_add_up_to_the_whole_model(spark, tmp_path, name):
    table = {"silver_weather_aggregated": schemas.WEATHER, "silver_market_aggregated": schemas.MARKET}.get(name, schemas.CARBON)
    model, path, place = partials.models()[name], str(tmp_path / "p"), str(tmp_path / "t")
    parts = [readings(spark, table, n, seed) for seed, n in enumerate((60, 1, 40, 0, 25), 1) if n] + [readings(spark, table, 3, 9).filter("false")]
    for k, part in enumerate(parts):
        partials.take_in(spark, model, path, part)
        if k % 2:
            partials.show(spark, model, path, place)
    partials.show(spark, model, path, place)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    expected = silver.MODELS[name].build(whole)
    assert held(versions.read(spark, place).select(*expected.columns)) == held(expected)
    mark = partials.watermark(spark, path).first()[0]
    assert mark == max(r[0] for r in whole.filter("region is not null").select("ingested_at").collect())


def test_only_the_months_of_a_load_are_written(spark, tmp_path):
    model, path, place = partials.models()["silver_market_aggregated"], str(tmp_path / "p"), str(tmp_path / "t")
    rows = readings(spark, schemas.MARKET, 80, 1)
    partials.take_in(spark, model, path, rows)
    partials.show(spark, model, path, place)
    before = {versions.partition_of(f): f for f in versions.current(spark, place).folders}
    partials.take_in(spark, model, path, rows.filter(F.month("recorded_at") == 2))
    assert partials.show(spark, model, path, place) == 1
    after = {versions.partition_of(f): f for f in versions.current(spark, place).folders}
    assert before["reading_month=2024-01"] == after["reading_month=2024-01"]
    assert before["reading_month=2024-02"] != after["reading_month=2024-02"]


def test_a_replayed_batch_is_left_out_and_a_lost_table_is_caught_up(spark, tmp_path):
    model, path, place = partials.models()["silver_market_aggregated"], str(tmp_path / "p"), str(tmp_path / "t")
    rows = readings(spark, schemas.MARKET, 50, 1)
    partials.take_in(spark, model, path, rows, ("s", 0))
    partials.show(spark, model, path, place)
    first = held(versions.read(spark, place))
    assert partials.take_in(spark, model, path, rows, ("s", 0)) == 0
    assert partials.show(spark, model, path, place) == 0 and held(versions.read(spark, place)) == first
    # a batch that was added but not shown, the run having died in between
    partials.take_in(spark, model, path, rows, ("s", 1))
    partials.take_in(spark, model, path, rows.filter("false"), ("s", 2))
    assert partials.take_in(spark, model, path, rows, ("s", 2)) == 0
    partials.show(spark, model, path, place)
    counts = {r["n"] for r in versions.read(spark, place).select(F.col("reading_count").alias("n")).collect()}
    assert all(n % 2 == 0 for n in counts)
    # the version that the table shows is gone: all months are finished again
    versions.clean(spark, path, keep_seconds=-1)
    partials.take_in(spark, model, path, rows, ("s", 3))
    versions.clean(spark, path, keep_seconds=-1)
    partials.show(spark, model, path, place)
    doubled = held(versions.read(spark, place))
    expected = silver.daily_market(rows.union(rows).union(rows))
    assert doubled == held(expected.select(*versions.read(spark, place).columns))
