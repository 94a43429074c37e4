import os

from samples import FORECAST, MARKET, land

from gridmart import schemas
from gridmart.sources import ledger


def test_files_are_taken_once_and_again_when_rewritten(spark, lake, tmp_path):
    path = land(tmp_path / "in", "a [1]", MARKET, MARKET)
    assert lake.load_landed(schemas.MARKET, path, "r1") == 2
    assert lake.load_landed(schemas.MARKET, path, "r2") == 0
    land(tmp_path / "in", "b", MARKET)
    assert lake.load_landed(schemas.MARKET, path, "r3") == 1
    land(tmp_path / "in", "b", MARKET, MARKET, MARKET)
    assert lake.load_landed(schemas.MARKET, path, "r4") == 3
    assert lake.raw_table(schemas.MARKET).count() == 6


def test_a_lost_load_leaves_its_files_to_the_next(spark, lake, tmp_path):
    path = land(tmp_path / "in", "a", MARKET)
    table = f"{lake.raw}/{schemas.MARKET}"
    ledger.record(ledger.new_files(spark, path, table), table, "batch-99")  # and the load never came
    assert lake.load_landed(schemas.MARKET, path, "r1") == 1
    assert lake.load_landed(schemas.MARKET, path, "r2") == 0


def test_files_without_a_row_to_store_are_not_read_for_ever(spark, lake, tmp_path):
    path = land(tmp_path / "in", "bad", MARKET | {"region": None})
    land(tmp_path / "in", "none")
    assert lake.load_landed(schemas.MARKET, path, "r1") == 0
    assert ledger.new_files(spark, path, f"{lake.raw}/{schemas.MARKET}").count() == 0
    empty = land(tmp_path / "forecasts", "a", FORECAST | {"forecast": []})
    assert lake.load_landed(schemas.FORECAST, empty, "r1") == 0
    assert ledger.new_files(spark, empty, f"{lake.raw}/{schemas.FORECAST}").count() == 0


def test_a_file_of_the_same_size_and_another_time_is_new(spark, lake, tmp_path):
    path = land(tmp_path / "in", "a", MARKET)
    assert lake.load_landed(schemas.MARKET, path, "r1") == 1
    os.utime(tmp_path / "in" / "a.json", (10**9, 10**9))
    assert lake.load_landed(schemas.MARKET, path, "r2") == 1
