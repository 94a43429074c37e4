"""What the landing queries write and shuffle on their way, over rows of their own."""

import datetime as dt
from pathlib import Path

import pytest

from gridmart.session import shared_folder
from proving import adapters, queries

LINES = """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
    l_linestatus string, l_shipdate timestamp"""
EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Rows of many pages, one row twice, one without a key."""
    at, place = dt.datetime(1996, 9, 13), str(tmp_path_factory.mktemp("landed"))
    lines = [(k, k * 7, k * 3, k % 7 + 1, float(k % 50 + 1), "FO"[k % 2], at) for k in range(4000)]
    lines += [lines[5], (None, 1, 2, 3, 4.0, "F", at)]
    spark.createDataFrame(lines, LINES).repartition(4).write.parquet(f"{place}/lineitem.parquet")
    events = [(k, at, k * 5, "click", k % 400 / 2) for k in range(4000)]
    spark.createDataFrame(events, EVENTS).write.parquet(f"{place}/events.parquet")
    return place


def landed_files(spark, label):
    """The files of the newest landing of a query."""
    place = max(Path(shared_folder(spark)).glob(f"{label}-*"), key=lambda p: p.stat().st_mtime)
    return [p for p in place.rglob("part-*") if p.suffix in (".txt", ".gz")]


def raw_rows(spark, folder, table, *without):
    return queries.exported(adapters.raw(spark, folder, table).drop("id", "ingested_at", *without))


def same_rows(left, right):
    return sorted(map(str, left.select(*right.columns).collect())) == sorted(map(str, right.collect()))


def test_landed_pages_are_small_and_whole(spark, folder, monkeypatch):
    monkeypatch.setattr(queries, "PAGES_PER_FILE", 20, raising=False)
    read = queries.queries()["s7_landed_pages"](spark, folder)
    assert same_rows(read, raw_rows(spark, folder, queries.schemas.GENERATION))
    files = landed_files(spark, "s7")
    assert sum(p.stat().st_size for p in files) < 40 * 4002  # as plain text 230 bytes a row
    assert len(files) >= 161 / 20


def test_landed_readings_are_small_and_whole(spark, folder, monkeypatch):
    monkeypatch.setattr(queries, "READINGS_PER_FILE", 500, raising=False)
    read = queries.queries()["s8_landed_readings"](spark, folder)
    assert same_rows(read, raw_rows(spark, folder, queries.schemas.MARKET))
    files = landed_files(spark, "s8")
    assert sum(p.stat().st_size for p in files) < 60 * 4000  # as plain text 220 bytes a row
    assert len(files) >= 8


def test_pages_are_collected_after_their_only_shuffle(spark, folder):
    pages = queries._generation_pages(adapters.raw(spark, folder, queries.schemas.GENERATION))
    text = pages._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1
    assert text.rindex("collect_list") < text.index("Exchange")
