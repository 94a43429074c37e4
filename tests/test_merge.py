import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridmart.operators import loads, merge
from gridmart.operators.snapshots import first_per_key, last_per_key, newest_rows, newest_rows_per_key
from gridmart.sources import versions

SCHEMA = "k string, v int, t int"
TARGET_KEYS = ("k",)


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def held(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=lambda t: [(v is not None, v) for v in t])


def test_first_and_last_per_key(spark):
    rows = frame(spark, [("a", 1, 1), ("a", 2, 2), ("a", 3, 2), ("b", 4, None), ("b", 5, 9)])
    assert held(first_per_key(rows, ["k"], ["t"])) == [("a", 1, 1), ("b", 5, 9)]
    assert held(last_per_key(rows, ["k"], ["t"])) == [("a", 3, 2), ("b", 5, 9)]


def test_one_row_per_key_is_thinned_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"))
    plan = last_per_key(rows, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_newest_rows(spark):
    rows = frame(spark, [("a", 1, 1), ("a", 2, 3), ("b", 3, 3), ("b", 4, 2), ("c", 5, 1)])
    assert held(newest_rows(rows, "t")) == [("a", 2, 3), ("b", 3, 3)]
    assert held(newest_rows_per_key(rows, ["k"], "t")) == [("a", 2, 3), ("b", 3, 3), ("c", 5, 1)]


def test_insert_new_keeps_the_first_and_skips_loaded_keys(spark):
    existing = frame(spark, [("a", 0, 0), ("a", 0, 0)])
    delta = frame(spark, [("a", 1, 1), ("b", 2, 2), ("b", 1, 1), ("c", 3, 5)])
    assert held(merge.insert_new(delta, existing, ["k"], ["t"])) == [("b", 1, 1), ("c", 3, 5)]
    assert held(merge.insert_new(delta, existing, ["k"], ["t"], range_column="k")) == [("b", 1, 1), ("c", 3, 5)]


@pytest.mark.parametrize("small", [True, False])
def test_upsert_updates_inserts_and_adds_columns(spark, small):
    existing = frame(spark, [("a", 1, 1), ("b", 2, 1)])
    delta = frame(spark, [("b", 3, 2, "x"), ("b", 4, 3, "y"), ("c", 5, 2, "z")], SCHEMA + ", extra string")
    merged = merge.upsert(existing, delta, ["k"], ["t"], small_delta=small)
    assert sorted(merged.collect(), key=lambda r: r.k) == [("a", 1, 1, None), ("b", 4, 3, "y"), ("c", 5, 2, "z")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 9), st.integers(0, 3)), max_size=12),
    st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 9), st.integers(0, 3)), max_size=12),
)
def test_upsert_matches_a_dictionary_and_is_idempotent(spark, old, new):
    def newest(rows):
        kept = {}
        for row in sorted(rows, key=lambda r: (r[2], r[1])):
            kept[row[0]] = row
        return kept

    existing = frame(spark, list(newest(old).values()))
    delta = frame(spark, new)
    once = merge.upsert(existing, delta, ["k"], ["t"])
    expected = sorted((newest(old) | newest(new)).values())
    assert held(once) == expected
    assert held(merge.upsert(once, delta, ["k"], ["t"])) == expected
    assert held(merge.upsert(existing, delta, ["k"], ["t"], small_delta=True)) == expected


def test_watermark_is_strict_and_looks_back(spark):
    stamps = [(n, dt.datetime(2024, 1, n)) for n in range(1, 11)]
    source = spark.createDataFrame(stamps, "id int, ingested_at timestamp")
    target = source.filter("id <= 6")
    assert held(merge.since_watermark(source, target), "id") == [(7,), (8,), (9,), (10,)]
    assert merge.since_watermark(source, target, lookback_days=2).count() == 6
    assert merge.since_watermark(source, target.filter("id > 99")).count() == 10
    assert merge.since_watermark(source, None) is source


def test_watermark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select("id", F.timestamp_seconds(F.col("id")).alias("ingested_at")).write.parquet(path)
    source = spark.read.parquet(path)
    delta = merge.since_watermark(source, source.filter("id < 50"))
    assert delta.count() == 50
    plan = delta._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters" in plan and "ingested_at" in plan.split("DataFilters")[1]


# ---- stored tables -----------------------------------------------------------------------


def target(tmp_path, partition_by=None):
    return merge.MergeTarget(str(tmp_path / "table"), TARGET_KEYS, ("t",), partition_by)


@pytest.mark.parametrize("partition_by", [None, "p"])
def test_merge_table(spark, tmp_path, partition_by):
    schema = "k string, v int, t int, p string"
    place = merge.MergeTarget(str(tmp_path / "table"), ("p", "k"), ("t",), partition_by)
    assert merge.merge_table(spark, place, frame(spark, [("a", 1, 1, "x"), ("b", 2, 1, "y")], schema)) == 2
    assert merge.merge_table(spark, place, frame(spark, [("b", 3, 2, "y"), ("c", 4, 2, "y")], schema)) == 2
    assert merge.merge_table(spark, place, frame(spark, [], schema)) == 0
    rows = merge.existing_table(spark, place)
    assert held(rows, "k", "v", "t", "p") == [("a", 1, 1, "x"), ("b", 3, 2, "y"), ("c", 4, 2, "y")]


def test_untouched_partitions_keep_their_files(spark, tmp_path):
    schema = "k string, v int, t int, p string"
    place = merge.MergeTarget(str(tmp_path / "table"), ("p", "k"), ("t",), "p")
    merge.merge_table(spark, place, frame(spark, [("a", 1, 1, "x"), ("b", 2, 1, "y")], schema))
    before = {f.rsplit("/")[-1]: f for f in versions.current(spark, place.path).folders}
    merge.merge_table(spark, place, frame(spark, [("b", 3, 2, "y")], schema))
    after = {f.rsplit("/")[-1]: f for f in versions.current(spark, place.path).folders}
    assert before["p=x"] == after["p=x"] and before["p=y"] != after["p=y"]


def test_added_columns_read_null_in_older_partitions(spark, tmp_path):
    place = merge.MergeTarget(str(tmp_path / "table"), ("p", "k"), ("t",), "p")
    merge.merge_table(spark, place, frame(spark, [("a", 1, "x")], "k string, t int, p string"))
    merge.merge_table(spark, place, frame(spark, [("b", 2, "y", "new")], "k string, t int, p string, extra string"))
    assert held(merge.existing_table(spark, place), "k", "p", "extra") == [("a", "x", None), ("b", "y", "new")]


def test_ids_of_loads_are_dense_and_a_repeated_load_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    assert loads.append_load(spark, path, spark.range(1000, numPartitions=7).withColumnRenamed("id", "v"), "a") == 1000
    assert loads.append_load(spark, path, spark.range(10).withColumnRenamed("id", "v"), "b") == 10
    assert loads.append_load(spark, path, spark.range(0).withColumnRenamed("id", "v"), "c") == 0
    ids = [r["id"] for r in spark.read.parquet(path).collect()]
    assert sorted(ids) == list(range(1, 1011))
    assert loads.append_load(spark, path, spark.range(12).withColumnRenamed("id", "v"), "b") == 12
    rows = spark.read.parquet(path)
    assert rows.count() == rows.select("id").distinct().count() == 1012


def test_small_and_large_deltas_treat_null_keys_alike(spark):
    old, new = frame(spark, [(None, 1, 1), ("b", 1, 1)]), frame(spark, [(None, 2, 2), ("c", 1, 2)])
    small = held(merge.upsert(old, new, ["k"], ["t"], small_delta=True))
    assert small == held(merge.upsert(old, new, ["k"], ["t"]))
    assert len(small) == 3


def test_rows_of_a_null_partition_survive_a_merge(spark, tmp_path):
    place = merge.MergeTarget(str(tmp_path / "table"), ("p", "k"), ("t",), "p")
    columns = "k string, t int, p string"
    merge.merge_table(spark, place, frame(spark, [("a", 1, None), ("b", 1, "x")], columns))
    merge.merge_table(spark, place, frame(spark, [("c", 1, None)], columns))
    assert held(merge.existing_table(spark, place), "k", "p") == [("a", None), ("b", "x"), ("c", None)]


def test_watermark_is_recorded_and_never_falls(spark, tmp_path):
    place = target(tmp_path)
    assert merge.watermark(spark, place) is None
    for rows, newest in [([("a", 1, 5)], 5), ([("b", 1, 3)], 5), ([("c", 1, 9)], 9)]:
        merge.merge_table(spark, place, frame(spark, rows))
        assert held(merge.watermark(spark, place)) == [(newest,)]
    versions.replace(merge.existing_table(spark, place), place.path)
    assert held(merge.watermark(spark, place), "k") == [("a",), ("b",), ("c",)]
