"""Shapes of the physical plans that matter at scale."""

import pytest

from proving.queries import queries

FOLDER = "/root/testdata/sf0.001"
QUERIES = queries()
STREAMED = [n for n in QUERIES if n.startswith("x")]


def plan(spark, name):
    df = QUERIES[name](spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STREAMED])
def test_no_query_pairs_rows_or_leaves_the_jvm(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert operator not in text


@pytest.mark.parametrize("name", ["g1_generation_cleaned", "g2_prices_cleaned", "e1_price_signal", "e2_carbon_category", "e3_fallback", "l1_normalise", "l8_flatten", "d7_reading_bounds"])
def test_row_queries_do_not_shuffle_rows(spark, name):
    # the price adapter itself aggregates, so one exchange stands below its cleaning
    assert plan(spark, name).count("Exchange hashpartitioning") == (1 if name == "g2_prices_cleaned" else 0)


def test_fuel_mart_sums_before_it_joins(spark):
    text = plan(spark, "g6_generation_by_fuel")
    generation = text.index("partial_sum(generation_mwh")
    assert text.index("BroadcastHashJoin") < generation < text.index("l_partkey", generation)
    assert text.count("FileScan parquet") == 2


def test_each_table_is_read_with_its_own_columns(spark):
    text = plan(spark, "g3_weather_daily")
    schema = text.split("ReadSchema: ")[1]
    assert "props" not in schema.split(">")[0]


def test_page_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan(spark, "s10_page")


@pytest.mark.parametrize("name", ["u1_upsert", "l5_insert_new", "l7_audit_state"])
def test_picked_rows_are_thinned_before_the_shuffle(spark, name):
    assert plan(spark, name).count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["g3_weather_daily", "g4_market_daily", "r6_audit_summary", "s16_factors", "d_bronze_quality"])
def test_aggregates_are_hashed(spark, name):
    text = plan(spark, name)
    assert "HashAggregate" in text and "SortAggregate" not in text
