"""Properties of physical plans that matter on large data."""

import re

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tarn.functions.skew import BROADCAST_ROWS, dimension_join, fits_broadcast
from tarn.operators.aggregates import latest_per_key
from tarn.operators.scans import with_positions
from tarn.operators.series import below_quartile, resample
from tarn.plans.bindings import QUERIES
from tarn.plans.bindings.registry import events, table

# these train models, run streams or write many tables before they return a plan
SLOW = ("ml", "str", "vec2", "join9")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_pairwise_join(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["agg2_latest_per_key", "val7_deduplicate", "sql5_top_per_group"])
def test_rank_filters_run_before_the_shuffle(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(table(spark, sf, "lineitem").filter("l_quantity > 40").groupBy("l_returnflag").agg(F.sum("l_tax")))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,40.0)]" in text
    assert "ReadSchema: struct<l_quantity:double,l_tax:double,l_returnflag:string>" in text


def test_hourly_flag_reads_three_columns_and_shuffles_twice(spark, sf):
    hourly = resample(events(spark, sf), ["event_type"], "ts", "value")
    text = plan(below_quartile(hourly, ["event_type"], "timestamp_hour", "value", "flag"))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text
    assert text.count("Exchange hashpartitioning") == 2 and "partial_avg" in text


def test_positions_shuffle_the_rows_once(spark, sf):
    df = events(spark, sf)
    text = plan(with_positions(df, ["event_type"], ["ts", "event_id"], F.date_trunc("day", "ts")))
    assert "Join" not in text
    # rows once; the summary once to count and once to add up
    assert text.count("Exchange hashpartitioning") == 3


def test_latest_row_is_one_shuffle(spark, sf):
    text = plan(latest_per_key(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"]))
    assert text.count("Exchange hashpartitioning") == 1


def test_small_side_is_broadcast_and_large_side_is_not(spark, sf):
    facts = table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    part = table(spark, sf, "part")
    assert fits_broadcast(part) and not fits_broadcast(part, max_rows=10) and not fits_broadcast(part, max_bytes=10)
    assert not fits_broadcast(spark.range(BROADCAST_ROWS + 1))
    assert "BroadcastHashJoin" in plan(dimension_join(facts, part, ["p_partkey"]))
    assert "_salt" in plan(dimension_join(facts, part, ["p_partkey"], max_rows=10))


def test_sketches_are_kept_per_group_and_not_per_distinct_value(spark, folder):
    """400 orders of 3 lines and 40 parts under each of two flags, copies and nulls."""
    lines = [(o, p, flag, 1000.0 + o) for flag in "AB" for o in range(400) for p in (o % 40, (o + 1) % 40, o % 40)]
    lines += [(None, 0, "A", None), (0, None, "A", 1200.0), (7, 7, "C", 5.0), (7, 7, "C", 5.0)]
    columns = "l_orderkey long, l_partkey long, l_returnflag string, l_extendedprice double"
    spark.createDataFrame(lines, columns).write.parquet(f"{folder}/lineitem.parquet")
    df = QUERIES["sql15_approximate"](spark, folder)
    sketched = [line for line in plan(df).splitlines() if "approx_count_distinct" in line or "hll_sketch_agg" in line]
    assert sketched and all(re.search(r"keys?=\[l_returnflag#\d+\]", line) for line in sketched)
    assert rows(df) == [("A", 400, 40, True, True, True), ("B", 400, 40, True, True, True), ("C", 1, 1, True, True, True)]


def test_no_python_in_the_core(spark, sf):
    for name in [n for n in QUERIES if not n.startswith((*SLOW, "vec", "ext"))]:  # vector scores and the landed source
        text = plan(QUERIES[name](spark, sf))
        assert "Python" not in text and "Pandas" not in text, name
