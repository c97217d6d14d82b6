"""Segmented operators against plain windows, with cuts small enough to matter."""

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarn.functions.skew import dimension_join, hot_keys, salted_join
from tarn.operators import scans
from tarn.operators.aggregates import sessions
from tarn.operators.joins import asof_join
from tarn.operators.series import spikes


@pytest.fixture(scope="module")
def series(spark):
    """One key holds two thirds of the rows; one key is null; some values are null."""
    start = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    data = []
    for i in range(900):
        key = "hot" if i % 3 else ("cold" if i % 2 else None)
        value = None if i % 11 == 0 else float((i * 7919) % 101)
        data.append((i, key, start + dt.timedelta(minutes=17 * i), value))
    return spark.createDataFrame(data, "id long, k string, ts timestamp, v double").cache()


def per_key():
    return Window.partitionBy("k").orderBy("ts", "id")


def test_positions_number_rows_per_key(series):
    got = scans.with_positions(series, ["k"], ["ts", "id"], F.date_trunc("hour", "ts"))
    want = series.withColumn("_pos", F.row_number().over(per_key()) - 1)
    assert rows(got, "id", "_pos") == rows(want, "id", "_pos")


@pytest.mark.parametrize("block", [5, 64, 10_000])
def test_blocks_see_complete_frames(series, block):
    placed = scans.with_positions(series, ["k"], ["ts", "id"], F.date_trunc("day", "ts"))
    got = scans.over_blocks(
        placed,
        ["k"],
        {
            "s": lambda w: F.sum("v").over(w.rowsBetween(-4, -1)),
            "n": lambda w: F.lead("id", 3).over(w),
        },
        before=4,
        after=3,
        block=block,
    )
    want = series.withColumn("s", F.sum("v").over(per_key().rowsBetween(-4, -1))).withColumn(
        "n", F.lead("id", 3).over(per_key())
    )
    assert rows(got, "id", "s", "n") == rows(want, "id", "s", "n")


def test_frame_longer_than_block_is_refused(series):
    with pytest.raises(ValueError):
        scans.over_blocks(series, ["k"], {}, before=9, block=8)


@pytest.mark.parametrize("unit", ["hour", "month"])
def test_carry_forward(series, unit):
    got = scans.carry_forward(series, ["k"], "ts", "v", F.date_trunc(unit, "ts"), "f")
    upto = per_key().rowsBetween(Window.unboundedPreceding, 0)
    want = series.withColumn("f", F.last("v", ignorenulls=True).over(upto))
    assert rows(got, "id", "f") == rows(want, "id", "f")


def test_running_total(series):
    got = scans.running_total(series, ["k"], ["ts", "id"], F.col("v"), F.date_trunc("hour", "ts"), "t")
    want = series.withColumn(
        "t", F.coalesce(F.sum("v").over(per_key().rowsBetween(Window.unboundedPreceding, 0)), F.lit(0.0))
    )
    assert rows(got, "id", "t") == rows(want, "id", "t")


@pytest.mark.parametrize("unit", ["hour", "month"])
def test_previous_value(series, unit):
    got = scans.previous_value(series, ["k"], ["ts", "id"], "v", F.date_trunc(unit, "ts"), "p")
    assert rows(got, "id", "p") == rows(series.withColumn("p", F.lag("v").over(per_key())), "id", "p")


def test_segments_shrink_until_they_fit(series):
    _, wide = scans.time_segment(series, ["k"], "ts", rows=10_000)
    number, narrow = scans.time_segment(series, ["k"], "ts", rows=5)
    fullest = series.groupBy("k", number.alias("s")).count().agg(F.max("count")).first()[0]
    assert wide == 86_400_000_000 and narrow < wide and fullest <= 5


@pytest.mark.parametrize("most,bins", [(10**6, 1000), (7, 4), (3, 2)])
def test_quantiles_do_not_depend_on_narrowing(series, most, bins):
    wanted = {"lo": 0.0, "q1": 0.25, "med": 0.5, "p95": 0.95, "hi": 1.0}
    got = scans.exact_quantiles(series, ["k"], "v", wanted, most=most, bins=bins)
    want = series.groupBy("k").agg(*[F.percentile("v", F.lit(q)).alias(n) for n, q in wanted.items()])
    for g, w in zip(rows(got, "k", *wanted), rows(want, "k", *wanted), strict=True):
        assert g[0] == w[0] and g[1:] == pytest.approx(w[1:])


def test_quantiles_without_keys_and_of_copies(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, 1.0).otherwise(F.col("id").cast("double")).alias("v"))
    got = scans.exact_quantiles(df, [], "v", {"med": 0.5, "p95": 0.95}, most=10, bins=3).first()
    assert got["med"] == 1.0
    assert got["p95"] == pytest.approx(949.05)


def test_spikes_of_a_hot_key(series):
    got = spikes(series, ["k"], "ts", "id", "v", window=10, threshold=1.5, segment_rows=20)
    before = per_key().rowsBetween(-10, -1)
    want = series.withColumn(
        "z",
        F.when(
            F.count("v").over(before) == 10,
            F.try_divide(F.col("v") - F.avg("v").over(before), F.stddev_samp("v").over(before)),
        ),
    )
    for g, w in zip(rows(got, "id", "zscore"), rows(want, "id", "z"), strict=True):
        assert g[0] == w[0] and g[1] == pytest.approx(w[1])


def test_sessions_equal_session_window(series):
    kept = series.filter("id % 5 <> 0 AND k IS NOT NULL")
    got = sessions(kept, ["k"], "ts", "id", 40 * 60, segment_rows=4)
    want = kept.groupBy("k", F.session_window("ts", "40 minutes").alias("w")).agg(F.count("*").alias("n"))
    want = want.select("k", F.col("w.start").alias("session_start"), "n")
    assert rows(got, "k", "session_start", "n") == rows(want, "k", "session_start", "n")


@pytest.mark.parametrize("segment_rows,salts", [(1, 3), (10**6, 8)])
def test_asof_join_equals_brute_force(spark, series, segment_rows, salts):
    facts = series.filter("k IS NOT NULL").select("id", "k", "ts")
    rates = series.filter("k = 'hot' AND id % 40 = 1").select("k", (F.col("ts") + F.expr("INTERVAL 5 MINUTES")).alias("at"), "v")
    got = asof_join(facts, rates, ["k"], "ts", "at", "v", "rate", segment_rows, salts)
    known = sorted((r["at"], r["v"]) for r in rates.dropna().collect())
    every = sorted((r["at"], r["v"]) for r in rates.fillna(-1.0, ["v"]).collect())
    want = []
    for r in facts.collect():
        past = [v for at, v in known if at <= r["ts"]] if r["k"] == "hot" else []
        want.append((r["id"], past[-1] if past else None))
    assert len(every) > 10
    assert rows(got, "id", "rate") == sorted(want, key=repr)


def test_salted_join_equals_plain_join(spark, series):
    dim = spark.createDataFrame([("hot", 1), ("other", 2)], "k string, d int")
    assert [r["k"] for r in hot_keys(series, ["k"], 0.5).collect()] == ["hot"]
    for how in ("left", "inner", "left_semi", "left_anti"):
        got = salted_join(series, dim, ["k"], how, salts=7, share=0.5)
        want = series.join(dim, "k", how)
        assert rows(got.select(want.columns)) == rows(want)
        assert got.columns[: len(series.columns)] == series.columns


def test_dimension_join_beyond_the_bound(series, spark):
    dim = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, d int")
    got = dimension_join(series, dim, ["k"], max_rows=1)
    assert "_salt" in got._jdf.queryExecution().optimizedPlan().toString()
    assert rows(got, "id", "d") == rows(series.join(dim, "k", "left"), "id", "d")
