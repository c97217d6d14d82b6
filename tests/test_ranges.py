"""Joins of intervals with points against every pair, and sketches against exact values."""

import datetime as dt
import math
import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tarn.operators import sketches
from tarn.operators.ranges import dealt_points, equal_depth_edges, range_join, range_totals, with_bin

NAN, INF = float("nan"), float("inf")


def skewed(pick, n):
    """A third of the points have one value; the rest is dense near 0, and some have none."""
    some = [7.0] * (n // 3) + [round(pick.expovariate(0.1), 1) for _ in range(n // 2)] + [pick.uniform(-1e6, 1e6) for _ in range(n // 10)]
    return some + [None, NAN, INF, -INF, 0.0, -0.0]


def inside(low, high, at):
    """As Spark orders doubles: not-a-number is above all."""
    above = lambda x: (1, 0) if math.isnan(x) else (0, x)
    return None not in (low, high, at) and above(low) <= above(at) <= above(high)


def spans(pick, n):
    made = [(a, a + pick.choice([0, 0.5, 10, 1e6])) for a in (round(pick.uniform(-20, 40), 1) for _ in range(n))]
    return made + [(7.0, 7.0), (-INF, INF), (None, 3.0), (3.0, None), (9.0, 2.0), (8.0, NAN), (NAN, NAN), (7.0, 7.0)]


@pytest.mark.parametrize("bin_rows,most", [(10, 4096), (100, 4), (10**6, 4096)])
def test_every_pair(spark, bin_rows, most):
    pick = random.Random(3)
    points = [(k, k % 3, v) for k, v in enumerate(skewed(pick, 200))]
    bands = [(k, k % 3, a, b) for k, (a, b) in enumerate(spans(pick, 25))]
    left = spark.createDataFrame(bands, "b long, `k 1` int, low double, high double")
    right = spark.createDataFrame(points, "p long, `k 1` int, at double").repartition(4)
    got = range_join(left, right, "low", "high", "at", ["k 1"], bin_rows, most)
    want = [(b, p) for b, k, low, high in bands for p, j, at in points if j == k and inside(low, high, at)]
    assert rows(got, "b", "p") == sorted(want, key=repr)
    anyone = range_join(left.drop("k 1"), right.drop("k 1"), "low", "high", "at", (), bin_rows, most)
    assert rows(anyone, "b", "p") == sorted([(b, p) for b, _, low, high in bands for p, _, at in points if inside(low, high, at)], key=repr)


@pytest.mark.parametrize("bin_rows", [10, 10**6])
def test_totals(spark, bin_rows):
    pick = random.Random(4)
    points = [(v, pick.choice([None, pick.randrange(-50, 50)])) for v in skewed(pick, 300)]
    bands = [(k, a, b) for k, (a, b) in enumerate(spans(pick, 40))]
    left = spark.createDataFrame(bands, "b long, low double, high double")
    right = spark.createDataFrame(points, "at double, amount long")
    got = range_totals(left, right, "low", "high", "at", {"n": F.lit(1), "total": F.col("amount")}, bin_rows)
    want = [
        (b, sum(inside(low, high, at) for at, _ in points), sum(x or 0 for at, x in points if inside(low, high, at)))
        for b, low, high in bands
    ]
    assert rows(got, "b", "n", "total") == sorted(want, key=repr)


def test_days_and_texts_of_time(spark):
    start = dt.date(2024, 1, 1)
    points = spark.createDataFrame([(start + dt.timedelta(k % 50),) for k in range(300)], "day date")
    bands = spark.createDataFrame([(1, start, start + dt.timedelta(9)), (2, dt.date(2020, 1, 1), dt.date(2030, 1, 1))], "b int, low date, high date")
    assert rows(range_totals(bands, points, "low", "high", "day", {"n": F.lit(1)}, 20), "b", "n") == [(1, 60), (2, 300)]
    assert range_join(bands, points, "low", "high", "day", (), 20).groupBy("b").count().orderBy("b").collect()[1]["count"] == 300
    times = [c.cast("timestamp") for c in (F.col("low"), F.col("high"))]
    stamped = range_join(bands.select("b", times[0].alias("low"), times[1].alias("high")), points.select(F.col("day").cast("timestamp").alias("t")), "low", "high", "t", (), 20)
    assert stamped.count() == 360


def test_nothing(spark):
    points, bands = spark.createDataFrame([(1.0,)], "at double"), spark.createDataFrame([(1, 0.0, 2.0)], "b int, low double, high double")
    none = points.filter("at > 5")
    assert range_join(bands, none, "low", "high", "at").collect() == range_join(bands.filter("b > 1"), points, "low", "high", "at").collect() == []
    assert rows(range_totals(bands, none, "low", "high", "at", {"n": F.lit(1)}), "n") == [(0,)]
    assert range_totals(bands.filter("b > 1"), points, "low", "high", "at", {"n": F.lit(1)}).collect() == []


def test_bins_follow_the_data(spark):
    """No task has much more than the rows of a bin, although a third of the points is one value and the rest is dense."""
    pick = random.Random(5)
    points = spark.createDataFrame([(k, v) for k, v in enumerate(skewed(pick, 6000))], "k long, at double").repartition(8)
    edges = equal_depth_edges(points, "at", 200)
    assert 10 < len(edges) < 40
    dealt, shares = dealt_points(points, "at", edges, 200)
    fullest = dealt.groupBy("_bin", "_share").count().agg(F.max("count")).first()[0]
    assert fullest <= 500 and shares.count() >= 1
    assert dealt.count() == points.filter("at IS NOT NULL").count()
    assert len(equal_depth_edges(points, "at", 1, 16)) < 16
    binned = with_bin(points, "at", edges, "bin").filter("at IS NOT NULL").orderBy("at").collect()
    assert [r["bin"] for r in binned] == sorted(r["bin"] for r in binned)


def test_no_pairwise_plan(spark):
    points = spark.createDataFrame([(float(k % 9),) for k in range(100)], "at double")
    bands = spark.createDataFrame([(1, 0.0, 2.0)], "b int, low double, high double")
    for df in (range_join(bands, points, "low", "high", "at", (), 10), range_totals(bands, points, "low", "high", "at", {"n": F.lit(1)}, 10)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_merged_states(spark):
    """States of days add up to those of months and of all keys; nulls and not-a-number say nothing."""
    pick = random.Random(6)
    made = [(pick.choice("ab"), dt.datetime(2024, 1 + k % 3, 1 + k % 27), k % 4000, pick.gauss(100, 15)) for k in range(12_000)]
    made += [("c", dt.datetime(2024, 1, 1), None, NAN), ("c", dt.datetime(2024, 1, 2), None, None)]
    df = spark.createDataFrame(made, "k string, ts timestamp, who long, v double").repartition(6)
    states = sketches.daily_states(df, ["k"], "ts", ["who"], ["v"])
    columns = ["n", sketches.distinct_count("who").alias("who"), sketches.quantile("v", 0.9).alias("q"), sketches.rank("v", 100.0).alias("r")]
    whole = sketches.merged_states(states.filter("k <> 'c'"), []).select(*columns).first()
    values = sorted(v for k, _, _, v in made if k != "c")
    assert whole["n"] == 12_000 and abs(whole["who"] - 4000) <= 200 and abs(whole["r"] - sum(v <= 100 for v in values) / 12_000) < 0.05
    assert values[int(0.85 * 12_000)] <= whole["q"] <= values[int(0.95 * 12_000)]
    monthly = sketches.merged_states(states, ["k"], "month").select("k", "day", *columns).collect()
    assert sorted((r["k"], r["day"].month) for r in monthly) == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2), ("b", 3), ("c", 1)]
    nothing = next(r for r in monthly if r["k"] == "c")
    assert (nothing["n"], nothing["who"], nothing["q"], nothing["r"]) == (2, 0, None, None)
