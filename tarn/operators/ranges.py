"""Joins of intervals with points, without comparing them pairwise.

Values are cut into bins with about equally many points, whose edges come from a
quantile sketch, so that bins follow the data: dense places have narrow bins. A bin is
found by binary search. ``range_join`` covers each interval by bins and joins on them;
``range_totals`` needs no pairs at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.functions.skew import dimension_join, hashable, row_salt
from tarn.session import stage

BIN_ROWS = 50_000
MOST_BINS = 4096
_SKETCH_ACCURACY = 10_000


def _number(df: DataFrame, column: str) -> Column:
    """A double that never falls where the column rises: all that bins need."""
    kind = dict(df.dtypes)[column]
    value = F.col(f"`{column}`")
    if kind == "date":
        value = F.unix_date(value)
    elif kind == "timestamp":
        value = F.unix_micros(value)
    elif kind == "timestamp_ntz":
        value = F.unix_micros(value.cast("timestamp"))
    return value.cast("double")


def equal_depth_edges(df: DataFrame, column: str, bin_rows: int = BIN_ROWS, most: int = MOST_BINS) -> list[float]:
    """Inner edges of bins that hold about ``bin_rows`` rows each; at most ``most`` bins, whatever the input."""
    value = _number(df, column)
    found = df.select(value.alias("_v")).filter("_v IS NOT NULL AND NOT isnan(_v)")
    n = found.count()
    bins = min(most, -(-n // bin_rows))
    if bins < 2:
        return []
    at = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    edges = found.agg(F.percentile_approx("_v", at, _SKETCH_ACCURACY).alias("e")).first()["e"]
    return sorted({e for e in edges if abs(e) != float("inf")})


def with_bin(df: DataFrame, column: str, edges: Sequence[float], out: str) -> DataFrame:
    """Add the number of the bin that holds a value; null for null. Equal values share a bin, and bins rise with the values."""
    known = df.withColumn("_v", _number(df, column))
    if not edges:
        return known.withColumn(out, F.when(F.col("_v").isNotNull(), F.lit(0))).drop("_v")
    splits = [-float("inf"), *edges, float("inf")]
    # what is above all numbers has a bin of its own
    cut = Bucketizer(splits=splits, inputCol="_v", outputCol=out, handleInvalid="keep").transform(known)
    return cut.withColumn(out, F.when(F.col("_v").isNotNull(), F.col(out).cast("int"))).drop("_v")


def dealt_points(points: DataFrame, at: str, edges: Sequence[float], bin_rows: int) -> tuple[DataFrame, DataFrame]:
    """Points with ``_bin`` and ``_share``, and the bins that have more than one share, with their number."""
    placed = with_bin(points.filter(F.col(f"`{at}`").isNotNull()), at, edges, "_bin")
    # a row per bin
    counts = placed.groupBy("_bin").agg(F.count(F.lit(1)).alias("_n"))
    shares = counts.select("_bin", F.ceil(F.col("_n") / F.lit(bin_rows)).cast("int").alias("_shares")).filter("_shares > 1")
    shares = F.broadcast(stage(shares, "shares"))
    share = F.coalesce(F.pmod(row_salt(hashable(points), 1 << 30), F.col("_shares")), F.lit(0))
    return placed.join(shares, "_bin", "left").withColumn("_share", share).drop("_shares"), shares


def range_join(
    intervals: DataFrame, points: DataFrame, low: str, high: str, at: str, keys: Sequence[str] = (),
    bin_rows: int = BIN_ROWS, most_bins: int = MOST_BINS,
) -> DataFrame:
    """Every interval with every point in it, ends included: the columns of both, ``keys`` once.

    ``keys`` must be equal as well. Each interval goes to the bins it covers; a bin inside
    it brings only points that belong to it, so the rows that are sent follow the rows
    that come out. A bin that equal values make too full is dealt to several tasks, and
    the intervals that cover it are copied to each. Null values and null ends match nothing.
    """
    keys = list(keys)
    edges = equal_depth_edges(points, at, bin_rows, most_bins)
    dealt, shares = dealt_points(points, at, edges, bin_rows)
    spans = with_bin(with_bin(intervals.filter(F.col(f"`{low}`") <= F.col(f"`{high}`")), low, edges, "_first"), high, edges, "_last")
    covered = spans.withColumn("_bin", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last")
    copies = covered.join(shares, "_bin", "left")
    copies = copies.withColumn("_share", F.explode(F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1))).drop("_shares")
    both = copies.join(dealt, [*keys, "_bin", "_share"])
    inside = (F.col(f"`{at}`") >= F.col(f"`{low}`")) & (F.col(f"`{at}`") <= F.col(f"`{high}`"))
    return both.filter(inside).drop("_bin", "_share")


def range_totals(
    intervals: DataFrame, points: DataFrame, low: str, high: str, at: str, amounts: dict[str, Column],
    bin_rows: int = BIN_ROWS, most_bins: int = MOST_BINS,
) -> DataFrame:
    """Intervals with the sum of each amount over the points in them, ends included; 0 where there are none.

    A sum over an interval is the running total at its end less that before its start.
    Points are added up by value first, running totals are made bin by bin, and every
    distinct end looks its total up: the work is linear in both inputs, whatever the
    intervals cover. Amounts should be whole numbers or decimals; differences of running
    totals of doubles are only as good as the largest total. Null amounts count as 0;
    intervals with a null end, or whose end is before their start, have 0.
    """
    names = list(amounts)
    by_value = points.filter(F.col(f"`{at}`").isNotNull()).groupBy(F.col(f"`{at}`").alias("_at"))
    by_value = stage(by_value.agg(*[F.sum(F.coalesce(a, F.lit(0))).alias(f"_{n}") for n, a in amounts.items()]), "values")
    zero = {n: F.lit(0).cast(by_value.schema[f"_{n}"].dataType) for n in names}

    # a start sees the points before its value, an end also those at it
    fits = intervals.filter(F.col(f"`{low}`") <= F.col(f"`{high}`"))
    kind = by_value.schema["_at"].dataType
    ends = [fits.select(F.col(f"`{c}`").cast(kind).alias("_at"), F.lit(rank).alias("_rank")).distinct() for c, rank in ((low, 0), (high, 2))]
    ends = ends[0].unionByName(ends[1]).select("_at", "_rank", *[zero[n].alias(f"_{n}") for n in names])
    rows = stage(by_value.withColumn("_rank", F.lit(1)).unionByName(ends), "values")
    rows = with_bin(rows, "_at", equal_depth_edges(rows, "_at", bin_rows, most_bins), "_bin")
    # what lies before each bin: a row per bin, so a bounded side
    earlier = Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    per_bin = rows.groupBy("_bin").agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in names])
    before = per_bin.select("_bin", *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_carried_{n}") for n in names])
    upto = Window.partitionBy("_bin").orderBy("_at", "_rank").rowsBetween(Window.unboundedPreceding, 0)
    running = rows.join(F.broadcast(before), "_bin").select(
        "_at", "_rank", *[(F.sum(f"_{n}").over(upto) + F.col(f"_carried_{n}")).alias(f"_total_{n}") for n in names]
    )
    totals = stage(running.filter("_rank <> 1"), "totals")

    out = intervals
    for c, rank, side in ((low, 0, "before"), (high, 2, "until")):
        found = totals.filter(F.col("_rank") == rank).select(F.col("_at").alias(f"_{side}"), *[F.col(f"_total_{n}").alias(f"_{side}_{n}") for n in names])
        out = dimension_join(out.withColumn(f"_{side}", F.col(f"`{c}`").cast(kind)), found, [f"_{side}"]).drop(f"_{side}")
    ordered = F.coalesce(F.col(f"`{low}`") <= F.col(f"`{high}`"), F.lit(False))
    sums = [F.when(ordered, F.col(f"_until_{n}") - F.col(f"_before_{n}")).otherwise(zero[n]).alias(n) for n in names]
    return out.select(*[F.col(f"`{c}`") for c in intervals.columns], *sums)
