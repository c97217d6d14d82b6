"""Ordered computations over long series, without one task per key.

A plain window sends all rows of a key to one task. These operators cut each
key into segments of its order (an hour, a day, a month), work on the segments
in parallel, and connect them through a summary with one row per segment.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.functions.skew import dimension_join
from tarn.session import stage

BLOCK_ROWS = 50_000
# rows one task should sort for one segment of a key, or one group of values
SEGMENT_ROWS = 2_000_000
GROUP_VALUES = 2_000_000


def whole(number: Column, width: int) -> Column:
    """Whole multiples of ``width`` in a long, rounded down, in long arithmetic."""
    return F.call_function("div", number - F.pmod(number, F.lit(width)), F.lit(width))


def time_segment(
    df: DataFrame, keys: Sequence[str], ts: str, rows: int = SEGMENT_ROWS
) -> tuple[Column, int]:
    """Segments of time short enough that none holds many more than ``rows`` rows of a key.

    Starts from days and shortens them, down to a second, as long as the
    fullest one is too full; each try is one count of two columns. Returns the
    segment number and its width in microseconds.
    """
    second = 1_000_000
    width = 86_400 * second
    while True:
        number = whole(F.unix_micros(F.col(ts)), width)
        sizes = df.groupBy(*keys, number.alias("_segment")).agg(F.count(F.lit(1)).alias("n"))
        fullest = sizes.agg(F.max("n").alias("n")).first()["n"] or 0
        if fullest <= rows or width == second:
            return number, width
        width = max(second, width // max(2, -(-fullest // rows)) // second * second)


def _before_segments(
    rows: DataFrame, keys: list[str], total: Column, before: Column
) -> DataFrame:
    """One row per key and segment: ``before`` applied to the ``total`` of earlier segments.

    These rows are put in front of their segment (``_mark`` 0), so the window
    over a segment finds what came before it without a join, and the rows are
    shuffled only once.
    """
    totals = rows.groupBy(*keys, "_segment").agg(total.alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, "_segment", before.over(earlier).alias("_given"), F.lit(0).alias("_mark"))


def _fronted(rows: DataFrame, fronts: DataFrame) -> DataFrame:
    return rows.withColumn("_mark", F.lit(1)).unionByName(fronts, allowMissingColumns=True)


def _segment_window(keys: list[str], order: Sequence[str]):
    return (
        Window.partitionBy(*keys, "_segment")
        .orderBy("_mark", *order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )


def with_positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segment: Column,
    out: str = "_pos",
) -> DataFrame:
    """Number the rows of each key 0, 1, 2, ... by ``order``, which must be total.

    ``segment`` is a non-decreasing function of the first order column. A task
    sorts one segment; the numbers of rows before each segment come from a
    summary counted on the map side.
    """
    keys = list(keys)
    rows = df.withColumn("_segment", segment)
    fronts = _before_segments(rows, keys, F.count(F.lit(1)), F.sum("_total"))
    # the front row carries the number of earlier rows, every other row counts one
    counted = F.when(F.col("_mark") == 0, F.coalesce("_given", F.lit(0))).otherwise(F.lit(1))
    placed = _fronted(rows, fronts).withColumn("_count", counted)
    numbered = placed.withColumn(out, F.sum("_count").over(_segment_window(keys, order)) - F.lit(1))
    return numbered.filter("_mark = 1").drop("_segment", "_mark", "_given", "_count")


def over_blocks(
    df: DataFrame,
    keys: Sequence[str],
    columns: dict[str, Column],
    before: int = 0,
    after: int = 0,
    position: str = "_pos",
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Add window expressions that look at most ``before`` rows back and ``after`` ahead.

    Rows are grouped into blocks of fixed size by position; each block also
    gets copies of the few rows next to it, so every frame is complete.
    ``columns`` maps names to functions of a window specification.
    """
    if max(before, after) > block:
        raise ValueError("a frame may not be longer than a block")
    own = whole(F.col(position), block)
    offset = F.col(position) % F.lit(block)
    homes = F.array_compact(
        F.array(
            own,
            F.when(offset >= F.lit(block - before), own + 1) if before else F.lit(None).cast("long"),
            F.when((offset < F.lit(after)) & (own > 0), own - 1) if after else F.lit(None).cast("long"),
        )
    )
    spread = df.withColumn("_block", F.explode(homes))
    w = Window.partitionBy(*keys, "_block").orderBy(position)
    for name, expression in columns.items():
        spread = spread.withColumn(name, expression(w))
    return spread.filter(F.col("_block") == own).drop("_block")


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    segment: Column,
    out: str,
) -> DataFrame:
    """The last non-null ``value`` on or before each row; null before the first one.

    ``(keys, ts)`` must be unique. Inside a segment this is a window; across
    segments the last value of each earlier one is carried along the summary.
    """
    keys = list(keys)
    rows = df.withColumn("_segment", segment)
    present = F.when(F.col(value).isNotNull(), F.col(ts))
    fronts = _before_segments(
        rows, keys, F.max_by(value, present), F.last("_total", ignorenulls=True)
    )
    known = F.coalesce("_given", F.col(value))
    filled = _fronted(rows, fronts).withColumn(
        out, F.last(known, ignorenulls=True).over(_segment_window(keys, [ts]))
    )
    return filled.filter("_mark = 1").drop("_segment", "_mark", "_given")


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    segment: Column,
    out: str,
) -> DataFrame:
    """``value`` in the row before each row of a key by ``order``, which must be total."""
    keys = list(keys)
    rows = df.withColumn("_segment", segment)
    final = F.max_by(value, F.struct(*order))
    fronts = _before_segments(rows, keys, final, F.last("_total"))
    seen = F.when(F.col("_mark") == 0, F.col("_given")).otherwise(F.col(value))
    w = Window.partitionBy(*keys, "_segment").orderBy("_mark", *order)
    placed = _fronted(rows, fronts).withColumn(out, F.lag(seen).over(w))
    return placed.filter("_mark = 1").drop("_segment", "_mark", "_given")


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    segment: Column,
    out: str,
) -> DataFrame:
    """Sum of ``value`` over the rows of a key up to and including each row."""
    keys = list(keys)
    rows = df.withColumn("_segment", segment).withColumn("_v", value)
    fronts = _before_segments(rows, keys, F.sum("_v"), F.sum("_total"))
    parts = _fronted(rows, fronts).withColumn("_part", F.coalesce("_given", "_v", F.lit(0)))
    summed = parts.withColumn(out, F.sum("_part").over(_segment_window(keys, order)))
    return summed.filter("_mark = 1").drop("_segment", "_v", "_mark", "_given", "_part")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: dict[str, float],
    most: int = GROUP_VALUES,
    bins: int = 1000,
) -> DataFrame:
    """Interpolated quantiles per key, exact, for groups of any size. Nulls are ignored.

    Equal values are counted on the map side. While the range that holds a
    wanted rank has more than ``most`` rows of several values, it is cut into
    ``bins`` and narrowed to the bins around the rank; what is left is sorted.
    The number of passes grows with the logarithm of the largest group. Values are
    taken as doubles, as the result is one; a long beyond 2 ** 53 is rounded.
    """
    keys = list(keys)
    # read for the ranges, by each pass and for the result, so written once
    counted = stage(
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n")),
        "counted",
    )
    last = F.col("_n") - F.lit(1)
    # each quantile lies between the rows numbered floor and ceil of its rank
    ranks = [F.lit(float(q)) * last for q in quantiles.values()]
    wanted = F.array_distinct(F.array(*[f(r) for r in ranks for f in (F.floor, F.ceil)]))
    # a range: the rows of a key with values from _low to _high, _left in number, _before below
    # it, and the numbers of the wanted rows among them
    ranges = stage(
        counted.groupBy(*keys)
        .agg(F.sum("_n").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        .select(
            *keys,
            F.col("_n").alias("_all"),
            wanted.alias("_rows"),
            "_low",
            "_high",
            F.col("_n").alias("_left"),
            F.lit(0).cast("long").alias("_before"),
        ),
        "ranges",
    )
    wide = (F.col("_left") > most) & (F.col("_low") < F.col("_high"))
    while not ranges.filter(wide).isEmpty():
        narrower = _narrowed(counted, ranges.filter(wide), keys, bins)
        ranges = stage(ranges.filter(~wide).unionByName(narrower), "ranges")
    found = (
        _numbered(_in_ranges(counted, ranges, keys), keys, "_v")
        .select(*keys, "_all", F.explode(_rows_within()).alias("_row"), "_v")
        # two values per quantile
        .groupBy(*keys)
        .agg(
            F.max("_all").alias("_n"),
            F.map_from_entries(F.collect_set(F.struct("_row", "_v"))).alias("_at"),
        )
    )

    def quantile(q: float) -> Column:
        rank = F.lit(float(q)) * last
        low, high = F.try_element_at("_at", F.floor(rank)), F.try_element_at("_at", F.ceil(rank))
        return low + (high - low) * (rank - F.floor(rank))

    return found.select(*keys, *[quantile(q).alias(name) for name, q in quantiles.items()])


def _in_ranges(counted: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Counted values that fall into a range of their key, with the range."""
    side = ranges.withColumn("_key", F.xxhash64(F.lit(0), *keys))
    rows = counted.withColumn("_key", F.xxhash64(F.lit(0), *keys))
    same = F.lit(True)
    for c in keys:
        side = side.withColumnRenamed(c, f"_r_{c}")
        same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    joined = dimension_join(rows, side, ["_key"], "inner")
    return joined.filter(same & F.col("_v").between(F.col("_low"), F.col("_high"))).drop(
        "_key", *[f"_r_{c}" for c in keys]
    )


def _numbered(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Numbers of the first row (_start) and after the last row (_end) each counted row stands for."""
    upto = (
        Window.partitionBy(*keys, "_low", "_before")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ended = rows.withColumn("_end", F.col("_before") + F.sum("_n").over(upto))
    return ended.withColumn("_start", F.col("_end") - F.col("_n"))


def _rows_within() -> Column:
    return F.filter("_rows", lambda r: (F.col("_start") <= r) & (r < F.col("_end")))


def _narrowed(counted: DataFrame, ranges: DataFrame, keys: list[str], bins: int) -> DataFrame:
    # the lowest and the highest value never share a bin, so every pass shortens a range;
    # infinities and NaN have bins of their own, and halves keep the widest range finite
    largest, v = F.lit(sys.float_info.max), F.col("_v")
    low, high = F.greatest("_low", -largest) / 2, F.least("_high", largest) / 2
    infinite = F.lit(float("inf"))
    place = (
        F.when(F.isnan(v), bins + 2).when(v == infinite, bins + 1).when(v == -infinite, -1)
        .otherwise(F.floor((v / 2 - low) / (high - low) * F.lit(bins)))
    )
    cut = (
        _in_ranges(counted, ranges, keys)
        .groupBy(*keys, "_all", "_rows", "_low", "_before", place.cast("long").alias("_bin"))
        .agg(F.sum("_n").alias("_n"), F.min("_v").alias("_lowest"), F.max("_v").alias("_high"))
    )
    kept = _numbered(cut, keys, "_bin").withColumn("_rows", _rows_within()).filter(F.size("_rows") > 0)
    return kept.select(
        *keys,
        "_all",
        "_rows",
        F.col("_lowest").alias("_low"),
        "_high",
        F.col("_n").alias("_left"),
        F.col("_start").alias("_before"),
    )
