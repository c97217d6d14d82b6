"""Calendars, changes, event studies and features of time series.

Input rows are one per series and step (hour or day): raw rows are reduced to
that grain first, with partial sums on the map side. A window over one series
is then no longer than its calendar, however many raw rows a key has. For raw
rows themselves, which have no such bound, see ``tarn.operators.scans``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.functions.skew import dimension_join
from tarn.operators.scans import (
    SEGMENT_ROWS,
    exact_quantiles,
    over_blocks,
    previous_value,
    time_segment,
    whole,
    with_positions,
)


def _series(keys: Sequence[str], step: str):
    return Window.partitionBy(*keys).orderBy(step)


def resample(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    grain: str = "hour",
    out_ts: str = "timestamp_hour",
    out: str | None = None,
) -> DataFrame:
    """Mean of ``value`` per key and hour (or other grain)."""
    return df.groupBy(*keys, F.date_trunc(grain, ts).alias(out_ts)).agg(
        F.avg(value).alias(out or value)
    )


def calendar(
    df: DataFrame, keys: Sequence[str], step: str, until: dt.date | None = None, interval: str = "1 DAY"
) -> DataFrame:
    """Every step from the first to the last of each series (or to ``until``, if later)."""
    end = F.max(step)
    if until is not None:
        end = F.greatest(end, F.lit(until))
    spans = df.groupBy(*keys).agg(F.min(step).alias("_from"), end.alias("_to"))
    return spans.select(
        *keys,
        F.explode(F.sequence("_from", "_to", F.expr(f"INTERVAL {interval}"))).alias(step),
    )


def fill_calendar(
    df: DataFrame,
    keys: Sequence[str],
    step: str,
    values: Sequence[str],
    until: dt.date | None = None,
    interval: str = "1 DAY",
) -> DataFrame:
    """A complete calendar per series with gaps filled forward; a leading gap stays null."""
    keys = list(keys)
    spine = calendar(df, keys, step, until, interval)
    joined = spine.join(df.select(*keys, step, *values), [*keys, step], "left")
    upto = _series(keys, step).rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(
        *keys, step, *[F.last(v, ignorenulls=True).over(upto).alias(v) for v in values]
    )


def change_bps(df: DataFrame, keys: Sequence[str], step: str, rate: str, out: str = "rate_change_bps"):
    """Change against the previous row of the series, in basis points of a percent rate."""
    return df.withColumn(out, (F.col(rate) - F.lag(rate).over(_series(keys, step))) * F.lit(100))


def simple_return(df: DataFrame, keys: Sequence[str], step: str, close: str, out: str = "daily_return"):
    """Close over previous close, minus one."""
    previous = F.lag(close).over(_series(keys, step))
    return df.withColumn(out, F.try_divide(F.col(close), previous) - F.lit(1))


def event_windows(
    series: DataFrame, keys: Sequence[str], day: str, close: str, horizon: int = 5
) -> DataFrame:
    """Per trading day: the close, the returns after it and the volatility up to it.

    The row of a day describes an event whose last trading day strictly before
    it is that day, except that ``close_after`` columns start one row later if
    the event day itself is a trading day; see :func:`event_study`.
    """
    w = _series(keys, day)
    daily = simple_return(series, keys, day, close, "_return")
    back = w.rowsBetween(-(horizon - 1), 0)
    return daily.select(
        *keys,
        F.col(day),
        F.col(close).alias("pre_close"),
        F.when(F.count("_return").over(back) == horizon, F.stddev_samp("_return").over(back)).alias(
            f"volatility_pre_{horizon}d"
        ),
        F.lead(day, 1).over(w).alias("_next_day"),
        *[F.lead(close, k).over(w).alias(f"_close_{k}") for k in sorted({1, 2, horizon, horizon + 1})],
    )


def event_study(
    rates: DataFrame,
    series: DataFrame,
    day: str,
    rate: str,
    series_day: str,
    close: str,
    symbol: Sequence[str] = (),
    series_of_rate: Sequence[str] = (),
    horizon: int = 5,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """One row per non-zero rate change with the market's closes around it.

    The base is the last trading day strictly before the event, the rows after
    it are trading days strictly later than the event. Returns are the first
    and the ``horizon``-th later close over the base. Everything is computed
    on the trading days before events are picked, so an event in a gap still
    finds its neighbours; events with fewer later rows than the horizon go.
    Every series meets every symbol, unless ``pairs``, of the columns of both,
    says which symbols a series is studied on.
    """
    symbol = list(symbol)
    changes = (
        change_bps(rates, series_of_rate, day, rate)
        .filter(F.col("rate_change_bps") != 0)
        .withColumnRenamed(day, "event_date")
        .withColumnRenamed(rate, "rate_level_pct")
    )
    rows = event_windows(series, symbol, series_day, close, horizon)
    # a trading day is the base of every event after it, up to and including the next one
    last_base = F.coalesce(F.col("_next_day"), F.date_add(series_day, 1))
    base = rows.withColumn(
        "event_date", F.explode(F.sequence(F.date_add(series_day, 1), last_base))
    )
    on_trading_day = F.col("event_date") == F.col("_next_day")

    def after(k: int) -> Column:
        return F.when(on_trading_day, F.col(f"_close_{k + 1}")).otherwise(F.col(f"_close_{k}"))

    base = base.select(
        *symbol,
        "event_date",
        "pre_close",
        F.try_divide(after(1), F.col("pre_close")).alias("_r1"),
        F.try_divide(after(horizon), F.col("pre_close")).alias("_rn"),
        f"volatility_pre_{horizon}d",
    )
    on = ["event_date"]
    if pairs is not None:
        wanted = pairs.select(*series_of_rate, *symbol).distinct()
        changes, on = dimension_join(changes, wanted, series_of_rate, "inner"), [*symbol, *on]
    joined = changes.join(base, on, "inner")
    return joined.filter(F.col("_rn").isNotNull()).select(
        *series_of_rate,
        *symbol,
        "event_date",
        "rate_change_bps",
        "rate_level_pct",
        (F.col("rate_change_bps") > 0).alias("is_rate_hike"),
        (F.col("rate_change_bps") < 0).alias("is_rate_cut"),
        "pre_close",
        (F.col("_r1") - 1).alias("return_1d"),
        (F.col("_rn") - 1).alias(f"return_{horizon}d"),
        f"volatility_pre_{horizon}d",
    )


def below_quartile(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, flag: str, q: float = 0.25
) -> DataFrame:
    """Flag steps strictly below the quartile of their key and day.

    Meant for hourly rows: a window then holds at most one day of hours. On a
    day of equal values nothing is flagged.
    """
    w = Window.partitionBy(*keys, F.to_date(ts))
    return df.withColumn(flag, F.col(value) < F.percentile(value, F.lit(q)).over(w))


def trend(
    df: DataFrame, keys: Sequence[str], round_label: str, value: str
) -> DataFrame:
    """Change of ``value`` from one release round to the next.

    Labels such as v4.0 and v10.1 are ordered by their numbers, not as text.
    """
    numbers = F.transform(
        F.regexp_extract_all(F.col(round_label), F.lit(r"(\d+)")), lambda x: x.cast("int")
    )
    w = Window.partitionBy(*keys).orderBy(numbers)
    previous = F.lag(value).over(w)
    return df.withColumn(f"{value}_previous", previous).withColumn(
        f"{value}_change_pct", (F.try_divide(F.col(value), previous) - 1) * 100
    )


def forecast_features(
    df: DataFrame,
    keys: Sequence[str],
    hour: str,
    value: str,
    lags: Sequence[int] = (1, 24),
    means: Sequence[int] = (24,),
    ahead: int = 24,
) -> DataFrame:
    """Lags, rolling means, calendar fields and the value ``ahead`` steps later.

    Steps must be complete (see :func:`fill_calendar`), so rows count hours.
    """
    w = _series(keys, hour)
    return df.select(
        *keys,
        hour,
        value,
        *[F.lag(value, n).over(w).alias(f"lag_{n}") for n in lags],
        *[F.avg(value).over(w.rowsBetween(-n, -1)).alias(f"mean_{n}") for n in means],
        F.hour(hour).alias("hour_of_day"),
        F.dayofweek(hour).alias("day_of_week"),
        F.lead(value, ahead).over(w).alias("target"),
    )


def time_folds(df: DataFrame, ts: str, folds: int = 5) -> DataFrame:
    """Number the ``folds + 1`` time slices a row falls into, in time order.

    Fold k trains on slices up to k and tests on slice k + 1. Slices are equal
    runs of the distinct days; only those days are ranked, and joined back.
    """
    days = df.select(F.to_date(ts).alias("_day")).filter("_day is not null").distinct()
    # the distinct days are the whole of this window's input, a few thousand at most
    sliced = days.select(
        "_day", F.ntile(folds + 1).over(Window.partitionBy(F.lit(0)).orderBy("_day")).alias("slice")
    )
    return dimension_join(
        df.withColumn("_day", F.to_date(ts)), sliced, ["_day"], "left", derived=True
    ).drop("_day")


def fold_sizes(sliced: DataFrame, folds: int = 5) -> DataFrame:
    """Rows each fold trains and tests on."""
    sizes = sliced.groupBy("slice").agg(F.count(F.lit(1)).alias("n"))
    roles = F.array(
        *[
            F.struct(
                F.lit(k).alias("fold"),
                F.when(F.col("slice") <= k, F.col("n")).alias("train"),
                F.when(F.col("slice") == k + 1, F.col("n")).alias("test"),
            )
            for k in range(1, folds + 1)
        ]
    )
    return (
        sizes.select(F.inline(roles))
        .groupBy("fold")
        .agg(F.sum("train").alias("train_rows"), F.sum("test").alias("test_rows"))
    )


def spikes(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tiebreak: str,
    value: str,
    window: int = 20,
    threshold: float = 3.0,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Rows far from the mean of the ``window`` rows before them, in standard deviations.

    Works on raw rows: positions and blocks spread a long series over tasks.
    Rows with fewer rows before them have no score.
    """
    segment, _ = time_segment(df, keys, ts, segment_rows)
    ordered = with_positions(df, keys, [ts, tiebreak], segment)

    def frame(w):
        return w.rowsBetween(-window, -1)

    scored = over_blocks(
        ordered,
        keys,
        {
            "_seen": lambda w: F.count(value).over(frame(w)),
            "_mean": lambda w: F.avg(value).over(frame(w)),
            "_sd": lambda w: F.stddev_samp(value).over(frame(w)),
        },
        before=window,
    )
    score = F.when(
        F.col("_seen") == window, F.try_divide(F.col(value) - F.col("_mean"), F.col("_sd"))
    )
    return (
        scored.withColumn("zscore", score)
        .withColumn("is_spike", F.coalesce(F.abs("zscore") > threshold, F.lit(False)))
        .drop("_seen", "_mean", "_sd", "_pos")
    )


def robust_spikes(
    df: DataFrame, keys: Sequence[str], value: str, threshold: float = 3.5
) -> DataFrame:
    """Rows far from the median of their key, in scaled median absolute deviations."""
    keys = list(keys)
    medians = exact_quantiles(df, keys, value, {"median": 0.5})
    centred = dimension_join(df, medians, keys, derived=True)
    deviation = centred.withColumn("_dev", F.abs(F.col(value) - F.col("median")))
    mads = exact_quantiles(deviation, keys, "_dev", {"mad": 0.5})
    # 1.4826 makes the deviation comparable to a standard deviation
    score = F.try_divide(F.col(value) - F.col("median"), F.col("mad") * F.lit(1.4826))
    return dimension_join(centred, mads, keys, derived=True).withColumn(
        "robust_z", score
    ).withColumn("is_spike", F.coalesce(F.abs("robust_z") > threshold, F.lit(False)))


def calendar_gaps(df: DataFrame, keys: Sequence[str], day: str, max_business_days: int) -> DataFrame:
    """Pairs of consecutive days of a series more than N business days apart."""
    days = df.select(*keys, F.to_date(day).alias("day")).distinct()
    w = _series(keys, "day")
    paired = days.withColumn("previous_day", F.lag("day").over(w)).filter("previous_day is not null")
    # Monday to Friday days in (previous, day], counted from a fixed Monday
    def weekdays(c: str) -> Column:
        n = F.datediff(F.col(c), F.lit("1900-01-01").cast("date")) + 1
        return F.floor(n / 7) * 5 + F.least(n % 7, F.lit(5))

    return paired.withColumn(
        "business_days", (weekdays("day") - weekdays("previous_day")).cast("long")
    ).filter(F.col("business_days") > max_business_days)


def not_increasing(df: DataFrame, keys: Sequence[str], position: str, day: str, block_of: int = 100_000) -> DataFrame:
    """Rows whose day is not after the day of the row before it in load order.

    ``position`` is the load number of a row (whole, unique within a key).
    """
    block = whole(F.col(position).cast("long"), block_of)
    seen = previous_value(df, keys, [position], day, block, "previous_day")
    return seen.filter(F.col(day) <= F.col("previous_day"))
