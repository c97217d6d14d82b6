"""Lookups, as-of joins and series joins."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.functions.skew import dimension_join, hashable, row_salt
from tarn.operators.scans import SEGMENT_ROWS, time_segment, whole
from tarn.operators.series import fill_calendar
from tarn.session import stage


def lookup(
    facts: DataFrame, dim: DataFrame, code: str, dim_code: str, values: dict[str, str]
) -> DataFrame:
    """Add attributes of a dimension by code; unknown codes give null.

    ``values`` maps output names to dimension columns. The dimension must hold
    one row per code.
    """
    side = dim.select(
        F.col(dim_code).alias(code), *[F.col(c).alias(out) for out, c in values.items()]
    )
    return dimension_join(facts, side, [code])


def normalised(name: Column | str) -> Column:
    """Trimmed, lower case, single blanks: the form names are compared in."""
    return F.lower(F.trim(F.regexp_replace(name, r"\s+", " ")))


def lookup_name(
    facts: DataFrame, dim: DataFrame, name: str, dim_name: str, value: str, out: str
) -> DataFrame:
    """Attribute by normalised name; unknown names give null.

    Of dimension rows whose names normalise alike one counts: one with a value before one
    without, then the first name in text order, then the smallest value.
    """
    first = F.min(F.struct(F.isnull(F.col(value)).alias("none"), F.col(dim_name).alias("name"), F.col(value).alias("value")))
    side = dim.groupBy(normalised(F.col(dim_name)).alias("_name")).agg(first.getField("value").alias(out))
    return dimension_join(
        facts.withColumn("_name", normalised(F.col(name))), side, ["_name"]
    ).drop("_name")


def lookup_pattern(
    facts: DataFrame, patterns: DataFrame, name: str, pattern: str, value: str, out: str
) -> DataFrame:
    """Attribute of the longest pattern contained in a name; no pattern gives null.

    Distinct names are cut into all their substrings that have the length of
    some pattern, which are matched by an equi-join, so names and patterns are
    never compared pairwise. The result per name is joined back to the facts.
    Among equally long patterns the first in text order wins.
    """
    side = stage(patterns.select(F.col(pattern).alias("_p"), F.col(value).alias(out)), "patterns")
    names = facts.select(F.col(name).alias("_name")).filter("_name is not null").distinct()
    # as many numbers as the patterns have different lengths
    lengths = [r["n"] for r in side.select(F.length("_p").alias("n")).distinct().collect() if r["n"]]
    size = F.explode(F.array(*[F.lit(n) for n in lengths]))
    grams = names.withColumn("_n", size).select(
        "_name",
        F.explode(
            F.expr(
                "if(length(_name) >= _n,"
                " transform(sequence(1, length(_name) - _n + 1), i -> substring(_name, i, _n)),"
                " array())"
            )
        ).alias("_p"),
    )
    matched = dimension_join(grams, side, ["_p"], "inner")
    best = matched.groupBy(F.col("_name").alias(name)).agg(
        F.min_by(out, F.struct(-F.length("_p"), F.col("_p"))).alias(out)
    )
    return dimension_join(facts, best, [name], derived=True)


def rate_calendar(
    rates: DataFrame,
    series: Sequence[str],
    day: str,
    rate: str,
    until: dt.date | None = None,
) -> DataFrame:
    """One rate per series and day, from the first to the last day, gaps filled forward."""
    return fill_calendar(rates, series, day, [rate], until=until)


def join_rate(
    facts: DataFrame,
    calendar: DataFrame,
    series: Sequence[str],
    day: Column,
    calendar_day: str,
    rate: str,
    out: str,
    default: float | None = None,
) -> DataFrame:
    """As-of rate by day: with the calendar filled, a plain equi-join on the day.

    ``default`` stands in where there is no rate (1 for an empty rate table).
    """
    side = calendar.select(*series, F.col(calendar_day).alias("_day"), F.col(rate).alias(out))
    joined = dimension_join(
        facts.withColumn("_day", day), side, [*series, "_day"], derived=True
    ).drop("_day")
    if default is not None:
        joined = joined.withColumn(out, F.coalesce(out, F.lit(default)))
    return joined


def asof_join(
    facts: DataFrame,
    rates: DataFrame,
    keys: Sequence[str],
    ts: str,
    rate_ts: str,
    rate: str,
    out: str,
    segment_rows: int = SEGMENT_ROWS,
    salts: int = 8,
) -> DataFrame:
    """The latest rate at or before each fact, to the exact timestamp.

    Facts are spread over (key, time segment, salt); each spread gets the rates
    of its segment and the rate in force when the segment begins, so a hot key
    is worked on by many tasks. Facts never meet each other. Segments are short
    enough for the rates as well as for the facts.
    """
    keys = list(keys)
    _, width = time_segment(facts, keys, ts, segment_rows * salts)
    _, rate_width = time_segment(rates, keys, rate_ts, segment_rows)
    width = min(width, rate_width)
    cut = lambda c: whole(F.unix_micros(F.col(c)), width)
    points = rates.groupBy(*keys, F.col(rate_ts).alias("_ts")).agg(F.max(rate).alias("_rate"))
    points = points.withColumn("_segment", cut("_ts"))
    tails = points.groupBy(*keys, "_segment").agg(F.max_by("_rate", "_ts").alias("_tail"))
    wanted = facts.select(*keys, cut(ts).alias("_segment")).distinct()
    earlier = Window.partitionBy(*keys).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    spine = (
        wanted.withColumn("_wanted", F.lit(True))
        .join(tails, [*keys, "_segment"], "full")
        .withColumn("_rate", F.last("_tail", ignorenulls=True).over(earlier))
    )
    opening = spine.filter("_wanted").select(
        *keys,
        "_segment",
        F.timestamp_micros(F.col("_segment") * F.lit(width)).alias("_ts"),
        "_rate",
        F.lit(0).alias("_side"),
    )
    moves = points.select(*keys, "_segment", "_ts", "_rate", F.lit(1).alias("_side"))
    known = opening.unionByName(moves).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    payload = [c for c in facts.columns if c not in keys]
    asked = facts.select(
        *keys,
        F.struct(*payload).alias("_fact"),
        F.col(ts).alias("_ts"),
        cut(ts).alias("_segment"),
        row_salt(hashable(facts), salts).alias("_salt"),
        F.lit(2).alias("_side"),
    )
    w = (
        Window.partitionBy(*keys, "_segment", "_salt")
        .orderBy("_ts", "_side")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        known.unionByName(asked, allowMissingColumns=True)
        .withColumn(out, F.last("_rate", ignorenulls=True).over(w))
        .filter("_side = 2")
        .select(*keys, "_fact.*", out)
        .select(*facts.columns, out)
    )


def hourly_cost_join(
    carbon: DataFrame,
    efficiency: DataFrame,
    pricing: DataFrame,
    hour: str = "timestamp_hour",
    country: str = "country",
    accelerator: str = "accelerator",
    valid_from: str = "valid_from",
) -> DataFrame:
    """Carbon (country, hour) with the price in force and the models of each accelerator.

    ``pricing`` holds (country, accelerator, valid_from, ...) and is filled to
    one row per day before. The carbon side is the long one and is not
    shuffled while the other two stay within the broadcast bound.
    """
    priced = dimension_join(
        carbon.withColumn(valid_from, F.to_date(hour)), pricing, [country, valid_from], "inner",
        derived=True,
    )
    return dimension_join(priced, efficiency, [accelerator], "inner", derived=True)


def trading_ordinals(series: DataFrame, symbol: Sequence[str], day: str, out: str = "ordinal") -> DataFrame:
    """Number the trading days of each symbol; one row per symbol and day goes in."""
    return series.withColumn(out, F.row_number().over(Window.partitionBy(*symbol).orderBy(day)))


def join_event_offsets(
    events: DataFrame,
    series: DataFrame,
    symbol: Sequence[str],
    event_day: str,
    day: str,
    value: str,
    first: int = -5,
    last: int = 5,
) -> DataFrame:
    """Series values at trading-day offsets around each event.

    Offset 0 is the last trading day at or before the event. The place of the
    event comes from the filled calendar, each offset from an equi-join on the
    day's ordinal; no range join is needed.
    """
    symbol = list(symbol)
    numbered = stage(trading_ordinals(series.select(*symbol, day, value), symbol, day), "ordinals")
    last_event = events.agg(F.max(event_day).alias("d")).first()["d"]
    calendar = fill_calendar(numbered.drop(value), symbol, day, ["ordinal"], until=last_event)
    placed = join_rate(events, calendar, symbol, F.col(event_day), day, "ordinal", "_at").filter(
        F.col("_at").isNotNull()
    )
    offsets = placed.withColumn("offset", F.explode(F.sequence(F.lit(first), F.lit(last))))
    offsets = offsets.withColumn("ordinal", F.col("_at") + F.col("offset")).drop("_at")
    side = numbered.withColumnRenamed(day, "offset_day")
    return offsets.join(side, [*symbol, "ordinal"], "inner").drop("ordinal")


def join_hourly(
    left: DataFrame, right: DataFrame, keys: Sequence[str], right_values: dict[str, str]
) -> DataFrame:
    """Left join of two hourly series on (zone, hour); the right one has a row per key."""
    side = right.select(*keys, *[F.col(c).alias(out) for out, c in right_values.items()])
    return left.join(side, list(keys), "left")
