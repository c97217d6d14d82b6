"""Group aggregates. All of them are combined on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.operators.scans import (
    SEGMENT_ROWS,
    exact_quantiles,
    previous_value,
    running_total,
    time_segment,
)
from tarn.operators.validate import deduplicate
from tarn.functions.skew import null_safe_join


def best_per_group(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Highest non-negative value per key."""
    return df.filter(F.col(value) >= 0).groupBy(*keys).agg(F.max(value).alias(value))


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str]) -> DataFrame:
    """The row captured last for each key; ``tiebreak`` decides between equal times."""
    return deduplicate(df, keys, [F.col(ts).desc(), *[F.col(c).desc() for c in tiebreak]])


def weighted_mean(
    df: DataFrame, keys: Sequence[str | Column], weight: str, value: str, out: str
) -> DataFrame:
    """Sum of weight x value over sum of weight; rows lacking either do not count.

    A total weight of zero gives null.
    """
    known = F.col(weight).isNotNull() & F.col(value).isNotNull()
    top = F.sum(F.when(known, F.col(weight) * F.col(value)))
    return df.groupBy(*keys).agg(F.try_divide(top, F.sum(F.when(known, F.col(weight)))).alias(out))


def mix_json(df: DataFrame, keys: Sequence[str], code: str, amount: str, out: str) -> DataFrame:
    """Totals per code as one JSON object per key, codes in order.

    Codes are summed first, so the collected map is as long as the code list.
    """
    totals = df.filter(F.col(code).isNotNull()).groupBy(*keys, code).agg(F.sum(amount).alias("_sum"))
    entries = F.sort_array(F.collect_list(F.struct(F.col(code), F.col("_sum"))))
    return totals.groupBy(*keys).agg(F.to_json(F.map_from_entries(entries)).alias(out))


def compare_groups(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Mean, lowest and highest of each measure, and the row count, per group."""
    measures = []
    for v in values:
        measures += [F.avg(v).alias(f"avg_{v}"), F.min(v).alias(f"min_{v}"), F.max(v).alias(f"max_{v}")]
    return df.groupBy(*keys).agg(*measures, F.count(F.lit(1)).alias("n"))


AGGREGATIONS = {
    "average": F.avg,
    "sum": F.sum,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "count_distinct": F.count_distinct,
}


def metric(
    df: DataFrame,
    measures: Mapping[str, tuple[str, str]],
    dimensions: Sequence[str] = (),
    time: str | None = None,
    grain: str = "day",
    totals: str | None = None,
) -> DataFrame:
    """Measures by dimensions and time grain.

    ``measures`` maps output names to (aggregation, SQL expression). With
    ``totals`` set to ``rollup`` or ``cube`` subtotals are added, marked by
    ``grouping_id``.
    """
    keys: list[Column] = [F.col(d) for d in dimensions]
    if time:
        keys.append(F.date_trunc(grain, time).alias(f"{time}_{grain}"))
    grouped = {None: df.groupBy, "rollup": df.rollup, "cube": df.cube}[totals](*keys)
    columns = [AGGREGATIONS[agg](F.expr(e)).alias(name) for name, (agg, e) in measures.items()]
    if totals:
        columns.append(F.grouping_id().cast("int").alias("grouping_id"))
    return grouped.agg(*columns)


@dataclass(frozen=True)
class SemanticModel:
    """A table's time column, dimensions, measures and the metrics built on them.

    ``measures`` maps names to (aggregation, SQL expression), ``metrics`` maps
    metric names to the measure they report. ``entity`` is the primary key, as
    an SQL expression.
    """

    entity: str
    time: str
    dimensions: Sequence[str]
    measures: Mapping[str, tuple[str, str]]
    metrics: Mapping[str, str]

    def query(
        self, df: DataFrame, metrics: Sequence[str], by: Sequence[str] = (), grain: str | None = None
    ) -> DataFrame:
        """Metrics by some of the dimensions, and by time if a grain is given."""
        unknown = (set(metrics) - set(self.metrics)) | (set(by) - set(self.dimensions))
        if unknown:
            raise ValueError(f"not in the semantic model: {sorted(unknown)}")
        measures = {m: self.measures[self.metrics[m]] for m in metrics}
        return metric(df, measures, by, self.time if grain else None, grain or "day")

    def repeated_entities(self, df: DataFrame) -> DataFrame:
        """Entity keys that occur more than once: none, if the grain is right."""
        keys = df.groupBy(F.expr(self.entity).alias("entity"))
        return keys.agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, and whether it is above zero."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", (F.col("row_count") > 0).alias("passed")
        )
        for name, df in tables.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def date_span(df: DataFrame, day: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    )


def quality_score(df: DataFrame, valid: Column, keys: Sequence[str | Column]) -> DataFrame:
    """Valid records over all records, and the share rejected, per source and day."""
    good = F.count_if(valid)
    all_rows = F.count(F.lit(1))
    return df.groupBy(*keys).agg(
        good.alias("valid"),
        (all_rows - good).alias("rejected"),
        F.try_divide(good, all_rows).alias("quality_score"),
        F.try_divide(all_rows - good, all_rows).alias("reject_ratio"),
    )


def slo_table(
    runs: DataFrame,
    keys: Sequence[str],
    succeeded: Column,
    checks_passed: Column,
    latency_s: str,
    gold_age_h: Column,
    thresholds: Mapping[str, float],
) -> DataFrame:
    """Service levels per window: one row per level, with value, threshold and status.

    Levels are the success rate, the check pass rate (lower bounds), the 95th
    percentile of latency and the age of Gold (upper bounds).
    """
    rates = runs.groupBy(*keys).agg(
        F.avg(succeeded.cast("int")).alias("success_rate"),
        F.avg(checks_passed.cast("int")).alias("check_pass_rate"),
        gold_age_h.alias("gold_age_h"),
    )
    tail = exact_quantiles(runs, keys, latency_s, {"latency_p95_s": 0.95})
    joined = null_safe_join(rates, tail, keys)
    levels = [
        F.struct(
            F.lit(name).alias("slo"),
            F.col(name).alias("observed"),
            F.lit(float(thresholds[name])).alias("threshold"),
            (F.col(name) >= thresholds[name] if lower else F.col(name) <= thresholds[name]).alias("met"),
        )
        for name, lower in (
            ("success_rate", True),
            ("check_pass_rate", True),
            ("latency_p95_s", False),
            ("gold_age_h", False),
        )
    ]
    return joined.select(*keys, F.inline(F.array(*levels))).withColumn(
        "status", F.when(F.coalesce("met", F.lit(False)), "ok").otherwise("breach")
    ).drop("met")


def breaches(slos: DataFrame) -> DataFrame:
    return slos.filter(F.col("status") == "breach")


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Row count, schema text and a checksum that does not depend on row order.

    Row hashes are summed as decimals, so copies of a row count and the sum
    cannot overflow.
    """
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    # hashes leave nulls out, so each column's null mark is hashed as well
    marks = [c.isNull() for c in columns]
    row_hash = F.xxhash64(*columns, *marks).cast("decimal(38,0)")
    schema = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in sorted(df.schema, key=lambda f: f.name))
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(schema).alias("schema"),
        F.coalesce(F.sum(row_hash), F.lit(0).cast("decimal(38,0)")).cast("string").alias("checksum"),
    )


def two_group_means(df: DataFrame, group: str, first: str, second: str, value: str) -> DataFrame:
    """Means of two groups with Welch's t statistic and its degrees of freedom."""

    def of(name: str):
        v = F.when(F.col(group) == name, F.col(value))
        return F.avg(v), F.var_samp(v), F.count(v)

    (m1, v1, n1), (m2, v2, n2) = of(first), of(second)
    stats = df.agg(
        m1.alias("mean_a"), v1.alias("_v1"), n1.alias("n_a"),
        m2.alias("mean_b"), v2.alias("_v2"), n2.alias("n_b"),
    )
    e1, e2 = F.try_divide(F.col("_v1"), F.col("n_a")), F.try_divide(F.col("_v2"), F.col("n_b"))
    return stats.select(
        F.lit(first).alias("group_a"),
        F.lit(second).alias("group_b"),
        "n_a", "n_b", "mean_a", "mean_b",
        F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(e1 + e2)).alias("t"),
        F.try_divide(
            (e1 + e2) * (e1 + e2),
            F.try_divide(e1 * e1, F.col("n_a") - 1) + F.try_divide(e2 * e2, F.col("n_b") - 1),
        ).alias("df"),
    )


def step_durations(runs: DataFrame, step: str, ts: str, duration: str) -> DataFrame:
    """Runs, mean, median and 95th percentile of a step's duration per day."""
    daily = runs.withColumn("day", F.to_date(ts))
    basic = daily.groupBy(step, "day").agg(
        F.count(F.lit(1)).alias("runs"), F.avg(duration).alias("avg_duration")
    )
    tail = exact_quantiles(daily, [step, "day"], duration, {"p50_duration": 0.5, "p95_duration": 0.95})
    return null_safe_join(basic, tail, [step, "day"])


def model_costs(
    traces: DataFrame, keys: Sequence[str | Column], tokens: Column, price_per_million: Column
) -> DataFrame:
    """Calls, tokens and cost per model (and day)."""
    return traces.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum(tokens).alias("tokens"),
        F.sum(tokens * price_per_million / F.lit(1e6)).alias("cost"),
    )


def sessions(
    df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, gap_seconds: int,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Runs of rows of a key with less than ``gap_seconds`` between neighbours.

    Rows are compared within segments of time, session numbers are running
    totals over segments, and the sessions themselves are plain aggregates; no
    task sees all rows of a hot key.
    """
    cut, _ = time_segment(df, keys, ts, segment_rows)
    ordered = previous_value(df, keys, [ts, tiebreak], ts, cut, "_previous")
    apart = F.unix_micros(F.col(ts)) - F.unix_micros(F.col("_previous"))
    opens = F.when(apart < F.lit(gap_seconds * 1_000_000), F.lit(0)).otherwise(F.lit(1))
    numbered = running_total(ordered, keys, [ts, tiebreak], opens, cut, "session_no")
    return numbered.groupBy(*keys, "session_no").agg(
        F.min(ts).alias("session_start"),
        F.max(ts).alias("last_seen"),
        F.count(F.lit(1)).alias("n"),
    )
