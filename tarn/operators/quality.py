"""Data-quality checks. A check is a function from tables to a table of findings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STALE_DAYS = 30


def min_rows(df: DataFrame, least: int = 1) -> DataFrame:
    """One row if the table holds fewer than ``least`` rows."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") < least)


def completeness(df: DataFrame, column: str, threshold: float = 0.9) -> DataFrame:
    """One row if too few values are filled; an empty table fails with a null ratio."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(column).alias("filled"),
        F.try_divide(F.count(column).cast("double"), F.count(F.lit(1))).alias("completeness_pct"),
    ).filter(F.col("completeness_pct").isNull() | (F.col("completeness_pct") < threshold))


def not_null(df: DataFrame, column: str) -> DataFrame:
    """The rows lacking a value."""
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, and how often."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the accepted list, and how often they occur."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _freshness_columns(as_of: dt.date, latest: Column, limit: int) -> list[Column]:
    lag = F.datediff(F.lit(as_of), latest)
    return [lag.alias("lag_days"), (latest.isNull() | (lag >= limit)).alias("is_stale")]


def freshness(
    spark: SparkSession,
    sources: Mapping[str, str],
    as_of: dt.date,
    stamp: str = "_ingestion_timestamp",
    limit: int = STALE_DAYS,
) -> DataFrame:
    """Latest ingestion day per Bronze table.

    A table is stale if it is missing, empty, without the column, or ``limit``
    or more days behind. Only the one column is read. ``sources`` maps source
    names to table names.
    """
    rows = []
    for source, table in sources.items():
        if spark.catalog.tableExists(table) and stamp in spark.table(table).columns:
            latest = spark.table(table).agg(F.to_date(F.max(stamp)).alias("latest"))
        else:
            latest = spark.range(1).select(F.lit(None).cast("date").alias("latest"))
        rows.append(latest.select(F.lit(source).alias("source"), "latest"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.select("source", "latest", *_freshness_columns(as_of, F.col("latest"), limit))


def freshness_by_key(
    df: DataFrame, keys: Sequence[str], stamp: str, as_of: dt.date, limit: int = STALE_DAYS
) -> DataFrame:
    """The same rule for the sources held in one table."""
    latest = df.groupBy(*keys).agg(F.to_date(F.max(stamp)).alias("latest"))
    return latest.select(*keys, "latest", *_freshness_columns(as_of, F.col("latest"), limit))


def stale_sources(fresh: DataFrame) -> DataFrame:
    """The sources to ingest again; no row means all are fresh."""
    return fresh.filter("is_stale").drop("is_stale")


def business_freshness(df: DataFrame, day: str, as_of: dt.date, within_days: int) -> DataFrame:
    """Whether the newest business date lies within ``within_days`` of ``as_of``."""
    latest = df.agg(F.to_date(F.max(day)).alias("latest"))
    lag = F.datediff(F.lit(as_of), F.col("latest"))
    return latest.select(
        "latest",
        lag.alias("lag_days"),
        F.coalesce(lag <= within_days, F.lit(False)).alias("is_fresh"),
    )


@dataclass(frozen=True)
class Check:
    """A measured value of a table and the bound it must keep.

    ``measure`` is an aggregate; the check passes if it is at least (``floor``)
    or at most the threshold. A null measure fails.
    """

    name: str
    measure: Column
    threshold: float
    floor: bool = True
    severity: str = "error"


def rows_check(least: int = 1, **kw) -> Check:
    return Check("min_rows", F.count(F.lit(1)), least, **kw)


def completeness_check(column: str, threshold: float = 0.9, **kw) -> Check:
    filled = F.try_divide(F.count(column).cast("double"), F.count(F.lit(1)))
    return Check(f"completeness:{column}", filled, threshold, **kw)


def not_null_check(column: str, **kw) -> Check:
    return Check(f"not_null:{column}", F.count_if(F.col(column).isNull()), 0, floor=False, **kw)


def accepted_check(column: str, values: Sequence, **kw) -> Check:
    bad = F.col(column).isNotNull() & ~F.col(column).isin(*values)
    return Check(f"accepted_values:{column}", F.count_if(bad), 0, floor=False, **kw)


def unique_check(column: str, **kw) -> Check:
    repeats = F.count(column) - F.count_distinct(column)
    return Check(f"unique:{column}", repeats, 0, floor=False, **kw)


def suite(tables: Mapping[str, tuple[DataFrame, Sequence[Check]]]) -> DataFrame:
    """One row per table and check. All checks of a table share one pass over it."""
    reports = []
    for name, (df, checks) in tables.items():
        measured = df.agg(*[c.measure.cast("double").alias(f"_{i}") for i, c in enumerate(checks)])
        rows = []
        for i, c in enumerate(checks):
            observed = F.col(f"_{i}")
            kept = observed >= c.threshold if c.floor else observed <= c.threshold
            failed = F.lit("warn" if c.severity == "warn" else "fail")
            rows.append(
                F.struct(
                    F.lit(name).alias("table_name"),
                    F.lit(c.name).alias("check_name"),
                    F.when(F.coalesce(kept, F.lit(False)), "pass").otherwise(failed).alias("status"),
                    observed.alias("observed"),
                    F.lit(float(c.threshold)).alias("threshold"),
                )
            )
        reports.append(measured.select(F.inline(F.array(*rows))))
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def run_passes(report: DataFrame) -> bool:
    """A run fails on failed checks, not on warnings."""
    return report.filter(F.col("status") == "fail").isEmpty()
