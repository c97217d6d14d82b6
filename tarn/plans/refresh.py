"""Refresh of derived tables by what is new in Bronze.

Bronze is partitioned by the day of arrival, derived tables by the day their rows are
about. A late row makes an old day new. So that a refresh reads little:

- ``refresh_marks`` has, per Bronze table, the ingestion time (microseconds) up to which it was used.
  Rows above the mark are found in the partitions from that day on.
- ``refresh_arrivals`` says which arrival days hold rows of which days. The days that a
  step needs again are read from those Bronze partitions only.
- A step says how many days before a day its rows depend on. Days that are new, and the
  days after them that look back on them, are computed again; nothing else is. The
  partitions of those days are then replaced, one by one and each at once.

The mark is written last. A refresh that fails is simply run again: what it replaced
before is computed from the same rows and replaced by the same.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.session import stage
from tarn.sources.schemas import PARTITION_COLUMN
from tarn.sources.sinks import overwrite_table, replace_partitions

MARKS, ARRIVALS = "refresh_marks", "refresh_arrivals"


@dataclass(frozen=True)
class Step:
    """A derived table.

    ``compute`` takes rows of the source and returns rows with a date ``day``, the
    partition of the table. For a day it must need no rows of the source but those about that day and
    the ``back`` days before. ``source`` is the Bronze table or the table of an earlier step.
    """

    table: str
    source: str
    compute: Callable[[DataFrame], DataFrame]
    back: int = 0


def refresh(
    spark: SparkSession, bronze: str, event_time: str, steps: Sequence[Step], namespace: str, overlap: dt.timedelta = dt.timedelta(0)
) -> dict[str, list[dt.date]]:
    """Bring the tables of ``steps`` up to date with the Bronze table; the days that each one replaced.

    ``bronze`` is a table with ``ingestion_day`` and ``_ingestion_timestamp``; the tables
    of the steps, the marks and the arrivals are in ``namespace``. Rows whose
    ``event_time`` is null are about no day and are left out. A batch that is stored after
    another one was used, but has an older time, is found if it is within ``overlap`` of
    the mark: what arrived since then is taken as new again, which changes nothing else.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
    mark = _mark(spark, namespace, bronze)
    rows = spark.table(bronze).withColumn("_day", F.to_date(event_time))
    arrival = F.unix_micros("_ingestion_timestamp")
    fresh = rows
    if mark is not None:
        since = F.lit(mark - overlap // dt.timedelta(microseconds=1))
        # the day prunes partitions
        fresh = rows.filter((F.col(PARTITION_COLUMN) >= F.to_date(F.timestamp_micros(since))) & (arrival > since))
    # as many rows as days arrived times days they are about
    arrived = stage(
        fresh.groupBy("_day", F.col(PARTITION_COLUMN).alias("arrival")).agg(F.max(arrival).alias("_last")), "arrivals"
    )
    last = arrived.agg(F.max("_last").alias("t")).first()["t"]
    if last is None:
        return {step.table: [] for step in steps}
    changed = {bronze: _days(arrived, "_day")}
    index = _indexed(spark, namespace, bronze, arrived)

    for step in steps:
        if step.source not in changed:
            raise ValueError(f"{step.table} reads {step.source!r}, which is neither the Bronze table nor an earlier step's")
        days = _spread(changed[step.source], 0, step.back)
        needed = _spread(days, step.back, 0)
        if step.source == bronze:
            places = _days(index.filter(F.col("_day").isin(needed)), "arrival") if needed else []
            # the arrival days prune partitions, the days rows
            source = rows.filter(F.col(PARTITION_COLUMN).isin(places) & F.col("_day").isin(needed)).drop("_day")
        else:
            table = spark.table(f"{namespace}.{step.source}")
            source = table.filter(F.col("day").isin(needed))
        if days:
            result = step.compute(source)
            replace_partitions(result.filter(F.col("day").isin(days)), namespace, step.table, "day", days)
        changed[step.table] = days
    _set_mark(spark, namespace, bronze, max(last, mark or last))
    return {step.table: changed[step.table] for step in steps}


def _days(df: DataFrame, column: str) -> list[dt.date]:
    """Distinct days; a calendar has few."""
    return sorted(r[0] for r in df.select(column).distinct().collect() if r[0] is not None)


def _spread(days: Sequence[dt.date], before: int, after: int) -> list[dt.date]:
    return sorted({d + dt.timedelta(k) for d in days for k in range(-before, after + 1)})


def _table(spark: SparkSession, name: str, schema: str) -> DataFrame:
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


_MARK_SCHEMA = "bronze string, mark long"
_ARRIVAL_SCHEMA = "bronze string, _day date, arrival date"


def _mark(spark: SparkSession, namespace: str, bronze: str) -> int | None:
    found = _table(spark, f"{namespace}.{MARKS}", _MARK_SCHEMA).filter(F.col("bronze") == bronze).first()
    return None if found is None else found["mark"]


def _set_mark(spark: SparkSession, namespace: str, bronze: str, mark: int) -> None:
    others = _table(spark, f"{namespace}.{MARKS}", _MARK_SCHEMA).filter(F.col("bronze") != bronze)
    own = spark.createDataFrame([(bronze, mark)], _MARK_SCHEMA)
    overwrite_table(others.unionByName(own).coalesce(1), namespace, MARKS)


def _indexed(spark: SparkSession, namespace: str, bronze: str, arrived: DataFrame) -> DataFrame:
    """Which arrival days hold which days of the Bronze table, with what has arrived put in."""
    known = _table(spark, f"{namespace}.{ARRIVALS}", _ARRIVAL_SCHEMA)
    more = arrived.filter("_day IS NOT NULL").select(F.lit(bronze).alias("bronze"), "_day", "arrival")
    overwrite_table(known.unionByName(more).distinct().coalesce(1), namespace, ARRIVALS)
    return spark.table(f"{namespace}.{ARRIVALS}").filter(F.col("bronze") == bronze)
