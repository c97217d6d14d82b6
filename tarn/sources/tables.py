"""Catalog tables: scans, ad-hoc SQL, staging views and missing days."""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.session import stage


def scan_table(
    spark: SparkSession,
    namespace: str,
    table: str,
    columns: Sequence[str] | None = None,
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
) -> DataFrame:
    """A lazy scan; a time range on Bronze also prunes the day partitions it implies."""
    df = spark.table(f"{namespace}.{table}")
    for bound, before in ((since, False), (until, True)):
        if bound is None:
            continue
        stamp = F.lit(bound)
        if before:
            df = df.filter(F.col("_ingestion_timestamp") < stamp)
            df = df.filter(F.col("ingestion_day") <= F.to_date(stamp))
        else:
            df = df.filter(F.col("_ingestion_timestamp") >= stamp)
            df = df.filter(F.col("ingestion_day") >= F.to_date(stamp))
    return df.select(*columns) if columns else df


def run_sql(
    spark: SparkSession,
    statement: str,
    schema: str | None = None,
    catalog: str | None = None,
    args: Mapping | None = None,
    timeout_s: float | None = None,
) -> DataFrame:
    """Run one SQL statement with a default catalog and schema.

    An error of the engine is raised as ``ValueError``. With ``timeout_s`` the
    result is computed at once into the scratch folder, and a run that takes
    longer is cancelled and raised as ``TimeoutError``.
    """
    back = (spark.catalog.currentCatalog(), spark.catalog.currentDatabase())
    try:
        if catalog:
            spark.catalog.setCurrentCatalog(catalog)
        if schema:
            spark.catalog.setCurrentDatabase(schema)
        result = spark.sql(statement, args=dict(args or {}))
    except PySparkException as error:
        raise ValueError(str(error)) from error
    finally:
        spark.catalog.setCurrentCatalog(back[0])
        spark.catalog.setCurrentDatabase(back[1])
    return _within(result, timeout_s) if timeout_s else result


def _within(df: DataFrame, timeout_s: float) -> DataFrame:
    context, tag, late = df.sparkSession.sparkContext, f"tarn-{uuid.uuid4().hex}", threading.Event()

    def cancel() -> None:
        late.set()
        context.cancelJobsWithTag(tag)

    timer = threading.Timer(timeout_s, cancel)
    context.addJobTag(tag)
    timer.start()
    try:
        return stage(df, "sql")
    except Exception as error:
        if late.is_set():
            raise TimeoutError(f"statement took longer than {timeout_s} s") from error
        raise ValueError(str(error)) from error
    finally:
        timer.cancel()
        context.removeJobTag(tag)


def staging_view(spark: SparkSession, source_table: str, view: str, permanent: bool = False) -> DataFrame:
    """``SELECT *`` over a table as a view; a missing table is an error."""
    if not spark.catalog.tableExists(source_table):
        raise ValueError(f"source table {source_table!r} does not exist")
    if permanent:
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {source_table}")
    else:
        spark.table(source_table).createOrReplaceTempView(view)
    return spark.table(view)


def missing_days(
    df: DataFrame, keys: Sequence[str], ts: str, start: dt.date, end: dt.date
) -> DataFrame:
    """Days from ``start`` to ``end`` (inclusive) a key holds no row for: the backfill list.

    Rows collapse to distinct (key, day) pairs before anything is shuffled, so
    a key with many rows weighs no more than the length of the calendar.
    """
    loaded = df.select(*keys, F.to_date(ts).alias("day")).distinct()
    span = F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))
    wanted = loaded.select(*keys).distinct().select(*keys, F.explode(span).alias("day"))
    return wanted.join(loaded, [*keys, "day"], "left_anti")
