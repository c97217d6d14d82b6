"""Data-quality checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tarn.operators import quality
from tarn.plans.bindings.registry import events, orders, query, rounded, table
from tarn.session import scratch_database

AS_OF = dt.date(2024, 2, 28)


@query(
    "dq1_min_rows",
    "SELECT count(*) AS row_count FROM supplier HAVING count(*) < 1000000000",
)
def min_rows(spark, sf_dir):
    return quality.min_rows(table(spark, sf_dir, "supplier"), 1_000_000_000)


@query(
    "dq2_completeness",
    """SELECT count(*) AS total, count(nullif(event_type, 'view')) AS filled,
        round(count(nullif(event_type, 'view')) / count(*), 6) AS completeness_pct FROM events
    HAVING count(nullif(event_type, 'view')) / count(*) < 0.9""",
)
def completeness(spark, sf_dir):
    df = events(spark, sf_dir).withColumn("kind", F.nullif(F.col("event_type"), F.lit("view")))
    return quality.completeness(df, "kind").withColumn("completeness_pct", rounded("completeness_pct"))


@query("dq3_not_null", "SELECT c_custkey, c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def not_null(spark, sf_dir):
    df = table(spark, sf_dir, "customer").withColumn("segment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    return quality.not_null(df, "segment").select("c_custkey", "c_nationkey")


@query("dq4_unique", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def unique(spark, sf_dir):
    return quality.unique(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query(
    "dq4_accepted_values",
    "SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY event_type",
)
def accepted_values(spark, sf_dir):
    return quality.accepted_values(events(spark, sf_dir), "event_type", ["view", "click"])


FRESH_SQL = """SELECT user_id, CAST(max(ts) AS DATE) AS latest, CAST(DATE '2024-02-28' - CAST(max(ts) AS DATE) AS INTEGER) AS lag_days,
    DATE '2024-02-28' - CAST(max(ts) AS DATE) >= 30 AS is_stale FROM events GROUP BY user_id"""


@query("dq5_freshness", FRESH_SQL)
def freshness(spark, sf_dir):
    return quality.freshness_by_key(events(spark, sf_dir), ["user_id"], "ts", AS_OF)


@query(
    "dq5_table_freshness",
    """SELECT 'events' AS source, CAST(max(ts) AS DATE) AS latest, CAST(DATE '2024-03-01' - CAST(max(ts) AS DATE) AS INTEGER) AS lag_days,
        DATE '2024-03-01' - CAST(max(ts) AS DATE) >= 30 AS is_stale FROM events
    UNION ALL SELECT 'customer', NULL, NULL, true UNION ALL SELECT 'absent', NULL, NULL, true""",
)
def table_freshness(spark, sf_dir):
    """A table with the column, one without it, and one that does not exist."""
    db = scratch_database(spark, "bronze")
    for name in ("events", "customer"):
        spark.sql(f"CREATE TABLE {db}.{name} USING parquet OPTIONS (path '{sf_dir}/{name}.parquet')")
    sources = {n: f"{db}.{n}" for n in ("events", "customer", "absent")}
    return quality.freshness(spark, sources, dt.date(2024, 3, 1), stamp="ts")


@query("dq6_stale_sources", f"SELECT user_id, latest, lag_days FROM ({FRESH_SQL}) WHERE is_stale")
def stale_sources(spark, sf_dir):
    return quality.stale_sources(freshness(spark, sf_dir))


@query(
    "dq7_business_freshness",
    """SELECT CAST(max(o_orderdate) AS DATE) AS latest, CAST(DATE '2002-01-01' - CAST(max(o_orderdate) AS DATE) AS INTEGER) AS lag_days,
        DATE '2002-01-01' - CAST(max(o_orderdate) AS DATE) <= 180 AS is_fresh FROM orders""",
)
def business_freshness(spark, sf_dir):
    return quality.business_freshness(orders(spark, sf_dir), "o_orderdate", dt.date(2002, 1, 1), 180)


@query(
    "dq8_check_suite",
    """WITH e AS (SELECT count(*) AS n, count(nullif(event_type, 'error')) / count(*) AS filled,
            CAST(count(*) FILTER (event_type NOT IN ('view', 'click')) AS DOUBLE) AS odd, count(event_id) - count(DISTINCT event_id) AS twice FROM events),
        c AS (SELECT count(*) FILTER (c_custkey IS NULL) AS nulls, count(*) AS n FROM customer)
    SELECT 'events' AS table_name, 'min_rows' AS check_name, 'pass' AS status, CAST(n AS DOUBLE) AS observed, 1.0::DOUBLE AS threshold FROM e
    UNION ALL SELECT 'events', 'completeness:kind', CASE WHEN filled >= 0.95 THEN 'pass' ELSE 'warn' END, round(filled, 6), 0.95 FROM e
    UNION ALL SELECT 'events', 'accepted_values:event_type', 'fail', odd, 0 FROM e
    UNION ALL SELECT 'events', 'unique:event_id', CASE WHEN twice = 0 THEN 'pass' ELSE 'fail' END, twice, 0 FROM e
    UNION ALL SELECT 'customer', 'not_null:c_custkey', CASE WHEN nulls = 0 THEN 'pass' ELSE 'fail' END, nulls, 0 FROM c
    UNION ALL SELECT 'customer', 'min_rows', CASE WHEN n >= 1e9 THEN 'pass' ELSE 'warn' END, n, 1e9 FROM c""",
)
def check_suite(spark, sf_dir):
    df = events(spark, sf_dir).withColumn("kind", F.nullif(F.col("event_type"), F.lit("error")))
    report = quality.suite(
        {
            "events": (
                df,
                [
                    quality.rows_check(),
                    quality.completeness_check("kind", 0.95, severity="warn"),
                    quality.accepted_check("event_type", ["view", "click"]),
                    quality.unique_check("event_id"),
                ],
            ),
            "customer": (
                table(spark, sf_dir, "customer"),
                [quality.not_null_check("c_custkey"), quality.rows_check(10**9, severity="warn")],
            ),
        }
    )
    return report.withColumn("observed", rounded("observed"))
