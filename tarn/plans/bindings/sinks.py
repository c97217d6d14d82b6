"""Sinks and table life cycle. Each query writes fresh tables and reads them back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tarn.operators.validate import at_most, one_of, split
from tarn.plans.bindings.registry import events, orders, query, rounded, table
from tarn.session import scratch_database, scratch_path
from tarn.sources import sinks
from tarn.sources.files import read_nanosecond_parquet
from tarn.sources.schemas import TableSchema, columns, declared_schema
from tarn.sources.tables import scan_table

FIRST = dt.datetime(2024, 2, 1, 6, tzinfo=dt.UTC)
SECOND = dt.datetime(2024, 2, 2, 6, tzinfo=dt.UTC)

EVENT_SCHEMA = TableSchema(
    "events",
    columns(event_id="long", ts="timestamptz", user_id="long", event_type="string", value="double"),
).bronze()


def _append_events(spark, sf_dir, batches):
    db = scratch_database(spark, "bronze")
    raw = events(spark, sf_dir).drop("props")
    for stamp in batches:
        sinks.append_table(sinks.with_lineage(raw, "events", stamp), db, "events", EVENT_SCHEMA)
    return db


@query(
    "snk1_bronze_append",
    """SELECT d.day AS ingestion_day, event_type, count(*) AS n, round(sum(value), 2) AS total
    FROM events, (VALUES (DATE '2024-02-01'), (DATE '2024-02-02')) d(day) GROUP BY ALL""",
)
def bronze_append(spark, sf_dir):
    db = _append_events(spark, sf_dir, [FIRST, SECOND])
    return spark.table(f"{db}.events").groupBy("ingestion_day", "event_type").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum("value"), 2).alias("total")
    )


@query(
    "snk1_bronze_range_scan",
    "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
)
def bronze_range_scan(spark, sf_dir):
    """Of two appended days a range scan opens one."""
    db = _append_events(spark, sf_dir, [FIRST, SECOND])
    day = scan_table(spark, db, "events", since=SECOND.replace(hour=0))
    return day.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "snk2_overwrite_twice",
    """SELECT CAST(o_orderdate AS DATE) AS order_day, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY ALL""",
)
def overwrite_twice(spark, sf_dir):
    """The second run reads the table it replaces."""
    db = scratch_database(spark, "silver")
    daily = (
        orders(spark, sf_dir).groupBy(F.col("o_orderdate").alias("order_day"))
        .agg(rounded(F.sum("o_totalprice"), 2).alias("total"))
    )
    sinks.overwrite_table(daily, db, "daily")
    sinks.overwrite_table(spark.table(f"{db}.daily"), db, "daily")
    return spark.table(f"{db}.daily")


@query(
    "snk3_quarantine",
    """SELECT 'events' AS source,
        CASE WHEN value > 50 THEN 'above:value' ELSE 'value:event_type' END AS rejection_reason,
        event_id, value, user_id
    FROM events WHERE value > 50 OR event_type = 'error'""",
)
def quarantine(spark, sf_dir):
    db = scratch_database(spark, "bronze")
    rules = [at_most("value", 50), one_of("event_type", ["view", "signup", "purchase", "click"])]
    _, rejected = split(events(spark, sf_dir), rules)
    sinks.write_rejected(rejected, db, "events", FIRST)
    payload = F.from_json("payload", "event_id long, value double, user_id long")
    return spark.table(f"{db}.{sinks.REJECTED_TABLE}").select(
        "source", "rejection_reason", payload.alias("p")
    ).select("source", "rejection_reason", "p.*")


@query(
    "snk4_lineage_columns",
    """SELECT event_id, TIMESTAMP '2024-02-01 06:00:00' AS ingested_at, 'events' AS _source FROM events""",
)
def lineage_columns(spark, sf_dir):
    df = sinks.with_lineage(events(spark, sf_dir), "events", FIRST)
    return df.select("event_id", F.col("_ingestion_timestamp").cast("timestamp_ntz").alias("ingested_at"), "_source")


@query("snk5_nanosecond_times", "SELECT event_id, ts FROM events")
def nanosecond_times(spark, sf_dir):
    """Event times as nanosecond counts, some of them between two microseconds."""
    path = scratch_path(spark, "nanos")
    nanos = F.unix_micros("ts") * 1000 + F.col("event_id") % 1000
    events(spark, sf_dir).select("event_id", nanos.alias("ts")).write.parquet(path)
    schema = columns(event_id="long", ts="long")
    return read_nanosecond_parquet(spark, path, schema, {"ts": "timestamp"})


@query(
    "snk6_schema_on_write",
    """SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total, min(CAST(o_orderdate AS DATE)) AS first_day,
        CAST(count(*) AS BIGINT) AS empty_comments FROM orders""",
)
def schema_on_write(spark, sf_dir):
    """Text columns are cast to the declared types on the way in."""
    db = scratch_database(spark, "bronze")
    schema = declared_schema(
        {
            "source": "orders",
            "columns": [
                {"name": "o_orderkey", "type": "long"},
                {"name": "o_totalprice", "type": "double"},
                {"name": "o_orderdate", "type": "date"},
                {"name": "o_comment", "type": "string"},
            ],
        }
    )
    text = orders(spark, sf_dir).select(
        *[F.col(c).cast("string") for c in ("o_orderkey", "o_totalprice", "o_orderdate")]
    )
    sinks.append_table(text, db, "orders", schema)
    return spark.table(f"{db}.orders").agg(
        F.count("o_orderkey").alias("n"),
        rounded(F.sum("o_totalprice"), 2).alias("total"),
        F.min("o_orderdate").alias("first_day"),
        F.count_if(F.col("o_comment").isNull()).alias("empty_comments"),
    )


@query(
    "snk7_keyed_upsert",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS event_date, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL)
    SELECT event_date, CASE WHEN event_date >= DATE '1999-07-01' THEN round(total * 2, 2) ELSE total END AS total,
        CAST(year(event_date) AS INTEGER) AS event_year FROM d""",
)
def keyed_upsert(spark, sf_dir):
    """Days to the end of 1999 exist; days from July 1999 on arrive with doubled totals."""
    db = scratch_database(spark, "gold")
    daily = (
        orders(spark, sf_dir).groupBy(F.col("o_orderdate").alias("event_date"))
        .agg(rounded(F.sum("o_totalprice"), 2).alias("total"))
        .withColumn("event_year", F.year("event_date"))
    )
    sinks.upsert_table(daily.filter("event_date < '2000-01-01'"), db, "days", ["event_date"], "event_year")
    late = daily.filter("event_date >= '1999-07-01'").withColumn("total", rounded(F.col("total") * 2, 2))
    sinks.upsert_table(late, db, "days", ["event_date"], "event_year")
    return spark.table(f"{db}.days")


@query(
    "snk8_run_archive",
    "SELECT CAST(ts AS DATE) AS run_date, count(*) AS runs FROM events GROUP BY ALL",
)
def run_archive(spark, sf_dir):
    db = scratch_database(spark, "audit")
    sinks.archive_runs(events(spark, sf_dir), db, "runs", "ts")
    return spark.table(f"{db}.runs").groupBy("run_date").agg(F.count(F.lit(1)).alias("runs"))
