"""Streaming forms, run to the end of the present input and compared with tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarn.operators.validate import at_most, one_of
from tarn.plans.bindings.aggregates import SESSION_SQL
from tarn.plans.bindings.registry import ntz, query, rounded, table
from tarn.session import scratch_database, scratch_path
from tarn.sources import tables
from tarn.sources.schemas import TableSchema, columns
from tarn.streaming import ingest, windows


def _arrivals(spark, sf_dir, folder=None, **kw):
    schema = table(spark, sf_dir, "events").schema
    return ingest.read_arrivals(spark, folder or sf_dir, schema, glob="events.parquet" if folder is None else None, **kw)


def _instants(stream):
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    "str1_incremental_ingest",
    """SELECT event_type, count(*) FILTER (event_type <> 'error' AND value <= 50) AS stored,
        count(*) FILTER (event_type = 'error' OR value > 50) AS quarantined FROM events GROUP BY event_type""",
)
def incremental_ingest(spark, sf_dir):
    """All files twice over the same checkpoint: the second run finds nothing new."""
    base = scratch_path(spark, "ingest")
    rules = [at_most("value", 50), one_of("event_type", ["view", "signup", "purchase", "click"])]
    for _ in range(2):
        ingest.ingest_arrivals(
            _arrivals(spark, sf_dir), "events", rules, f"{base}/valid", f"{base}/rejected", f"{base}/checkpoint"
        )
    stored = spark.read.parquet(f"{base}/valid").select("event_type", F.lit(1).alias("good"))
    held = spark.read.parquet(f"{base}/rejected").select(
        F.get_json_object("payload", "$.event_type").alias("event_type"), F.lit(0).alias("good")
    )
    return stored.unionByName(held).groupBy("event_type").agg(
        F.count_if(F.col("good") == 1).alias("stored"), F.count_if(F.col("good") == 0).alias("quarantined")
    )


@query(
    "str1_bronze_table",
    """SELECT event_type, count(*) FILTER (event_type <> 'error' AND value <= 50) AS stored,
        count(*) FILTER (event_type = 'error' OR value > 50) AS quarantined, 1::BIGINT AS fresh FROM events GROUP BY event_type""",
)
def bronze_table(spark, sf_dir):
    """Streamed files in the Bronze table of their source: three files, and nothing new in a second run."""
    base, db = scratch_path(spark, "arrivals"), scratch_database(spark, "bronze")
    table(spark, sf_dir, "events").repartition(3).write.parquet(f"{base}/in")
    schema = TableSchema("events", columns(event_id="long", user_id="long", event_type="string", value="double"))
    rules = [at_most("value", 50), one_of("event_type", ["view", "signup", "purchase", "click"])]
    for _ in range(2):
        arrivals = _arrivals(spark, sf_dir, f"{base}/in", files_per_batch=1)
        ingest.ingest_arrivals_to_bronze(arrivals, "events", schema, f"{base}/checkpoint", rules, db)
    stored = tables.scan_table(spark, db, "events").select("event_type", "_ingestion_timestamp", F.lit(1).alias("good"))
    held = spark.table(f"{db}.rejected_records").select(
        F.get_json_object("payload", "$.event_type").alias("event_type"), F.col("_ingested_at").alias("_ingestion_timestamp"), F.lit(0).alias("good")
    )
    rows = stored.unionByName(held)
    fresh = F.count_distinct(F.when(F.col("_ingestion_timestamp") > F.current_timestamp() - F.expr("INTERVAL 1 DAY"), 1))
    return rows.groupBy("event_type").agg(
        F.count_if(F.col("good") == 1).alias("stored"), F.count_if(F.col("good") == 0).alias("quarantined"), fresh.alias("fresh")
    )


@query("str2_redelivery_guard", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type")
def redelivery_guard(spark, sf_dir):
    """The same rows arrive in two files."""
    base = scratch_path(spark, "redelivery")
    source = table(spark, sf_dir, "events")
    for _ in range(2):
        source.write.mode("append").parquet(f"{base}/in")
    stream = ingest.guard_redelivery(_instants(_arrivals(spark, sf_dir, f"{base}/in")), ["event_id"], "ts", "40 days")
    ingest.run_to_files(stream, f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum("value"), 2).alias("total")
    )


@query(
    "str3_tumbling_hours",
    """WITH w AS (SELECT event_type, date_trunc('hour', ts) AS window_start, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL)
    SELECT * FROM w WHERE window_start + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)""",
)
def tumbling_hours(spark, sf_dir):
    """Hours that the watermark, one hour behind the newest event, has closed."""
    base = scratch_path(spark, "tumbling")
    measures = {"n": F.count(F.lit(1)), "total": F.sum("value")}
    stream = windows.tumbling(_instants(_arrivals(spark, sf_dir)), ["event_type"], "ts", measures)
    ingest.run_to_files(stream, f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select(
        "event_type", ntz("window_start").alias("window_start"), "n", rounded("total", 2).alias("total")
    )


@query(
    "str4_sessions",
    SESSION_SQL + """, w AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n
        FROM s GROUP BY user_id, session_no)
    SELECT * FROM w WHERE session_end <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)""",
)
def streamed_sessions(spark, sf_dir):
    """Six-hour sessions per user that the watermark has closed."""
    base = scratch_path(spark, "sessions")
    stream = windows.session_counts(_instants(_arrivals(spark, sf_dir)), ["user_id"], "ts", "6 hours")
    ingest.run_to_files(stream, f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select(
        "user_id", ntz("session_start").alias("session_start"), ntz("session_end").alias("session_end"), "n"
    )
