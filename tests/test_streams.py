"""Streams against their batch forms; nothing lost, nothing repeated."""

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tarn.operators import validate
from tarn.operators.aggregates import sessions
from tarn.operators.validate import at_most
from tarn.session import scratch_database
from tarn.sources.schemas import TableSchema, columns
from tarn.streaming import ingest, windows

UTC = dt.UTC
SCHEMA = "id long, k string, ts timestamp, v double"


def batch(spark, first, n):
    start = dt.datetime(2024, 1, 1, tzinfo=UTC)
    data = [(i, "ab"[i % 2], start + dt.timedelta(minutes=7 * i), float(i % 13)) for i in range(first, first + n)]
    return spark.createDataFrame(data, SCHEMA)


def test_two_drops_of_files(spark, folder):
    schema = batch(spark, 0, 1).schema
    run = lambda: ingest.ingest_arrivals(
        ingest.read_arrivals(spark, f"{folder}/in", schema, files_per_batch=2),
        "s", [at_most("v", 10)], f"{folder}/valid", f"{folder}/rejected", f"{folder}/checkpoint",
    )
    batch(spark, 0, 100).repartition(3).write.mode("append").parquet(f"{folder}/in")
    run()
    batch(spark, 100, 50).repartition(2).write.mode("append").parquet(f"{folder}/in")
    run()
    run()
    valid = spark.read.parquet(f"{folder}/valid")
    rejected = spark.read.parquet(f"{folder}/rejected")
    assert valid.count() + rejected.count() == 150
    assert rows(valid, "id") == rows(batch(spark, 0, 150).filter("v <= 10"), "id")
    assert {r[0] for r in rows(rejected, "rejection_reason")} == {"above:v"}
    assert valid.select("_ingestion_timestamp").distinct().count() <= valid.select("batch_id").distinct().count()


def test_a_failed_batch_lands_once(spark, folder, monkeypatch):
    db = scratch_database(spark, "landed")
    schema = TableSchema("s", columns(id="long", v="double"))
    run = lambda: ingest.ingest_arrivals_to_bronze(
        ingest.read_arrivals(spark, f"{folder}/in", batch(spark, 0, 1).schema, files_per_batch=1),
        "s", schema, f"{folder}/checkpoint", [at_most("v", 10)], db,
    )
    batch(spark, 0, 100).repartition(3).write.parquet(f"{folder}/in")
    with monkeypatch.context() as broken:
        broken.setattr(validate, "write_rejected", lambda *a: 1 / 0)
        with pytest.raises(Exception, match="ZeroDivisionError"):
            run()
    run()
    assert run() == {"valid": 0, "rejected": 0}
    stored = spark.table(f"{db}.s")
    assert rows(stored, "id") == rows(batch(spark, 0, 100).filter("v <= 10"), "id")
    assert stored.select("_ingestion_timestamp").distinct().count() == 3 and "ingestion_day" in stored.columns
    assert stored.count() + spark.table(f"{db}.rejected_records").count() == 100


def test_redelivered_rows_are_dropped(spark, folder):
    for _ in range(2):
        batch(spark, 0, 60).write.mode("append").parquet(f"{folder}/in")
        stream = ingest.read_arrivals(spark, f"{folder}/in", batch(spark, 0, 1).schema)
        ingest.run_to_files(ingest.guard_redelivery(stream, ["id"], "ts", "2 days"), f"{folder}/out", f"{folder}/checkpoint")
    assert rows(spark.read.parquet(f"{folder}/out"), "id") == rows(batch(spark, 0, 60), "id")


def test_closed_windows_equal_the_batch(spark, folder):
    data = batch(spark, 0, 300)
    data.repartition(4).write.parquet(f"{folder}/in")
    measures = {"n": F.count(F.lit(1)), "s": F.sum("v")}
    stream = ingest.read_arrivals(spark, f"{folder}/in", data.schema)
    ingest.run_to_files(windows.tumbling(stream, ["k"], "ts", measures), f"{folder}/out", f"{folder}/checkpoint")
    closed = data.agg(F.max("ts")).first()[0] - dt.timedelta(hours=1)
    want = windows.tumbling(data, ["k"], "ts", measures).filter(F.col("window_start") + F.expr("INTERVAL 1 HOUR") <= F.lit(closed))
    got = spark.read.parquet(f"{folder}/out")
    assert rows(got, "k", "window_start", "n", "s") == rows(want, "k", "window_start", "n", "s")
    assert got.count() > 50


def test_batch_sessions_equal_both_forms(spark):
    data = batch(spark, 0, 300).filter("id % 10 < 6")
    a = windows.session_counts(data, ["k"], "ts", "20 minutes")
    b = sessions(data, ["k"], "ts", "id", 20 * 60)
    assert rows(a, "k", "session_start", "n") == rows(b, "k", "session_start", "n")
