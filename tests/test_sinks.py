import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tarn.operators import validate
from tarn.operators.aggregates import table_fingerprint
from tarn.session import scratch_database
from tarn.sources import sinks
from tarn.sources.schemas import TableSchema, columns
from tarn.sources.tables import scan_table

NOW = dt.datetime(2024, 5, 1, 12, tzinfo=dt.UTC)
LATER = NOW + dt.timedelta(days=1)
CARBON = TableSchema(
    "carbon_intensity", columns(timestamp_utc="timestamptz", country="string", carbon_intensity_gco2_kwh="double")
)


@pytest.fixture
def db(spark):
    return scratch_database(spark, "test")


def carbon(spark):
    return spark.createDataFrame(
        [(NOW, "ES", 150.0), (NOW, "FR", 80.0)], "timestamp_utc timestamp, country string, carbon_intensity_gco2_kwh double"
    )


def test_bronze_round_trip(spark, db):
    batch = sinks.with_lineage(carbon(spark), "Electricity Maps", NOW)
    sinks.append_table(batch, db, "carbon_intensity", CARBON.bronze())
    sinks.append_table(sinks.with_lineage(carbon(spark), "Electricity Maps", LATER), db, "carbon_intensity", CARBON.bronze())
    stored = spark.table(f"{db}.carbon_intensity")
    assert stored.count() == 4
    assert rows(stored.filter("ingestion_day = '2024-05-01'"), "country", "carbon_intensity_gco2_kwh", "_source") == [
        ("ES", 150.0, "Electricity Maps"), ("FR", 80.0, "Electricity Maps"),
    ]
    assert dict(stored.dtypes)["_ingestion_timestamp"] == "timestamp"


def test_range_scan_prunes_days(spark, db):
    for stamp in (NOW, LATER):
        sinks.append_table(sinks.with_lineage(carbon(spark), "x", stamp), db, "c", CARBON.bronze())
    late = scan_table(spark, db, "c", ["country"], since=LATER)
    assert late.count() == 2
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_day" in plan and "ReadSchema: struct<country:string" in plan


def test_append_refuses_undeclared_columns(spark, db):
    with pytest.raises(ValueError):
        sinks.append_table(carbon(spark).withColumn("extra", F.lit(1)), db, "c", CARBON)


def test_overwrite_is_idempotent_and_may_read_itself(spark, db):
    sinks.overwrite_table(carbon(spark), db, "t")
    once = rows(table_fingerprint(spark.table(f"{db}.t")))
    sinks.overwrite_table(carbon(spark), db, "t")
    sinks.overwrite_table(spark.table(f"{db}.t"), db, "t")
    assert rows(table_fingerprint(spark.table(f"{db}.t"))) == once
    sinks.overwrite_table(spark.table(f"{db}.t").select("country"), db, "t")
    assert spark.table(f"{db}.t").columns == ["country"] and spark.table(f"{db}.t").count() == 2
    sinks.overwrite_table(carbon(spark), db, "p", ["country"])
    sinks.overwrite_table(spark.table(f"{db}.p").filter("country = 'ES'"), db, "p", ["country"])
    assert rows(spark.table(f"{db}.p"), "country") == [("ES",)]


def test_quarantine(spark, db):
    bad = spark.createDataFrame([("record", None, "invalid schema")], "bad string, n int, rejection_reason string")
    assert sinks.write_rejected(bad, db, "ECB", NOW) == 1
    stored = spark.table(f"{db}.rejected_records")
    assert rows(stored, "source", "rejection_reason", "payload") == [("ECB", "invalid schema", '{"bad":"record","n":null}')]


def test_quarantine_of_nothing_creates_nothing(spark, db):
    empty = spark.createDataFrame([], "bad string, rejection_reason string")
    assert sinks.write_rejected(empty, db, "ECB", NOW) == 0
    assert not spark.catalog.tableExists(f"{db}.rejected_records")


@pytest.mark.parametrize("reason", [None, "  "])
def test_quarantine_needs_reasons(spark, db, reason):
    bad = spark.createDataFrame([("x", reason)], "data string, rejection_reason string")
    with pytest.raises(ValueError):
        sinks.write_rejected(bad, db, "ECB", NOW)


def test_upsert_without_partitions(spark, db):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    sinks.upsert_table(old, db, "m", ["k"])
    sinks.upsert_table(new, db, "m", ["k"])
    sinks.upsert_table(new, db, "m", ["k"])
    assert rows(spark.table(f"{db}.m")) == [(1, "a"), (2, "B"), (3, "C")]
    with pytest.raises(ValueError):
        sinks.upsert_table(new.union(new), db, "m", ["k"])


def test_upsert_leaves_other_partitions_alone(spark, db):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (4, "d", 2)], "k int, v string, p int")
    new = spark.createDataFrame([(2, "B", 2), (3, "C", 3)], "k int, v string, p int")
    sinks.upsert_table(old, db, "q", ["k"], "p")
    before = {r[0] for r in spark.table(f"{db}.q").filter("p = 1").select("_metadata.file_path").collect()}
    sinks.upsert_table(new, db, "q", ["k"], "p")
    after = {r[0] for r in spark.table(f"{db}.q").filter("p = 1").select("_metadata.file_path").collect()}
    assert rows(spark.table(f"{db}.q"), "k", "v", "p") == [(1, "a", 1), (2, "B", 2), (3, "C", 3), (4, "d", 2)]
    assert before == after


@pytest.mark.parametrize("read_once", [True, False])
def test_ingest(spark, db, read_once):
    raw = spark.createDataFrame([("1", "x", 9), ("two", "y", 9), ("3", None, 9)], "id string, name string, extra int")
    schema = TableSchema("people", columns(id="long", name="string", city="string"))
    counts = validate.ingest(raw, "people", schema, NOW, [validate.required("name")], db, read_once)
    assert counts == {"valid": 1, "rejected": 2}
    assert rows(spark.table(f"{db}.people"), "id", "name", "city", "_source") == [(1, "x", None, "people")]
    assert rows(spark.table(f"{db}.rejected_records"), "rejection_reason") == [("missing:name",), ("type:id",)]
    assert spark.table(f"{db}.people").columns[-1] == "ingestion_day"


def test_projection(spark):
    raw = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, name string, extra int")
    out = validate.project(raw, columns(id="int", name="string", late="double", _source="string"))
    assert out.columns == ["id", "name", "late"]


def test_redelivery_is_skipped(spark):
    table = spark.createDataFrame([("a", 1)], "t string, n int")
    raw = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), ("b", None)], "t string, n int")
    assert rows(validate.skip_redelivered(raw, table, ["t", "n"]), "t", "n") == [("a", 2), ("b", None)]
    assert rows(validate.skip_ingested(raw, table, ["t"]), "t") == [("b",), ("b",)]
