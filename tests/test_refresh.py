"""Refresh of derived tables by what is new, and replacement of partitions."""

import datetime as dt
import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tarn.plans import refresh as module
from tarn.plans.bindings.chain import daily_features, hourly_totals
from tarn.plans.refresh import Step, refresh
from tarn.session import scratch_database, stage
from tarn.sources.schemas import TableSchema, columns
from tarn.operators.validate import ingest
from tarn.sources.sinks import drop_old_versions, overwrite_table, replace_partitions

SCHEMA = TableSchema("events", columns(event_id="long", ts="timestamptz", event_type="string", value="double"))
START = dt.datetime(2024, 5, 1, tzinfo=dt.UTC)


def drop(spark, db, day, made):
    """One batch of (minute of START, type, value), arrived on a day of June."""
    given = [(k, START + dt.timedelta(minutes=m) if m is not None else None, t, float(v)) for k, (m, t, v) in enumerate(made)]
    df = spark.createDataFrame(given, "event_id long, ts timestamp, event_type string, value double")
    ingest(df, "events", SCHEMA, dt.datetime(2024, 6, day, tzinfo=dt.UTC), (), db, read_once=False)


def steps(db):
    return [Step("hourly", f"{db}.events", hourly_totals), Step("daily", "hourly", daily_features, back=2)]


def whole(spark, db):
    """Both tables made from all of Bronze."""
    hourly = hourly_totals(spark.table(f"{db}.events").filter("ts IS NOT NULL"))
    return rows(hourly), rows(daily_features(hourly))


def made(spark, db):
    hourly, daily = spark.table(f"{db}.hourly"), spark.table(f"{db}.daily")
    return rows(hourly, "event_type", "hour", "n", "cents", "day"), rows(daily)


def some(pick, days, n=40):
    return [(pick.choice(days) * 1440 + pick.randrange(1440), pick.choice("abc"), pick.randrange(100)) for _ in range(n)]


def test_refreshed_tables_equal_a_rebuild(spark):
    db, pick = scratch_database(spark, "refresh"), random.Random(4)
    drops = [(1, some(pick, range(10))), (2, some(pick, [9, 10, 11])), (3, [*some(pick, [2], 3), (None, "a", 1.0)]), (4, [(None, "b", 2.0)]), (9, some(pick, [30], 2))]
    expected = [set(range(10)), {9, 10, 11}, {2}, set(), {30}]
    for (day, made_), touched in zip(drops, expected):
        drop(spark, db, day, made_)
        got = refresh(spark, f"{db}.events", "ts", steps(db), db)
        numbers = {name: {(d - START.date()).days for d in days} for name, days in got.items()}
        # the days that are new, and those that look back on them
        assert numbers["hourly"] <= touched and (len(touched) > 3 or numbers["hourly"] == touched)
        assert numbers["daily"] == {d + k for d in numbers["hourly"] for k in range(3)}
        assert made(spark, db) == whole(spark, db)
    assert refresh(spark, f"{db}.events", "ts", steps(db), db) == {"hourly": [], "daily": []}


def test_only_needed_partitions_are_read(spark):
    """Of Bronze the arrival days that hold the days, of a derived table the days themselves."""
    db, pick = scratch_database(spark, "refresh"), random.Random(5)
    for day in (1, 2, 3, 4):
        drop(spark, db, day, some(pick, [day * 10, day * 10 + 1]))
    refresh(spark, f"{db}.events", "ts", steps(db), db)
    drop(spark, db, 5, some(pick, [20], 3))
    read = {}

    def seen(name, compute):
        def run(source):
            read[name] = source.inputFiles()
            plan = source._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
            return compute(source)

        return run

    watched = [Step(s.table, s.source, seen(s.table, s.compute), s.back) for s in steps(db)]
    untouched = {r["partition"]: None for r in spark.sql(f"SHOW PARTITIONS {db}.hourly").collect()}
    refresh(spark, f"{db}.events", "ts", watched, db)
    arrivals = {part for file in read["hourly"] for part in file.split("/") if part.startswith("ingestion_day=")}
    assert arrivals == {"ingestion_day=2024-06-02", "ingestion_day=2024-06-05"}
    days = {part for file in read["daily"] for part in file.split("/") if part.startswith("day=")}
    assert days == {"day=2024-05-21", "day=2024-05-22"} and len(untouched) == 8
    assert made(spark, db) == whole(spark, db)


@pytest.mark.parametrize("failing", ["_set_mark", "replace_partitions"])
def test_a_refresh_that_failed_is_run_again(spark, monkeypatch, failing):
    db, pick = scratch_database(spark, "refresh"), random.Random(6)
    drop(spark, db, 1, some(pick, range(5)))
    refresh(spark, f"{db}.events", "ts", steps(db), db)
    drop(spark, db, 2, some(pick, [3, 6]))
    kept, calls = getattr(module, failing), []

    def fails(*args):
        calls.append(args)
        if failing == "_set_mark" or len(calls) == 2:
            raise OSError("lost")
        return kept(*args)

    monkeypatch.setattr(module, failing, fails)
    with pytest.raises(OSError):
        refresh(spark, f"{db}.events", "ts", steps(db), db)
    monkeypatch.setattr(module, failing, kept)
    refresh(spark, f"{db}.events", "ts", steps(db), db)
    assert made(spark, db) == whole(spark, db)


def test_a_batch_stored_late(spark):
    """Its time is below the mark; an overlap finds it."""
    db, pick = scratch_database(spark, "refresh"), random.Random(7)
    for day in (1, 3):
        drop(spark, db, day, some(pick, range(4)))
    refresh(spark, f"{db}.events", "ts", steps(db), db)
    drop(spark, db, 2, some(pick, [1, 8]))
    assert refresh(spark, f"{db}.events", "ts", steps(db), db)["hourly"] == []
    refresh(spark, f"{db}.events", "ts", steps(db), db, dt.timedelta(days=2))
    assert made(spark, db) == whole(spark, db)


def test_a_step_needs_a_known_source(spark):
    db = scratch_database(spark, "refresh")
    drop(spark, db, 1, [(1, "a", 1)])
    with pytest.raises(ValueError, match="neither"):
        refresh(spark, f"{db}.events", "ts", [Step("x", "other", hourly_totals)], db)


def keyed(spark, *pairs):
    return spark.createDataFrame(pairs, "v long, `p q` string")


def test_replaced_partitions(spark):
    """Any text names a partition; the others stay where they are, and a value without rows goes."""
    db = scratch_database(spark, "sinks")
    odd = ["a", "b/c", "d=e", "f'g", "h%2Fi", "j k", None]
    replace_partitions(keyed(spark, *[(k, p) for k, p in enumerate(odd)]), db, "t", "p q", odd)
    before = {f for f in spark.table(f"{db}.t").inputFiles()}
    replace_partitions(keyed(spark, (10, "b/c"), (11, "new"), (12, "f'g")), db, "t", "p q", ["b/c", "new", "f'g", "d=e", "never"])
    assert rows(spark.table(f"{db}.t")) == sorted(
        [(0, "a"), (10, "b/c"), (12, "f'g"), (4, "h%2Fi"), (5, "j k"), (6, None), (11, "new")], key=repr
    )
    assert len(before & set(spark.table(f"{db}.t").inputFiles())) == 4
    with pytest.raises(ValueError, match="other columns"):
        replace_partitions(keyed(spark, (1, "a")).withColumnRenamed("v", "w"), db, "t", "p q", ["a"])


def test_a_partitioned_table_is_never_absent(spark, monkeypatch):
    db = scratch_database(spark, "sinks")
    overwrite_table(keyed(spark, (1, "a"), (2, "b")), db, "t", ["p q"])
    statements, run = [], spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (statements.append(text), run(text, *a, **k))[1])
    overwrite_table(spark.table(f"{db}.t").withColumn("v", F.col("v") + 10).filter("v > 11").union(keyed(spark, (3, "c"))), db, "t", ["p q"])
    assert rows(spark.table(f"{db}.t")) == [(12, "b"), (3, "c")]
    assert not any("DROP TABLE" in s for s in statements)


@pytest.mark.parametrize("partition_by", [[], ["p q"]])
def test_old_versions_go(spark, partition_by):
    db = scratch_database(spark, "sinks")
    for k in range(3):
        overwrite_table(keyed(spark, (k, "a"), (k, "b")), db, "t", partition_by)
    if partition_by:
        replace_partitions(keyed(spark, (9, "b")), db, "t", "p q", ["b"])
    want = rows(spark.table(f"{db}.t"))
    assert len(drop_old_versions(spark, db, "t")) == 2
    assert rows(spark.table(f"{db}.t")) == want
    assert drop_old_versions(spark, db, "t") == []
    # what a read staged before holds on to its version only until then
    assert rows(stage(spark.table(f"{db}.t"))) == want
