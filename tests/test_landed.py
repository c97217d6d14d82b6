"""Landed response pages: partitions, filters, columns and offsets of the source."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tarn.sources import landed
from tarn.sources.landed import LandedFile, list_landed, plan_slices, read_landed, read_slices, stream_landed


def land(folder, name, lines, end="\n", at=None):
    path = f"{folder}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as file:
        file.write(end.join(lines).encode())
    if at is not None:
        os.utime(path, ns=(at, at))
    return path


@pytest.fixture
def three(folder):
    pick = random.Random(1)
    bodies = {f"d{k}/part-{k}.txt": [f"{k}:{i}:" + "x" * pick.randrange(200) for i in range(300)] for k in range(3)}
    for k, (name, lines) in enumerate(bodies.items()):
        land(folder, name, lines, at=(1_700_000_000 + k) * 10**9)
    return folder, [line for lines in bodies.values() for line in lines]


@pytest.mark.parametrize("size", [1, 7, 64, 199, 1000, 10**9])
def test_ranges_give_each_line_once(folder, size):
    """Whatever the size of the ranges: blank lines, long ones, both line ends, no last one."""
    lines = ["a", "", "  ", "b" * 500, "é日本", "", "c", "d" * 3, "e"]
    for end in ("\n", "\r\n", "\n\n"):
        for tail in ("", end):
            here = tempfile.mkdtemp(prefix="run-")
            land(here, "x", [*lines, ""] if tail else lines, end)
            land(here, "empty", [])
            land(here, "_SUCCESS", ["no"])
            land(here, ".hidden", ["no"])
            parts = plan_slices(list_landed(here, "*"), size, True)
            got = [r for p in parts for b in read_slices(p, here, True, ["position", "body"]) for r in b.to_pylist()]
            assert [r["body"] for r in got] == [x for x in lines if x.strip()]
            raw = open(f"{here}/x", "rb").read()
            assert all(raw[r["position"] :].startswith(r["body"].encode()) for r in got)


def test_lines_longer_than_a_read(folder, monkeypatch):
    monkeypatch.setattr(landed, "BATCH_BYTES", 16)
    lines = ["x" * n for n in (1, 15, 16, 17, 100)]
    land(folder, "x", lines)
    for size in (1, 16, 33, 1000):
        parts = plan_slices(list_landed(folder, "*"), size, True)
        assert [r["body"] for p in parts for b in read_slices(p, folder, True, ["body"]) for r in b.to_pylist()] == lines


def test_partitions_are_bounded():
    files = [LandedFile(f"f{k}", 10 * k, k) for k in range(50)]
    for size in (100, 1000):
        parts = plan_slices(files, size, True)
        assert all(sum(e - f for _, f, e in p.slices) <= size for p in parts)
        assert sum(e - f for p in parts for _, f, e in p.slices) == sum(f.size for f in files)
    assert all(f == 0 and e == file.size for p in plan_slices(files, 100, False) for file, f, e in p.slices)
    assert plan_slices([], 100, True) == []


def test_as_many_tasks_as_partitions(spark, three):
    folder, lines = three
    df = read_landed(spark, f"file://{folder}", partitionBytes=4096)
    planned = len(plan_slices(list_landed(folder, "*"), 4096, True))
    assert planned > 10
    assert df.select(F.spark_partition_id().alias("p")).distinct().count() == planned
    assert sorted(r["body"] for r in df.collect()) == sorted(lines)
    assert read_landed(spark, folder, glob="part-1*").count() == 300
    assert read_landed(spark, folder, bodies="files").count() == 3
    assert read_landed(spark, f"{folder}/nothing").collect() == []


def test_filters_leave_files_unplanned(spark, three):
    folder, lines = three
    df = read_landed(spark, folder, partitionBytes=4096)
    whole = df.select(F.spark_partition_id()).distinct().count()
    late = df.filter(F.col("landed_at") >= dt.datetime.fromtimestamp(1_700_000_002, dt.UTC))
    named = df.filter(F.col("path").startswith(f"{folder}/d1/") & F.col("body").contains("1:7:"))
    assert late.select(F.spark_partition_id()).distinct().count() < whole / 2
    assert {r["body"][0] for r in late.collect()} == {"2"} and late.count() == 300
    assert [r["body"][:4] for r in named.collect()] == ["1:7:"]
    # a filter the source takes is not evaluated again; one on bodies is Spark's
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert "Contains(body" in plan and "StartsWith(path" not in plan.split("BatchScan")[0]
    assert df.filter(F.col("path").isin(f"{folder}/d0/part-0.txt", "no")).count() == 300


def test_only_the_columns_asked_for(spark, three):
    folder, _ = three
    assert read_landed(spark, folder, columns=["position"]).columns == ["position"]
    with pytest.raises(Exception, match="columns are some of"):
        spark.read.format("landed").schema("other string").option("path", folder).load().collect()


def test_stream_takes_what_landed_since(spark, folder):
    """Each run takes the files after the offset of the last one, in a checkpoint that outlives the query."""

    def run():
        stream = stream_landed(spark, f"{folder}/in", partitionBytes=64)
        query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c")
        query.trigger(availableNow=True).start().awaitTermination()
        return sorted(r["body"] for r in spark.read.schema(landed.SCHEMA).parquet(f"{folder}/out").collect())

    land(f"{folder}/in", "b", ["b1", "b2" * 40, "b3"], at=10**18)
    assert run() == ["b1", "b2" * 40, "b3"]
    assert run() == ["b1", "b2" * 40, "b3"]
    land(f"{folder}/in", "a", ["a1"], at=10**18 + 1)  # an earlier name, but later
    land(f"{folder}/in", "c", ["c1"], at=10**18 + 1)
    assert run() == ["a1", "b1", "b2" * 40, "b3", "c1"]
