import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.functions import fixed_values
from tarn.session import scratch_database
from tarn.sources import connect, database, envelopes, files, schemas, tables


def test_declared_schema():
    config = {
        "source": "s",
        "columns": [{"name": "a", "type": "long"}, {"name": "t", "type": "timestamptz"}],
        "partition": {"field": "t", "transform": "day"},
    }
    schema = schemas.declared_schema(config)
    assert schema.names == ["a", "t"] and schema.partition_field == "t"
    assert all(f.nullable for f in schema.columns.fields)
    bronze = schema.bronze()
    assert bronze.names == ["a", "t", "_ingestion_timestamp", "_source"]
    assert bronze.partition_field == "_ingestion_timestamp"


@pytest.mark.parametrize(
    "change",
    [
        {"columns": [{"name": "a", "type": "geometry"}]},
        {"partition": {"field": "a", "transform": "month"}},
        {"partition": {"field": "zz", "transform": "day"}},
    ],
)
def test_bad_declarations_are_errors(change):
    config = {"source": "s", "columns": [{"name": "a", "type": "date"}], **change}
    with pytest.raises(ValueError):
        schemas.declared_schema(config)


def test_unknown_source_is_an_error():
    with pytest.raises(KeyError):
        schemas.resolve_schema("nowhere", {})


@pytest.mark.parametrize(
    "name,expected",
    [("text", "string"), ("bigint", "long"), ("boolean", "boolean"), ("double", "double"), ("geography", "string")],
)
def test_source_types(name, expected):
    assert schemas.source_type(name) == expected


def test_json_inference(spark):
    bodies = ['{"id": 1, "name": "Alice", "score": 95.5, "active": true, "x": null}', '{"id": 2.5, "name": 7}', "[1]", "oops"]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = dict(rows(schemas.infer_json_columns(df, "body"), "column_name", "table_type"))
    assert got == {"id": "double", "name": "string", "score": "double", "active": "boolean", "x": "string"}


def test_dataset_ids():
    assert schemas.valid_dataset_id("fin.ecb_rates_silver")
    assert not schemas.valid_dataset_id("fin.ecb_rates")
    assert not schemas.valid_dataset_id("Fin.rates_gold")


def test_directory_scan_unions_formats_and_columns(spark, folder):
    pq.write_table(pa.table({"id": [1, 2], "a": ["x", "y"]}), f"{folder}/one.parquet")
    pq.write_table(pa.table({"id": [3], "b": [1.5]}), f"{folder}/two.parquet")
    with open(f"{folder}/three.csv", "w") as f:
        f.write("id,a\n4,z\n")
    with open(f"{folder}/notes.txt", "w") as f:
        f.write("skip me")
    everything = files.read_directory(spark, folder, "*")
    assert rows(everything, "id", "a", "b") == [(1, "x", None), (2, "y", None), (3, None, 1.5), (4, "z", None)]
    assert rows(files.read_directory(spark, folder, "t*"), "id") == [(3,), (4,)]
    paths = files.read_directory(spark, folder, "*.csv", with_path=True).select("_file").first()[0]
    assert paths.endswith("three.csv")


def test_nothing_to_read_gives_no_rows(spark, folder):
    for glob in ("*.parquet", "*.csv", "*"):
        assert files.read_directory(spark, f"{folder}/absent", glob).isEmpty()
        assert files.read_directory(spark, folder, glob).isEmpty()
    assert files.read_prefix(spark, folder, "absent").isEmpty()


def test_prefix_scan(spark, folder):
    pq.write_table(pa.table({"id": [1]}), f"{folder}/sales-1.parquet")
    pq.write_table(pa.table({"id": [2]}), f"{folder}/sales-2.parquet")
    pq.write_table(pa.table({"id": [3]}), f"{folder}/other.parquet")
    assert rows(files.read_prefix(spark, folder, "sales"), "id") == [(1,), (2,)]
    assert files.prefix_format("csv", "*") == "csv"
    assert files.prefix_format("bin", "*.csv") == "csv"
    assert files.prefix_format("bin", "*") == "parquet"


def test_nanoseconds_become_microseconds(spark, folder):
    stamps = pa.array([1_700_000_000_123_456_789, None, -1], pa.timestamp("ns", tz="UTC"))
    naive = pa.array([1_700_000_000_123_456_789, None, 0], pa.timestamp("ns"))
    pq.write_table(pa.table({"t": stamps, "n": naive}), f"{folder}/ns.parquet", version="2.6")
    schema = T.StructType([T.StructField("t", T.LongType()), T.StructField("n", T.LongType())])
    df = files.read_nanosecond_parquet(spark, folder, schema, {"t": "timestamptz", "n": "timestamp"})
    assert [f.dataType for f in df.schema] == [T.TimestampType(), T.TimestampNTZType()]
    assert rows(df.select(F.unix_micros("t"), F.col("n").cast("string"))) == sorted(
        [(1_700_000_000_123_456, "2023-11-14 22:13:20.123456"), (None, None), (-1, "1970-01-01 00:00:00")], key=repr
    )


def test_database_options():
    config = {"host": "h", "database": "d", "user": "u", "password": "p", "table": "t"}
    options = database.table_options(config)
    assert options["url"] == "jdbc:postgresql://h:5432/d" and options["dbtable"] == '"public"."t"'
    assert "information_schema.tables" in database.table_options({**config, "table": None})["dbtable"]
    split = database.table_options({**config, "column": "id", "lower": 0, "upper": 9, "partitions": 3})
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "3"


def test_envelopes(spark):
    bodies = [
        '[{"a": 1}, {"a": 2}]', '{"results": [{"a": 3}], "data": 5}', "[]", '{"z": 1}', "7", "not json",
        '{"records": [], "x": 1}', '{"items": [{"a": 4}], "results": [{"a": 5}]}',
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    records = envelopes.unwrap_responses(df, "body")
    got = envelopes.record_fields(records, T.StructType([T.StructField("a", T.LongType())]))
    assert rows(got, "i", "a") == sorted([(0, 1), (0, 2), (1, 3), (3, None), (7, 5)], key=repr)
    assert fixed_values.ENVELOPE_KEYS[0] == "data"


DOCUMENT = """<?xml version="1.0"?><GL_MarketDocument xmlns="urn:x"><TimeSeries>
<MktPSRType><psrType>B16</psrType></MktPSRType>
<{side}BiddingZone_Domain.mRID>10YES-REE------0</{side}BiddingZone_Domain.mRID>
<Period><timeInterval><start>2023-08-15T22:00Z</start></timeInterval><resolution>{step}</resolution>
<Point><position>1</position><quantity>4217</quantity></Point><Point><position>2</position><quantity>4.5</quantity></Point>
</Period></TimeSeries></GL_MarketDocument>"""


def test_market_documents(spark, folder):
    for i, (side, step) in enumerate([("in", "PT60M"), ("out", "PT15M")]):
        with open(f"{folder}/{i}.xml", "w") as f:
            f.write(DOCUMENT.format(side=side, step=step))
    with open(f"{folder}/error.xml", "w") as f:
        f.write("<html>busy</html>")
    landed = envelopes.read_documents(spark, folder)
    points = envelopes.document_points(landed, "body")
    at = lambda h, m: dt.datetime(2023, 8, 15, h, m)
    zone = "10YES-REE------0"
    assert rows(points.select(F.col("timestamp_utc").cast("timestamp_ntz"), "in_zone", "out_zone", "quantity_mw")) == sorted(
        [(at(22, 0), zone, None, 4217.0), (at(23, 0), zone, None, 4.5), (at(22, 0), None, zone, 4217.0), (at(22, 15), None, zone, 4.5)],
        key=repr,
    )
    assert envelopes.unreadable_documents(landed, "body").count() == 1


def test_sql_errors_and_timeouts(spark):
    with pytest.raises(ValueError):
        tables.run_sql(spark, "SELECT nothing FROM nowhere")
    with pytest.raises(TimeoutError):
        tables.run_sql(spark, "SELECT max(xxhash64(id)) AS s FROM range(60000000000)", timeout_s=1)
    assert tables.run_sql(spark, "SELECT :x + 1 AS y", args={"x": 1}).first()["y"] == 2


def test_staging_view_needs_its_table(spark):
    with pytest.raises(ValueError):
        tables.staging_view(spark, "default.absent", "stg_absent")


def test_staging_view_shows_the_table(spark):
    db = scratch_database(spark, "raw")
    spark.createDataFrame([(1, "alice"), (2, "bob")], "id int, name string").write.saveAsTable(f"{db}.people")
    assert rows(tables.staging_view(spark, f"{db}.people", "stg_people")) == [(1, "alice"), (2, "bob")]


def test_source_dispatch(spark, folder):
    pq.write_table(pa.table({"id": [1]}), f"{folder}/a.parquet")
    assert rows(connect.read_source(spark, "filesystem", {"path": folder}), "id") == [(1,)]
    assert rows(connect.read_source(spark, "s3", {"root": folder, "prefix": "a"}), "id") == [(1,)]
    with pytest.raises(ValueError):
        connect.read_source(spark, "kafka", {})
    found = connect.discover(spark, "filesystem", {"path": folder})
    assert found == [{"name": "id", "type": "long", "nullable": True}]
    with open(f"{folder}/notes.txt", "w") as f:
        f.write("one\ntwo\n")
    assert connect.discover(spark, "filesystem", {"path": f"{folder}/absent"}) == [
        {"name": "_raw", "type": "string", "nullable": True}
    ]


def test_registered_readers(spark):
    connect.register_reader("numbers", lambda s, o: s.range(o["n"]))
    assert connect.read_source(spark, "numbers", {"n": 3}).count() == 3
