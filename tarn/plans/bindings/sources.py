"""Scans, sources and schemas."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.operators.validate import ingest
from tarn.plans.bindings.registry import TABLES, events, ntz, query, rounded, table
from tarn.session import scratch_database, scratch_path
from tarn.sources import connect, envelopes, files, landed, schemas
from tarn.sources import tables as catalog
from tarn.streaming.ingest import run_to_files


@query(
    "src1_directory_scan",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders",
)
def directory_scan(spark, sf_dir):
    df = files.read_directory(spark, sf_dir, "orders*.parquet")
    return df.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@query(
    "src1_mixed_formats",
    """SELECT n_nationkey AS key, n_name AS name, 'nation' AS kind FROM nation
    UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier""",
)
def mixed_formats(spark, sf_dir):
    """A folder holding CSV and Parquet files, and one with a suffix to skip."""
    folder = scratch_path(spark, "mixed")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    nation.withColumn("kind", F.lit("nation")).write.csv(f"{folder}/a", header=True)
    supplier.withColumn("kind", F.lit("supplier")).write.parquet(f"{folder}/b")
    nation.select("name").write.text(f"{folder}/c")
    df = files.read_directory(spark, folder, "part-*")
    return df.select(F.col("key").cast("long").alias("key"), "name", "kind")


@query(
    "src2_prefix_scan",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity
    FROM lineitem GROUP BY ALL""",
)
def prefix_scan(spark, sf_dir):
    df = files.read_prefix(spark, sf_dir, "lineitem")
    return df.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum("l_quantity"), 2).alias("quantity")
    )


@query(
    "src1_csv_columns_by_name",
    """SELECT n_nationkey AS key, n_name AS name FROM nation
    UNION ALL SELECT s_suppkey, s_name FROM supplier""",
)
def csv_columns_by_name(spark, sf_dir):
    """CSV files of one folder whose headers name the same columns in another order."""
    folder = scratch_path(spark, "headers")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"))
    nation.write.csv(f"{folder}/a", header=True)
    supplier.write.csv(f"{folder}/b", header=True)
    df = files.read_directory(spark, folder, "*.csv")
    return df.select(F.col("key").cast("long").alias("key"), "name")


@query(
    "src2_mixed_suffixes",
    """SELECT n_nationkey AS key, n_name AS name FROM nation
    UNION ALL SELECT s_suppkey, s_name FROM supplier""",
)
def mixed_suffixes(spark, sf_dir):
    """Objects of one prefix, in CSV and in Parquet, under the default glob; another prefix is not read."""
    folder = scratch_path(spark, "objects")
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    nation.write.csv(f"{folder}/names-nation", header=True)
    supplier.write.parquet(f"{folder}/names-supplier")
    nation.write.parquet(f"{folder}/other")
    return files.read_prefix(spark, folder, "names").select(F.col("key").cast("long").alias("key"), "name")


PAGE = 50


@query(
    "src4_response_unwrap",
    f"""SELECT event_id, event_type, value FROM events
    WHERE (event_id // {PAGE}) % 8 NOT IN (6, 7)
    UNION ALL
    SELECT CAST(event_id // {PAGE} AS BIGINT), 'single', CAST(NULL AS DOUBLE) FROM events
    WHERE (event_id // {PAGE}) % 8 = 6 GROUP BY event_id // {PAGE}""",
)
def response_unwrap(spark, sf_dir):
    """Events served in pages, each in one of the shapes a response can have."""
    record = F.struct("event_id", "event_type", "value")
    pages = (
        table(spark, sf_dir, "events")
        .groupBy(F.floor(F.col("event_id") / PAGE).cast("long").alias("page"))
        .agg(F.collect_list(record).alias("rows"))
    )
    shape = F.col("page") % 8
    body = F.when(shape == 0, F.to_json("rows"))
    for i, key in enumerate(("data", "results", "items", "records"), 1):
        body = body.when(shape == i, F.to_json(F.struct(F.col("rows").alias(key))))
    two_keys = F.struct(F.lit(1).alias("data"), F.col("rows").alias("items"))
    single = F.struct(F.col("page").alias("event_id"), F.lit("single").alias("event_type"))
    body = (
        body.when(shape == 5, F.to_json(two_keys))
        .when(shape == 6, F.to_json(single))
        .otherwise(F.lit('"not a record"'))
    )
    schema = schemas.columns(event_id="long", event_type="string", value="double")
    records = envelopes.unwrap_responses(pages.select(body.alias("body")), "body")
    return envelopes.record_fields(records, schema)


@query(
    "src5_table_scan",
    "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer",
)
def table_scan(spark, sf_dir):
    db = _registered(spark, sf_dir, "customer")
    return catalog.scan_table(spark, db, "customer", ["c_custkey", "c_mktsegment", "c_acctbal"])


@query(
    "src6_adhoc_sql",
    """SELECT c_mktsegment, count(*) AS n, round(avg(round(c_acctbal * 100)), 6) AS avg_cents
    FROM customer WHERE c_acctbal > 1000 GROUP BY c_mktsegment""",
)
def adhoc_sql(spark, sf_dir):
    statement = """SELECT c_mktsegment, count(*) AS n, round(avg(round(c_acctbal * 100)), 6) AS avg_cents
        FROM customer WHERE c_acctbal > :least GROUP BY c_mktsegment"""
    db = _registered(spark, sf_dir, "customer")
    return catalog.run_sql(spark, statement, schema=db, args={"least": 1000}, timeout_s=180)


@query(
    "src7_staging_view",
    "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
)
def staging_view(spark, sf_dir):
    db = _registered(spark, sf_dir, "supplier")
    return catalog.staging_view(spark, f"{db}.supplier", f"stg_{db}")


def _registered(spark, sf_dir, name):
    db = scratch_database(spark, "staging")
    spark.sql(f"CREATE TABLE {db}.{name} USING parquet OPTIONS (path '{sf_dir}/{name}.parquet')")
    return db


POINTS = 24


@query(
    "src8_market_documents",
    f"""SELECT CASE WHEN event_id // {POINTS} % 2 = 0
            THEN TIMESTAMP '2024-01-01' + to_days(CAST(event_id // {POINTS} AS INTEGER))
                 + to_hours(CAST(event_id % {POINTS} AS INTEGER))
            ELSE TIMESTAMP '2024-01-01' + to_days(CAST(event_id // {POINTS} AS INTEGER))
                 + to_minutes(CAST(15 * (event_id % {POINTS}) AS INTEGER)) END AS timestamp_utc,
        CAST(event_id // {POINTS} AS VARCHAR) AS in_zone, 'B16' AS psr_type, value AS quantity_mw,
        CASE WHEN event_id // {POINTS} % 2 = 0 THEN 'PT60M' ELSE 'PT15M' END AS resolution
    FROM events""",
)
def market_documents(spark, sf_dir):
    """Event values served as XML time series of 24 points, hourly and quarter-hourly."""
    series = F.floor(F.col("event_id") / POINTS).cast("int")
    point = F.struct(
        (F.col("event_id") % POINTS + 1).alias("position"),
        F.col("value").cast("string").alias("quantity"),
    )
    docs = (
        table(spark, sf_dir, "events")
        .groupBy(series.alias("series"))
        .agg(F.sort_array(F.collect_list(point)).alias("points"))
    )
    points = F.array_join(
        F.transform(
            "points",
            lambda p: F.concat(
                F.lit("<Point><position>"), p["position"], F.lit("</position><quantity>"),
                p["quantity"], F.lit("</quantity></Point>"),
            ),
        ),
        "",
    )
    start = F.date_format(F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("series")), "yyyy-MM-dd'T'00:00'Z'")
    resolution = F.when(F.col("series") % 2 == 0, "PT60M").otherwise("PT15M")
    xml = F.concat(
        F.lit("<GL_MarketDocument><TimeSeries><MktPSRType><psrType>B16</psrType></MktPSRType><inBiddingZone_Domain.mRID>"),
        F.col("series").cast("string"),
        F.lit("</inBiddingZone_Domain.mRID><Period><timeInterval><start>"), start,
        F.lit("</start></timeInterval><resolution>"), resolution, F.lit("</resolution>"), points,
        F.lit("</Period></TimeSeries></GL_MarketDocument>"),
    )
    rows = envelopes.document_points(docs.select(xml.alias("body")), "body")
    return rows.select(ntz("timestamp_utc").alias("timestamp_utc"), "in_zone", "psr_type", "quantity_mw", "resolution")


@query(
    "src9_missing_days",
    """WITH loaded AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
    users AS (SELECT DISTINCT user_id FROM loaded),
    days AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS day)
    SELECT u.user_id, d.day FROM users u, days d
    WHERE NOT EXISTS (SELECT 1 FROM loaded l WHERE l.user_id = u.user_id AND l.day = d.day)""",
)
def missing_days(spark, sf_dir):
    return catalog.missing_days(
        events(spark, sf_dir), ["user_id"], "ts", dt.date(2024, 1, 1), dt.date(2024, 1, 30)
    )


ORDER_CONFIG = {
    "source": "orders",
    "columns": [
        {"name": "o_orderkey", "type": "long"},
        {"name": "o_totalprice", "type": "double"},
        {"name": "o_orderdate", "type": "date"},
        {"name": "o_comment", "type": "string"},
    ],
}


@query(
    "sch1_apply_schema",
    """SELECT o_orderkey,
        CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice,
        CAST(o_orderdate AS DATE) AS o_orderdate, CAST(NULL AS VARCHAR) AS o_comment,
        CASE WHEN o_orderstatus = 'P' THEN 'o_totalprice' ELSE '' END AS failed
    FROM orders""",
)
def apply_schema(spark, sf_dir):
    """Orders as text, with prices of pending orders that are no numbers."""
    text = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("EUR "), F.col("o_totalprice")))
        .otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.to_date("o_orderdate").cast("string").alias("o_orderdate"),
    )
    out = schemas.apply_schema(text, schemas.declared_schema(ORDER_CONFIG), failures="failed")
    return out.withColumn("failed", F.array_join("failed", ","))


@query(
    "sch2_discover",
    """SELECT table_name, column_name, CASE
        WHEN data_type = 'BIGINT' THEN 'long' WHEN data_type = 'INTEGER' THEN 'int'
        WHEN data_type = 'DOUBLE' THEN 'double' WHEN data_type LIKE 'TIMESTAMP%' THEN 'timestamp'
        ELSE 'string' END AS table_type
    FROM information_schema.columns
    WHERE table_name IN (""" + ", ".join(f"'{t}'" for t in TABLES) + ")",
)
def discover(spark, sf_dir):
    found = schemas.discovered_rows(spark, {t: table(spark, sf_dir, t) for t in TABLES})
    return found.select("table_name", "column_name", "table_type")


@query(
    "sch2_discover_and_ingest",
    """SELECT o_orderstatus AS status, count(*) AS n, count(o_orderkey) AS keys, round(sum(o_totalprice), 2) AS total,
        count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY ALL""",
)
def discover_and_ingest(spark, sf_dir):
    """A reader registered for landed JSON lines; its columns are discovered from every row, then ingested."""
    folder, db = scratch_path(spark, "lines"), scratch_database(spark, "bronze")
    order = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"), (F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
    )
    order.write.json(folder)
    connect.register_reader("json_lines", lambda s, o: s.read.json(o["path"]))
    found = {c["name"]: c["type"] for c in connect.discover(spark, "json_lines", {"path": folder})}
    schema = schemas.TableSchema("orders", schemas.columns(**found))
    raw = connect.read_source(spark, "json_lines", {"path": folder})
    ingest(raw, "orders", schema, dt.datetime(2024, 2, 1, tzinfo=dt.UTC), namespace=db, read_once=False)
    # sums and conditions that only typed columns allow
    return spark.table(f"{db}.orders").groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.col("key")).alias("keys"),
        rounded(F.sum("total"), 2).alias("total"), F.count_if("urgent").alias("urgent"),
    )


@query(
    "sch3_json_inference",
    """WITH bodies AS (
        SELECT json_object('key', o_orderkey, 'price', o_totalprice, 'status', o_orderstatus,
            'urgent', o_orderpriority = '1-URGENT', 'tags', [o_orderstatus]) AS b FROM orders
        UNION ALL SELECT props FROM events),
    fields AS (SELECT unnest(json_keys(b)) AS column_name, b FROM bodies)
    SELECT column_name, CASE
        WHEN max(kind) = 'BIGINT' OR max(kind) = 'UBIGINT' THEN 'long' WHEN max(kind) = 'DOUBLE' THEN 'double'
        WHEN max(kind) = 'BOOLEAN' THEN 'boolean' ELSE 'string' END AS table_type
    FROM (SELECT column_name, json_type(b, '$.' || column_name) AS kind FROM fields) GROUP BY column_name""",
)
def json_inference(spark, sf_dir):
    order = F.struct(
        F.col("o_orderkey").alias("key"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("status"),
        (F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
        F.array("o_orderstatus").alias("tags"),
    )
    bodies = table(spark, sf_dir, "orders").select(F.to_json(order).alias("body"))
    bodies = bodies.unionByName(table(spark, sf_dir, "events").select(F.col("props").alias("body")))
    return schemas.infer_json_columns(bodies, "body")


@query(
    "sch4_raw_lines",
    "SELECT c_custkey || ';' || c_mktsegment AS _raw FROM customer",
)
def raw_lines(spark, sf_dir):
    folder = scratch_path(spark, "raw")
    line = F.concat_ws(";", F.col("c_custkey").cast("string"), "c_mktsegment")
    table(spark, sf_dir, "customer").select(line.alias("value")).write.text(folder)
    return files.read_raw_lines(spark, folder)


@query(
    "sch5_schema_check",
    """WITH actual AS (SELECT column_name, CASE
            WHEN data_type = 'BIGINT' THEN 'long' WHEN data_type = 'DOUBLE' THEN 'double'
            WHEN data_type LIKE 'TIMESTAMP%' THEN 'timestamp' ELSE 'string' END AS actual
        FROM information_schema.columns WHERE table_name = 'orders'),
    declared(column_name, declared) AS (VALUES ('o_orderkey', 'long'), ('o_custkey', 'string'),
        ('o_orderstatus', 'string'), ('o_totalprice', 'double'), ('o_orderdate', 'date'), ('o_clerk', 'string'))
    SELECT 'fin.orders_silver' AS dataset_id, column_name, declared, actual,
        CASE WHEN actual IS NULL THEN 'missing' WHEN declared IS NULL THEN 'unexpected' ELSE 'type' END AS violation
    FROM actual FULL JOIN declared USING (column_name) WHERE actual IS DISTINCT FROM declared""",
)
def schema_check(spark, sf_dir):
    contract = schemas.Contract(
        "fin.orders_silver",
        [
            ("o_orderkey", "long"),
            ("o_custkey", "string"),
            ("o_orderstatus", "string"),
            ("o_totalprice", "double"),
            ("o_orderdate", "date"),
            ("o_clerk", "string"),
        ],
    )
    return schemas.schema_violations(spark, table(spark, sf_dir, "orders"), contract)


@query(
    "sch5_contract_records",
    """WITH r AS (SELECT CASE WHEN c_acctbal < 0 THEN 'FIN.' || c_name ELSE 'fin.customer_' || c_custkey || '_gold' END AS dataset_id,
        nullif(c_mktsegment, 'BUILDING') AS owner FROM customer)
    SELECT dataset_id, 'blank:owner' AS violation FROM r WHERE owner IS NULL
    UNION ALL SELECT dataset_id, 'malformed:dataset_id' FROM r
    WHERE NOT regexp_matches(dataset_id, '^[a-z][a-z0-9]*\\.[a-z][a-z0-9]*(_[a-z0-9]+)*_(bronze|silver|gold|iceberg)$')""",
)
def contract_records(spark, sf_dir):
    """One contract per customer, some without an owner or with a bad id."""
    good = F.concat(F.lit("fin.customer_"), F.col("c_custkey").cast("string"), F.lit("_gold"))
    records = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("FIN."), F.col("c_name"))).otherwise(good).alias("dataset_id"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("owner"),
        *[F.lit("x").alias(c) for c in ("product_id", "dataset_namespace", "domain", "layer", "physical_locations")],
    )
    return schemas.contract_violations(records)


LANDED_SQL = "SELECT page_id, md5(url) AS url, md5(html) AS html, length(html) AS n FROM pages"
PAGE_RECORD = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())]
)


def _land_pages(pages, folder: str) -> None:
    """Pages as response bodies of some records each, a body per line."""
    record = F.struct("page_id", "url", "html")
    bodies = pages.groupBy(F.floor(F.col("page_id") / 25).alias("body")).agg(F.collect_list(record).alias("data"))
    bodies.select(F.to_json(F.struct("data"), {"ignoreNullFields": "false"})).write.mode("append").text(folder)


def _of_pages(records):
    found = envelopes.record_fields(records, PAGE_RECORD)
    digest = lambda c: F.md5(F.col(c).cast("binary")).alias(c)
    return found.select("page_id", digest("url"), digest("html"), F.length("html").cast("long").alias("n"))


@query("ext1_landed_bodies", LANDED_SQL)
def landed_bodies(spark, sf_dir):
    """All pages, landed as many response bodies, through the source that plans its own partitions."""
    folder = scratch_path(spark, "landed")
    _land_pages(table(spark, sf_dir, "pages").repartition(4), folder)
    return _of_pages(connect.read_source(spark, "landed", {"path": folder, "partitionBytes": 256 << 10}))


@query("ext2_landed_stream", LANDED_SQL)
def landed_stream(spark, sf_dir):
    """Pages that land in two drops; each run of the stream takes what landed since the last one."""
    base, pages = scratch_path(spark, "landing"), table(spark, sf_dir, "pages")
    for drop in (0, 1):
        _land_pages(pages.filter(F.pmod("page_id", F.lit(50)) >= 25 if drop else F.pmod("page_id", F.lit(50)) < 25), f"{base}/in")
        stream = landed.stream_landed(spark, f"{base}/in", ["path", "body"], partitionBytes=256 << 10)
        run_to_files(stream, f"{base}/out", f"{base}/checkpoint")
    bodies = spark.read.schema("path string, body string").parquet(f"{base}/out")
    return _of_pages(envelopes.unwrap_responses(bodies.select("body"), "body"))
