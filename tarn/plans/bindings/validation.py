"""Projection, rules, de-duplication and filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tarn.functions import formulas
from tarn.operators import validate
from tarn.plans.bindings.registry import events, lineitem, orders, query, rounded, table
from tarn.session import scratch_database
from tarn.sources.schemas import TableSchema, columns
from tarn.sources.sinks import append_table, with_lineage

DECLARED = columns(event_id="long", user_id="long", channel="string", _source="string")


@query("val1_project", "SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS channel FROM events")
def project(spark, sf_dir):
    incoming = table(spark, sf_dir, "events").withColumn("_source", F.lit("elsewhere"))
    return validate.project(incoming, DECLARED)


def event_rules():
    return [
        validate.required("user_id"),
        validate.one_of("event_type", ["view", "signup", "purchase", "click"]),
        validate.at_most("value", 50),
    ]


@query(
    "val2_valid_rows",
    "SELECT event_id, event_type, value FROM events WHERE event_type <> 'error' AND value <= 50",
)
def valid_rows(spark, sf_dir):
    return validate.split(events(spark, sf_dir), event_rules())[0].select("event_id", "event_type", "value")


@query(
    "val2_rejected_rows",
    """SELECT CASE WHEN event_type = 'error' THEN 'value:event_type' ELSE 'above:value' END AS rejection_reason,
        event_id, (40 + length(CAST(event_id AS VARCHAR)) + length(event_type)
            + length(CAST(user_id AS VARCHAR))) AS payload_chars
    FROM events WHERE event_type = 'error' OR value > 50""",
)
def rejected_rows(spark, sf_dir):
    columns = events(spark, sf_dir).select("event_id", "event_type", "user_id", "value")
    _, bad = validate.split(columns, event_rules())
    clipped = validate.rejected_payload(bad.drop("value"))
    return clipped.select(
        "rejection_reason",
        F.get_json_object("payload", "$.event_id").cast("long").alias("event_id"),
        F.length("payload").cast("long").alias("payload_chars"),
    )


@query(
    "val3_typed_rules",
    """WITH t AS (SELECT CASE
        WHEN l_returnflag = 'R' THEN 'type:quantity'
        WHEN 1000 * l_quantity - l_extendedprice > 0 THEN 'negative:margin'
        WHEN l_discount > 0.08 THEN 'above:l_discount' END AS reason FROM lineitem)
    SELECT reason, count(*) AS n FROM t GROUP BY reason""",
)
def typed_rules(spark, sf_dir):
    quantity = F.col("l_quantity").cast("int").cast("string")
    df = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", F.concat(quantity, F.lit(" pcs"))).otherwise(quantity).alias("quantity"),
        (F.col("l_extendedprice") - F.lit(1000) * F.col("l_quantity")).cast("string").alias("margin"),
        "l_discount",
    )
    rules = [
        validate.castable("quantity", "int"),
        validate.non_negative("margin"),
        validate.at_most("l_discount", 0.08),
    ]
    return validate.tag(df, rules, "reason").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "val4_ingest_summary",
    """SELECT count(*) FILTER (event_type <> 'error' AND value <= 50) AS valid,
        count(*) FILTER (event_type = 'error' OR value > 50) AS rejected,
        count(*) FILTER (event_type <> 'error' AND value <= 50) AS stored,
        count(*) FILTER (event_type = 'error' OR value > 50) AS quarantined FROM events""",
)
def ingest_summary(spark, sf_dir):
    """Counts returned by an ingest, next to what the two tables hold."""
    db = scratch_database(spark, "bronze")
    schema = TableSchema("events", columns(event_id="long", ts="timestamptz", user_id="long", event_type="string", value="double"))
    stamp = dt.datetime(2024, 2, 1, tzinfo=dt.UTC)
    counts = validate.ingest(events(spark, sf_dir), "events", schema, stamp, event_rules(), db)
    stored = spark.table(f"{db}.events").agg(F.count(F.lit(1)).alias("stored"))
    held = spark.table(f"{db}.rejected_records").agg(F.count(F.lit(1)).alias("quarantined"))
    both = stored.unionByName(held, allowMissingColumns=True)
    return both.agg(F.max("stored").alias("stored"), F.max("quarantined").alias("quarantined")).select(
        F.lit(counts["valid"]).cast("long").alias("valid"),
        F.lit(counts["rejected"]).cast("long").alias("rejected"),
        "stored",
        "quarantined",
    )


@query(
    "val4_ingest_repeated",
    """SELECT event_type <> 'error' AND value <= 50 AS stored, count(*) AS n, count(DISTINCT event_id) AS ids FROM events GROUP BY ALL""",
)
def ingest_repeated(spark, sf_dir):
    """A batch that failed between its two writes and was run twice more is stored once."""
    db = scratch_database(spark, "bronze")
    schema = TableSchema("events", columns(event_id="long", ts="timestamptz", user_id="long", event_type="string", value="double"))
    stamp = dt.datetime(2024, 2, 1, tzinfo=dt.UTC)
    good, _ = validate.split(events(spark, sf_dir), event_rules())
    half = with_lineage(good.select(*schema.names), "events", stamp)
    append_table(half, db, "events", schema.bronze())
    for _ in range(2):
        validate.ingest(events(spark, sf_dir), "events", schema, stamp, event_rules(), db)
    held = spark.table(f"{db}.rejected_records").select(F.get_json_object("payload", "$.event_id").cast("long").alias("event_id"))
    rows = spark.table(f"{db}.events").select("event_id", F.lit(True).alias("stored")).unionByName(held.withColumn("stored", F.lit(False)))
    return rows.groupBy("stored").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"))


@query(
    "val4_ingest_undeclared",
    """SELECT p_brand, count(*) AS n, count(*) FILTER (p_size > 25) AS sized, round(sum(p_retailprice), 2) AS price FROM part GROUP BY p_brand""",
)
def ingest_undeclared(spark, sf_dir):
    """No schema is declared; the second delivery brings a column the table did not have."""
    db, part = scratch_database(spark, "bronze"), table(spark, sf_dir, "part")
    first = part.filter("p_size <= 25").select("p_partkey", "p_brand", "p_retailprice")
    second = part.filter("p_size > 25").select("p_brand", "p_size", "p_retailprice", F.array("p_partkey").alias("keys"))
    for day, rows in ((1, first), (2, second)):
        validate.ingest(rows, "part", None, dt.datetime(2024, 2, day, tzinfo=dt.UTC), namespace=db)
    return spark.table(f"{db}.part").groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("p_size").isNotNull() & F.col("keys").startswith("[")).alias("sized"),
        rounded(F.sum("p_retailprice"), 2).alias("price"),
    )


@query(
    "val5_skip_ingested",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= DATE '1998-01-01'",
)
def skip_ingested(spark, sf_dir):
    """Everything is delivered again; releases before 1998 are in the table."""
    raw = orders(spark, sf_dir)
    held = raw.filter("o_orderdate < '1998-01-01'").select("o_orderkey")
    return validate.skip_ingested(raw, held, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query(
    "val6_content_fingerprint",
    """SELECT count(DISTINCT text) AS documents, CAST(sum(length(text)) AS BIGINT) AS chars
    FROM (SELECT DISTINCT text FROM documents WHERE text NOT IN (SELECT text FROM documents WHERE lang = 'en'))""",
)
def content_fingerprint(spark, sf_dir):
    """English documents are in the table; of all documents only new texts remain, once each."""
    raw = table(spark, sf_dir, "documents")
    fresh = validate.skip_redelivered(raw, raw.filter("lang = 'en'"), ["text"])
    return fresh.agg(
        F.count_distinct("content_sha256").alias("documents"), F.sum(F.length("text")).alias("chars")
    )


@query(
    "val7_deduplicate",
    """SELECT o_custkey, o_orderstatus, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) = 1""",
)
def deduplicate(spark, sf_dir):
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    best = validate.deduplicate(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus"], order)
    return best.select("o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice")


@query(
    "val8_business_days",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders WHERE isodow(o_orderdate) <= 5",
)
def business_days(spark, sf_dir):
    return validate.business_days(orders(spark, sf_dir), "o_orderdate").select("o_orderkey", "o_orderdate")


@query(
    "val9_series_filter",
    """SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate, max(o_totalprice) AS highest FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY ALL""",
)
def series_filter(spark, sf_dir):
    chosen = validate.only_series(orders(spark, sf_dir), "o_orderpriority", ["1-URGENT", "2-HIGH"])
    return chosen.groupBy("o_orderpriority", "o_orderdate").agg(F.max("o_totalprice").alias("highest"))


@query(
    "val10_on_demand",
    """SELECT l_shipdate::DATE AS l_shipdate, count(*) AS n FROM lineitem
    WHERE l_linestatus = 'O' AND l_returnflag = 'A' GROUP BY ALL""",
)
def on_demand(spark, sf_dir):
    kept = validate.on_demand(
        lineitem(spark, sf_dir), "O", "A", scenario_column="l_returnflag", term_column="l_linestatus"
    )
    return kept.groupBy("l_shipdate").agg(F.count(F.lit(1)).alias("n"))


@query(
    "math1_unit_formulas",
    """SELECT p_partkey,
        round(p_retailprice / nullif(p_size, 0) / 3600 * 1e6, 6) AS wh_per_million_tokens,
        CAST(p_size * 3600 AS DOUBLE) AS tokens_per_hour,
        round(p_retailprice / 1.1 / (p_size * 3600) * 1e6, 6) AS eur_per_million_tokens,
        round(42.0::DOUBLE * (p_retailprice / nullif(p_size, 0) / 3600 * 1e6) / 1000, 6) AS gco2_per_million_tokens,
        round(p_retailprice / 1.1, 6) AS price_eur_per_hour
    FROM part""",
)
def unit_formulas(spark, sf_dir):
    df = table(spark, sf_dir, "part").withColumn("speed", F.col("p_size").cast("double"))
    wh = formulas.wh_per_million_tokens("p_retailprice", "speed")
    eur = formulas.price_eur_per_hour("p_retailprice", F.lit(1.1))
    hourly = formulas.tokens_per_hour("speed")
    return df.select(
        "p_partkey",
        rounded(wh).alias("wh_per_million_tokens"),
        hourly.alias("tokens_per_hour"),
        rounded(formulas.eur_per_million_tokens(eur, hourly)).alias("eur_per_million_tokens"),
        rounded(formulas.gco2_per_million_tokens(F.lit(42.0), wh)).alias("gco2_per_million_tokens"),
        rounded(eur).alias("price_eur_per_hour"),
    )
