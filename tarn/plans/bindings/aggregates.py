"""Group aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarn.operators import aggregates as agg
from tarn.plans.bindings.registry import TABLES, events, lineitem, ntz, orders, query, rounded, table


@query(
    "agg1_best_per_group",
    """SELECT l_suppkey, l_returnflag, max(l_quantity - 10) AS tokens_per_sec FROM lineitem
    WHERE l_quantity - 10 >= 0 GROUP BY ALL""",
)
def best_per_group(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").withColumn("tokens_per_sec", F.col("l_quantity") - 10)
    return agg.best_per_group(df, ["l_suppkey", "l_returnflag"], "tokens_per_sec")


@query(
    "agg2_latest_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def latest_per_key(spark, sf_dir):
    latest = agg.latest_per_key(orders(spark, sf_dir), ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return latest.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")


@query(
    "agg3_weighted_mean",
    """SELECT l_returnflag, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
        round(sum(l_quantity * nullif(l_discount, 0.05)) / nullif(sum(CASE WHEN l_discount <> 0.05 THEN l_quantity END), 0), 6) AS intensity
    FROM lineitem GROUP BY ALL""",
)
def weighted_mean(spark, sf_dir):
    df = lineitem(spark, sf_dir).withColumn("factor", F.nullif(F.col("l_discount"), F.lit(0.05)))
    month = F.trunc("l_shipdate", "month").alias("month")
    out = agg.weighted_mean(df, ["l_returnflag", month], "l_quantity", "factor", "intensity")
    return out.withColumn("intensity", rounded("intensity"))


@query(
    "agg4_mix_json",
    "SELECT CAST(ts AS DATE) AS day, event_type, round(sum(value), 2) AS mw FROM events GROUP BY ALL",
)
def mix_json(spark, sf_dir):
    df = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    mixes = agg.mix_json(df, ["day"], "event_type", "value", "generation_mix_json")
    parsed = F.from_json("generation_mix_json", "map<string,double>")
    return mixes.select("day", F.explode(parsed).alias("event_type", "mw")).withColumn("mw", rounded("mw", 2))


@query(
    "agg5_country_comparison",
    """SELECT n_name, round(avg(round(c_acctbal * 100)), 6) AS avg_cents, min(round(c_acctbal * 100)) AS min_cents,
        max(round(c_acctbal * 100)) AS max_cents, count(*) AS n
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def country_comparison(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    df = table(spark, sf_dir, "customer").join(nations, "c_nationkey")
    df = df.withColumn("cents", F.round(F.col("c_acctbal") * 100))
    return agg.compare_groups(df, ["n_name"], ["cents"]).withColumn("avg_cents", rounded("avg_cents"))


@query(
    "agg6_metric",
    """SELECT event_type, date_trunc('day', ts) AS ts_day, round(avg(round(value * 100)), 6) AS mean_value,
        round(sum(value), 2) AS total, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY ALL""",
)
def metric(spark, sf_dir):
    measures = {
        "mean_value": ("average", "round(value * 100)"),
        "total": ("sum", "value"),
        "n": ("count", "event_id"),
        "users": ("count_distinct", "user_id"),
    }
    out = agg.metric(events(spark, sf_dir), measures, ["event_type"], "ts", "day")
    return out.withColumns(
        {"ts_day": ntz("ts_day"), "mean_value": rounded("mean_value"), "total": rounded("total", 2)}
    )


@query(
    "agg6_metric_cube",
    """SELECT o_orderstatus, o_orderpriority, round(sum(o_totalprice), 2) AS revenue, count(o_orderkey) AS n,
        CAST(grouping_id(o_orderstatus, o_orderpriority) AS INTEGER) AS grouping_id
    FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""",
)
def metric_cube(spark, sf_dir):
    measures = {"revenue": ("sum", "o_totalprice"), "n": ("count", "o_orderkey")}
    out = agg.metric(table(spark, sf_dir, "orders"), measures, ["o_orderstatus", "o_orderpriority"], totals="cube")
    return out.withColumn("revenue", rounded("revenue", 2))


ORDER_MODEL = agg.SemanticModel(
    entity="o_custkey || '|' || cast(o_orderdate AS string) || '|' || o_orderpriority",
    time="o_orderdate",
    dimensions=("o_orderstatus", "o_orderpriority"),
    measures={
        "avg_price": ("average", "round(o_totalprice * 100)"),
        "order_count": ("count", "o_orderkey"),
    },
    metrics={"mean_order_cents": "avg_price", "orders": "order_count"},
)


@query(
    "agg6_semantic_model",
    """SELECT o_orderpriority, date_trunc('quarter', o_orderdate) AS o_orderdate_quarter,
        round(avg(round(o_totalprice * 100)), 6) AS mean_order_cents, count(o_orderkey) AS orders FROM orders GROUP BY ALL""",
)
def semantic_model(spark, sf_dir):
    out = ORDER_MODEL.query(orders(spark, sf_dir), ["mean_order_cents", "orders"], ["o_orderpriority"], "quarter")
    return out.withColumns(
        {"o_orderdate_quarter": ntz("o_orderdate_quarter"), "mean_order_cents": rounded("mean_order_cents")}
    )


@query(
    "agg6_entity_grain",
    """SELECT o_custkey || '|' || strftime(o_orderdate, '%Y-%m-%d') || '|' || o_orderpriority AS entity, count(*) AS n
    FROM orders GROUP BY ALL HAVING count(*) > 1""",
)
def entity_grain(spark, sf_dir):
    """Customers with several orders of one priority on a day."""
    return ORDER_MODEL.repeated_entities(orders(spark, sf_dir))


@query(
    "agg7_row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) > 0 AS passed FROM {t}" for t in TABLES),
)
def row_counts(spark, sf_dir):
    return agg.row_counts({t: table(spark, sf_dir, t) for t in TABLES})


@query(
    "agg8_date_span",
    "SELECT count(*) AS row_count, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders",
)
def date_span(spark, sf_dir):
    return agg.date_span(orders(spark, sf_dir), "o_orderdate")


@query(
    "agg9_quality_score",
    """SELECT event_type AS source, CAST(ts AS DATE) AS day, count(*) FILTER (value <= 20) AS valid,
        count(*) FILTER (value > 20) AS rejected, round(count(*) FILTER (value <= 20) / count(*), 6) AS quality_score,
        round(count(*) FILTER (value > 20) / count(*), 6) AS reject_ratio FROM events GROUP BY ALL""",
)
def quality_score(spark, sf_dir):
    keys = [F.col("event_type").alias("source"), F.to_date("ts").alias("day")]
    out = agg.quality_score(events(spark, sf_dir), F.col("value") <= 20, keys)
    return out.withColumns({c: rounded(c) for c in ("quality_score", "reject_ratio")})


SLO_SQL = """WITH s AS (SELECT CAST(ts AS DATE) AS day, avg(CAST(event_type <> 'error' AS INTEGER)) AS success_rate,
        avg(CAST(value < 40 AS INTEGER)) AS check_pass_rate, quantile_cont(value, 0.95) AS latency_p95_s,
        min(24 - date_part('epoch', ts - date_trunc('day', ts)) / 3600) AS gold_age_h FROM events GROUP BY ALL),
    l AS (SELECT day, 'success_rate' AS slo, success_rate AS observed, 0.8::DOUBLE AS threshold, success_rate >= 0.8 AS met FROM s
        UNION ALL SELECT day, 'check_pass_rate', check_pass_rate, 0.88, check_pass_rate >= 0.88 FROM s
        UNION ALL SELECT day, 'latency_p95_s', latency_p95_s, 60, latency_p95_s <= 60 FROM s
        UNION ALL SELECT day, 'gold_age_h', gold_age_h, 0.05, gold_age_h <= 0.05 FROM s)
"""


def _slos(spark, sf_dir):
    """Events as runs: errors fail, values are latencies, Gold is as old as the day's last event."""
    df = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    into_day = (F.unix_micros("ts") - F.unix_micros(F.date_trunc("day", "ts"))) / F.lit(3_600_000_000.0)
    return agg.slo_table(
        df, ["day"], F.col("event_type") != "error", F.col("value") < 40, "value",
        F.min(F.lit(24.0) - into_day),
        {"success_rate": 0.8, "check_pass_rate": 0.88, "latency_p95_s": 60, "gold_age_h": 0.05},
    ).withColumn("observed", rounded("observed"))


@query(
    "agg10_slo_table",
    SLO_SQL + "SELECT day, slo, round(observed, 6) AS observed, threshold, CASE WHEN met THEN 'ok' ELSE 'breach' END AS status FROM l",
)
def slo_table(spark, sf_dir):
    return _slos(spark, sf_dir)


@query(
    "agg10_slo_breaches",
    SLO_SQL + "SELECT day, slo, round(observed, 6) AS observed, threshold, 'breach' AS status FROM l WHERE NOT met",
)
def slo_breaches(spark, sf_dir):
    return agg.breaches(_slos(spark, sf_dir))


@query("agg11_fingerprint", "SELECT count(*) AS row_count, 2::BIGINT AS copies FROM lineitem")
def fingerprint(spark, sf_dir):
    """A table and a shuffled copy of it have the same fingerprint."""
    df = table(spark, sf_dir, "lineitem")
    copy = df.repartition("l_shipdate").select(*reversed(df.columns))
    prints = agg.table_fingerprint(df).unionByName(agg.table_fingerprint(copy))
    return prints.groupBy("row_count", "schema", "checksum").agg(F.count(F.lit(1)).alias("copies")).select(
        "row_count", "copies"
    )


@query(
    "agg12_two_groups",
    """WITH s AS (SELECT avg(value) FILTER (event_type = 'purchase') AS m1, var_samp(value) FILTER (event_type = 'purchase') AS v1,
        count(value) FILTER (event_type = 'purchase') AS n1, avg(value) FILTER (event_type = 'view') AS m2,
        var_samp(value) FILTER (event_type = 'view') AS v2, count(value) FILTER (event_type = 'view') AS n2 FROM events)
    SELECT 'purchase' AS group_a, 'view' AS group_b, n1 AS n_a, n2 AS n_b, round(m1, 6) AS mean_a, round(m2, 6) AS mean_b,
        round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 6) AS t,
        round((v1 / n1 + v2 / n2) ** 2 / ((v1 / n1) ** 2 / (n1 - 1) + (v2 / n2) ** 2 / (n2 - 1)), 4) AS df FROM s""",
)
def two_groups(spark, sf_dir):
    out = agg.two_group_means(events(spark, sf_dir), "event_type", "purchase", "view", "value")
    return out.withColumns(
        {"mean_a": rounded("mean_a"), "mean_b": rounded("mean_b"), "t": rounded("t"), "df": rounded("df", 4)}
    )


@query(
    "agg13_step_durations",
    """SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS runs, round(avg(round(value * 100)), 6) AS avg_duration,
        round(quantile_cont(round(value * 100), 0.5), 6) AS p50_duration,
        round(quantile_cont(round(value * 100), 0.95), 6) AS p95_duration
    FROM events GROUP BY ALL""",
)
def step_durations(spark, sf_dir):
    df = events(spark, sf_dir).withColumn("value", F.round(F.col("value") * 100))
    out = agg.step_durations(df, "event_type", "ts", "value")
    return out.withColumns({c: rounded(c) for c in ("avg_duration", "p50_duration", "p95_duration")})


@query(
    "agg13_quantiles_whole_table",
    """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.01), 6) AS p01,
        round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.999), 6) AS p999 FROM lineitem GROUP BY ALL""",
)
def quantiles_whole_table(spark, sf_dir):
    """Three groups hold all rows."""
    from tarn.operators.scans import exact_quantiles

    out = exact_quantiles(
        table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice",
        {"p01": 0.01, "p50": 0.5, "p999": 0.999},
    )
    return out.withColumns({c: rounded(c) for c in ("p01", "p50", "p999")})


@query(
    "agg14_model_costs",
    """SELECT role AS model, count(*) AS calls, CAST(sum(length(text)) AS BIGINT) AS tokens,
        round(sum(length(text) * (CASE WHEN role = 'assistant' THEN 15.0 ELSE 3.0 END) / 1e6), 6) AS cost
    FROM conversations GROUP BY role""",
)
def model_costs(spark, sf_dir):
    price = F.when(F.col("role") == "assistant", 15.0).otherwise(3.0)
    out = agg.model_costs(
        table(spark, sf_dir, "conversations"), [F.col("role").alias("model")], F.length("text").cast("long"), price
    )
    return out.withColumn("cost", rounded("cost"))


SESSION_SQL = """WITH o AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
    f AS (SELECT *, CASE WHEN before IS NULL OR epoch_us(ts) - epoch_us(before) >= 21600000000 THEN 1 ELSE 0 END AS opens FROM o),
    s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no FROM f)
"""


@query(
    "agg_sessions",
    SESSION_SQL + """SELECT user_id, min(ts) AS session_start, max(ts) AS last_seen, count(*) AS n FROM s GROUP BY user_id, session_no""",
)
def sessions(spark, sf_dir):
    """Six-hour sessions per user, the batch form of the streaming sessions."""
    out = agg.sessions(events(spark, sf_dir), ["user_id"], "ts", "event_id", 6 * 3600)
    return out.select("user_id", ntz("session_start").alias("session_start"), ntz("last_seen").alias("last_seen"), "n")
