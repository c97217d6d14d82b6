"""SQL surface: the statements a user of an ad-hoc SQL entry point runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tarn.operators import ranges, sketches
from tarn.operators.joins import asof_join
from tarn.operators.scans import exact_quantiles
from tarn.operators.validate import ingest
from tarn.plans.bindings.registry import events, orders, query, rounded, table
from tarn.plans.refresh import Step, refresh
from tarn.session import scratch_database, stage
from tarn.sources.schemas import TableSchema, columns
from tarn.sources.tables import run_sql


def _sql(spark, sf_dir, statement, *names):
    """Run a statement in which ``{name}`` stands for a test table."""
    views = {}
    for n in names:
        views[n] = f"tarn_{n}_{abs(hash(sf_dir)) % 10**8}"
        table(spark, sf_dir, n).createOrReplaceTempView(views[n])
    return run_sql(spark, statement.format(**views))


JOINS = {
    "sql1_inner_join": """SELECT o_orderkey, c_mktsegment FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "sql1_left_join": """SELECT c_custkey, count(o_orderkey) AS n FROM {customer} LEFT JOIN {orders} ON o_custkey = c_custkey
        AND o_orderstatus = 'F' GROUP BY c_custkey""",
    "sql1_full_join": """SELECT coalesce(a.k, b.k) AS k, a.n AS customers, b.n AS suppliers
        FROM (SELECT c_nationkey AS k, count(*) AS n FROM {customer} WHERE c_acctbal > 5000 GROUP BY c_nationkey) a
        FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM {supplier} GROUP BY s_nationkey) b ON a.k = b.k""",
    "sql1_semi_join": """SELECT c_custkey, c_name FROM {customer} WHERE EXISTS (SELECT 1 FROM {orders}
        WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
    "sql1_anti_join": """SELECT c_custkey, c_name FROM {customer} WHERE NOT EXISTS (SELECT 1 FROM {orders}
        WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""",
}


def _register_joins():
    for name, statement in JOINS.items():
        names = [t for t in ("customer", "orders", "supplier") if "{" + t + "}" in statement]

        def run(spark, sf_dir, statement=statement, names=names):
            return _sql(spark, sf_dir, statement, *names)

        query(name, statement.format(**{t: t for t in names}))(run)


_register_joins()


@query(
    "sql2_range_join",
    """WITH bands AS (SELECT s_nationkey, min(s_acctbal) AS low, max(s_acctbal) AS high FROM supplier GROUP BY s_nationkey)
    SELECT s_nationkey, count(c_custkey) AS customers, round(sum(c_acctbal), 2) AS balance
    FROM bands JOIN customer ON c_acctbal BETWEEN low AND high GROUP BY s_nationkey""",
)
def range_join(spark, sf_dir):
    """Customers inside the balance band of each nation's suppliers, by running totals."""
    bands = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(
        F.min("s_acctbal").alias("low"), F.max("s_acctbal").alias("high")
    )
    cents = F.round(F.col("c_acctbal") * 100).cast("long")
    customers = table(spark, sf_dir, "customer")
    out = ranges.range_totals(bands, customers, "low", "high", "c_acctbal", {"customers": F.lit(1).cast("long"), "cents": cents})
    return out.filter("customers > 0").select("s_nationkey", "customers", rounded(F.col("cents") / 100, 2).alias("balance"))


@query(
    "sql2_range_pairs",
    """SELECT s_suppkey, c_custkey, s_nationkey FROM supplier JOIN customer
        ON c_nationkey = s_nationkey AND c_acctbal BETWEEN s_acctbal - 200 AND s_acctbal + 200""",
)
def range_pairs(spark, sf_dir):
    """Suppliers with the customers of their nation whose balance is near theirs."""
    bands = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_nationkey", F.col("s_nationkey").alias("nation"), (F.col("s_acctbal") - 200).alias("low"), (F.col("s_acctbal") + 200).alias("high")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), "c_acctbal")
    return ranges.range_join(bands, customers, "low", "high", "c_acctbal", ["nation"]).select("s_suppkey", "c_custkey", "s_nationkey")


@query(
    "sql2_within_interval",
    """SELECT p.event_id FROM events p WHERE p.event_type = 'purchase' AND EXISTS (SELECT 1 FROM events v
        WHERE v.user_id = p.user_id AND v.event_type = 'view' AND v.ts <= p.ts AND v.ts >= p.ts - INTERVAL 12 HOUR)""",
)
def within_interval(spark, sf_dir):
    """Purchases within twelve hours of a view: the latest view before decides, no pairs are built."""
    df = events(spark, sf_dir)
    views = df.filter("event_type = 'view'").select("user_id", "ts", F.unix_micros("ts").alias("at"))
    buys = df.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    found = asof_join(buys, views, ["user_id"], "ts", "ts", "at", "seen_at")
    near = F.unix_micros("ts") - F.col("seen_at") <= 12 * 3600 * 1_000_000
    return found.filter(near).select("event_id")


STATEMENTS = {
    "sql3_group_distinct": (
        """SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers,
            round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM {lineitem} GROUP BY l_returnflag, l_linestatus""",
        ["lineitem"],
    ),
    "sql4_grouping_sets": (
        """SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM {orders}
        GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ())""",
        ["orders"],
    ),
    "sql4_rollup": (
        """SELECT l_returnflag, l_linestatus, sum(l_linenumber) AS s FROM {lineitem} GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
        ["lineitem"],
    ),
    "sql5_window_ranks": (
        """WITH m AS (SELECT o_orderpriority, year(o_orderdate) AS y, month(o_orderdate) AS m, max(o_totalprice) AS best FROM {orders}
            GROUP BY o_orderpriority, year(o_orderdate), month(o_orderdate))
        SELECT o_orderpriority, y, m, row_number() OVER w AS rn, rank() OVER w AS rk, ntile(4) OVER w AS quarter,
            lag(best) OVER (PARTITION BY o_orderpriority ORDER BY y, m) AS previous,
            max(best) OVER (PARTITION BY o_orderpriority ORDER BY y, m ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS best3
        FROM m WINDOW w AS (PARTITION BY o_orderpriority ORDER BY best DESC, y, m)""",
        ["orders"],
    ),
    "sql5_top_per_group": (
        """SELECT o_orderpriority, o_orderkey, o_totalprice, rn FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority
            ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM {orders}) t WHERE rn <= 5""",
        ["orders"],
    ),
    "sql6_top_k": (
        "SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
        ["orders"],
    ),
    "sql7_filter_sort": (
        """SELECT c_custkey, c_acctbal FROM {customer} WHERE c_acctbal <> 0 AND c_mktsegment = 'MACHINERY' ORDER BY c_acctbal, c_custkey""",
        ["customer"],
    ),
    "sql8_union": (
        "SELECT c_nationkey AS k FROM {customer} UNION SELECT s_nationkey FROM {supplier}",
        ["customer", "supplier"],
    ),
    "sql8_intersect": (
        "SELECT o_custkey AS k FROM {orders} INTERSECT SELECT c_custkey FROM {customer}",
        ["orders", "customer"],
    ),
    "sql8_except_all": (
        "SELECT c_nationkey AS k FROM {customer} EXCEPT ALL SELECT s_nationkey FROM {supplier}",
        ["customer", "supplier"],
    ),
    "sql9_strings": (
        """SELECT p_partkey, lower(p_type) || '|' || p_brand AS part_key, upper(substring(p_name, 1, 3)) AS short,
            regexp_replace(p_brand, '[^0-9]', '') AS digits, length(p_name) AS chars, replace(p_name, ' ', '_') AS snake FROM {part}""",
        ["part"],
    ),
    "sql12_json": (
        "SELECT event_id, CAST(get_json_object(props, '$.k') AS INT) AS k FROM {events}",
        ["events"],
    ),
    "sql14_subqueries": (
        """WITH spend AS (SELECT o_custkey, sum(o_totalprice) AS total, count(*) AS n FROM {orders} GROUP BY o_custkey HAVING count(*) > 3)
        SELECT o_custkey, n FROM spend WHERE total > (SELECT avg(total) FROM spend)
        AND o_custkey IN (SELECT c_custkey FROM {customer} WHERE c_acctbal > 0)""",
        ["orders", "customer"],
    ),
}

# statements whose Spark and DuckDB spellings differ
OTHER_SPELLING = {
    "sql9_strings": """SELECT p_partkey, lower(p_type) || '|' || p_brand AS part_key, upper(substring(p_name, 1, 3)) AS short,
        regexp_replace(p_brand, '[^0-9]', '', 'g') AS digits, CAST(length(p_name) AS INTEGER) AS chars, replace(p_name, ' ', '_') AS snake FROM part""",
    "sql12_json": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "sql4_rollup": "SELECT l_returnflag, l_linestatus, CAST(sum(l_linenumber) AS BIGINT) AS s FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)",
    "sql5_window_ranks": """WITH m AS (SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
            max(o_totalprice) AS best FROM orders GROUP BY ALL)
        SELECT o_orderpriority, y, m, CAST(row_number() OVER w AS INTEGER) AS rn, CAST(rank() OVER w AS INTEGER) AS rk, CAST(ntile(4) OVER w AS INTEGER) AS quarter,
            lag(best) OVER (PARTITION BY o_orderpriority ORDER BY y, m) AS previous,
            max(best) OVER (PARTITION BY o_orderpriority ORDER BY y, m ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS best3
        FROM m WINDOW w AS (PARTITION BY o_orderpriority ORDER BY best DESC, y, m)""",
    "sql5_top_per_group": """SELECT o_orderpriority, o_orderkey, o_totalprice, CAST(rn AS INTEGER) AS rn FROM (SELECT *, row_number() OVER (
        PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) t WHERE rn <= 5""",
}


def _register_statements():
    for name, (statement, names) in STATEMENTS.items():

        def run(spark, sf_dir, statement=statement, names=names):
            return _sql(spark, sf_dir, statement, *names)

        query(name, OTHER_SPELLING.get(name, statement.format(**{t: t for t in names})))(run)


_register_statements()


@query(
    "sql10_dates",
    """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(DATE '2002-01-01' - CAST(o_orderdate AS DATE) AS INTEGER) AS lag_days,
        CAST(o_orderdate + INTERVAL 30 DAY AS DATE) AS due, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
        CAST(isodow(o_orderdate) AS INTEGER) AS weekday, strftime(o_orderdate, '%Y-%m') AS label FROM orders""",
)
def dates(spark, sf_dir):
    day = F.col("o_orderdate")
    return orders(spark, sf_dir).select(
        "o_orderkey",
        F.trunc(day, "month").alias("month"),
        F.datediff(F.lit("2002-01-01").cast("date"), day).alias("lag_days"),
        F.date_add(day, 30).alias("due"),
        F.quarter(day).alias("quarter"),
        (F.weekday(day) + 1).alias("weekday"),
        F.date_format(day, "yyyy-MM").alias("label"),
    )


@query(
    "sql11_math",
    """SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS sd, round(avg(l_extendedprice / nullif(l_quantity - 10, 0)), 6) AS mean_ratio,
        round(corr(l_quantity, l_extendedprice), 6) AS r, round(exp(avg(ln(l_extendedprice))), 4) AS geometric FROM lineitem GROUP BY l_returnflag""",
)
def math(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return df.groupBy("l_returnflag").agg(
        rounded(F.stddev_samp("l_quantity")).alias("sd"),
        rounded(F.avg(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity") - 10))).alias("mean_ratio"),
        rounded(F.corr("l_quantity", "l_extendedprice")).alias("r"),
        rounded(F.exp(F.avg(F.ln("l_extendedprice"))), 4).alias("geometric"),
    )


@query(
    "sql13_arrays",
    """WITH w AS (SELECT doc_id, unnest(list_distinct(string_split(lower(text), ' '))) AS word FROM documents)
    SELECT word, count(*) AS documents FROM w WHERE length(word) > 12 GROUP BY word""",
)
def arrays(spark, sf_dir):
    words = F.array_distinct(F.split(F.lower("text"), " "))
    df = table(spark, sf_dir, "documents").select("doc_id", F.explode(words).alias("word"))
    return df.filter(F.length("word") > 12).groupBy("word").agg(F.count(F.lit(1)).alias("documents"))


@query(
    "sql15_approximate",
    """SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts,
        true AS orders_near, true AS parts_near, true AS median_near FROM lineitem GROUP BY l_returnflag""",
)
def approximate(spark, sf_dir):
    """Sketch-based counts and a percentile, and whether they are within 10 % of the exact values."""
    df = table(spark, sf_dir, "lineitem")
    sketched = df.groupBy("l_returnflag").agg(
        F.approx_count_distinct("l_orderkey", 0.02).alias("orders_about"),
        F.hll_sketch_estimate(F.hll_sketch_agg("l_partkey")).alias("parts_about"),
        F.percentile_approx("l_extendedprice", 0.5, 1000).alias("median_about"),
    )
    # in one aggregate with distinct counts, Spark would keep three sketches per distinct value
    counted = df.groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts")
    )
    exact = exact_quantiles(df, ["l_returnflag"], "l_extendedprice", {"median": 0.5})
    near = lambda about, value: F.abs(F.col(about) - F.col(value)) <= F.col(value) * 0.1
    return sketched.join(counted, "l_returnflag").join(exact, "l_returnflag").select(
        "l_returnflag", "orders", "parts",
        near("orders_about", "orders").alias("orders_near"),
        near("parts_about", "parts").alias("parts_near"),
        near("median_about", "median").alias("median_near"),
    )


MONTHLY = """SELECT event_type, CAST(date_trunc('month', ts) AS DATE) AS month, count(*) AS n, true AS users_near, true AS median_near, true AS tail_near
    FROM events WHERE ts IS NOT NULL GROUP BY ALL"""


@query("sql15_stored_sketches", MONTHLY)
def stored_sketches(spark, sf_dir):
    """Distinct users and quantiles by month, merged from a table of daily states that two refreshes have filled.

    A distinct count must be within three standard errors, a quantile within three rank errors of its sketch.
    """
    db, df = scratch_database(spark, "sketches"), events(spark, sf_dir)
    schema = TableSchema("events", columns(event_id="long", ts="timestamptz", user_id="long", event_type="string", value="double"))
    step = Step("event_states", f"{db}.events", lambda rows: sketches.daily_states(rows, ["event_type"], "ts", ["user_id"], ["value"]))
    for drop in (0, 1):
        new = df.filter(F.pmod(F.dayofmonth("ts"), F.lit(2)) == drop) if drop else df.filter("ts IS NULL OR pmod(dayofmonth(ts), 2) = 0")
        ingest(new, "events", schema, dt.datetime(2024, 3, 1 + drop, tzinfo=dt.UTC), (), db, read_once=False)
        refresh(spark, f"{db}.events", "ts", [step], db)
    monthly = stage(sketches.merged_states(spark.table(f"{db}.event_states"), ["event_type"], "month"), "monthly")
    about = monthly.select(
        "event_type", F.col("day").alias("month"), "n", sketches.distinct_count("user_id").alias("users_about"),
        sketches.quantile("value", 0.5).alias("median_about"), sketches.quantile("value", 0.95).alias("tail_about"),
    )
    exact = df.withColumn("month", F.to_date(F.date_trunc("month", "ts")))
    users = exact.groupBy("event_type", "month").agg(F.count_distinct("user_id").alias("users"))
    error = 3 * 0.0173  # of a rank, at the size of the states
    bounds = {f"{name}_{side}": min(1.0, max(0.0, q + sign * error)) for name, q in (("median", 0.5), ("tail", 0.95)) for side, sign in (("low", -1), ("high", 1))}
    near = lambda name: F.col(f"{name}_about").between(F.col(f"{name}_low"), F.col(f"{name}_high")).alias(f"{name}_near")
    joined = about.join(users, ["event_type", "month"]).join(exact_quantiles(exact, ["event_type", "month"], "value", bounds), ["event_type", "month"])
    near_users = F.abs(F.col("users_about") - F.col("users")) <= F.greatest(F.lit(1), F.col("users") * 3 * 0.0163)
    return joined.select("event_type", "month", "n", near_users.alias("users_near"), near("median"), near("tail"))
