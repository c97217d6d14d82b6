"""Lookups, as-of joins, series joins and lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarn.functions import formulas
from tarn.functions.fixed_values import PRODUCTION_TYPES
from tarn.operators import joins, lineage
from tarn.operators.aggregates import latest_per_key
from tarn.operators.series import resample
from tarn.operators.validate import business_days
from tarn.plans import gold, silver
from tarn.session import stage
from tarn.plans.bindings.registry import DAILY_CLOSES, daily_closes, events, lineitem, ntz, orders, query, rounded, table


@query(
    "join1_dimension_lookup",
    """SELECT c_custkey, n_name AS nation, r_name AS region FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def dimension_lookup(spark, sf_dir):
    nations = joins.lookup(
        table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"), "c_nationkey", "n_nationkey",
        {"nation": "n_name", "n_regionkey": "n_regionkey"},
    )
    regions = joins.lookup(
        nations, table(spark, sf_dir, "region"), "n_regionkey", "r_regionkey", {"region": "r_name"}
    )
    return regions.select("c_custkey", "nation", "region")


@query(
    "join1_production_types",
    "WITH named(code, name) AS (VALUES " + ", ".join(f"('{c}', '{n}')" for c, n in PRODUCTION_TYPES.items()) + """)
    SELECT name AS production_type, count(*) AS n, round(sum(value), 2) AS quantity FROM
        (SELECT *, 'B' || lpad(CAST(user_id % 26 AS VARCHAR), 2, '0') AS psr FROM events) LEFT JOIN named ON psr = code GROUP BY ALL""",
)
def production_types(spark, sf_dir):
    """Events as generation per plant type; codes that are not listed keep their rows without a name."""
    psr = F.concat(F.lit("B"), F.lpad((F.col("user_id") % 26).cast("string"), 2, "0"))
    listed = spark.createDataFrame(list(PRODUCTION_TYPES.items()), "code string, name string")
    named = joins.lookup(events(spark, sf_dir).withColumn("psr", psr), listed, "psr", "code", {"production_type": "name"})
    return named.groupBy("production_type").agg(F.count(F.lit(1)).alias("n"), rounded(F.sum("value"), 2).alias("quantity"))


@query(
    "join2_attribute_by_name",
    """WITH power AS (SELECT p_brand, max(p_retailprice) AS tdp FROM part WHERE p_brand < 'Brand#2' GROUP BY p_brand)
    SELECT p_partkey, tdp AS tdp_watts FROM part LEFT JOIN power USING (p_brand)""",
)
def attribute_by_name(spark, sf_dir):
    """Brand names written differently still meet; brands without power give null."""
    part = table(spark, sf_dir, "part")
    power = part.filter("p_brand < 'Brand#2'").groupBy("p_brand").agg(F.max("p_retailprice").alias("tdp"))
    facts = part.select("p_partkey", F.concat(F.lit("  "), F.upper("p_brand"), F.lit(" ")).alias("accelerator"))
    found = joins.lookup_name(facts, power, "accelerator", "p_brand", "tdp", "tdp_watts")
    return found.select("p_partkey", "tdp_watts")


@query(
    "join3_longest_pattern",
    """WITH words AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS pattern FROM part WHERE p_name NOT LIKE 'red%'
        UNION SELECT DISTINCT p_name FROM part WHERE p_type = 'ECONOMY' AND p_size = 1),
    best AS (SELECT n.p_name, pattern FROM (SELECT DISTINCT p_name FROM part) n JOIN words ON contains(n.p_name, pattern)
        QUALIFY row_number() OVER (PARTITION BY n.p_name ORDER BY length(pattern) DESC, pattern) = 1)
    SELECT p_partkey, upper(pattern) AS accelerator FROM part LEFT JOIN best USING (p_name)""",
)
def longest_pattern(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    first = F.split_part("p_name", F.lit(" "), F.lit(1))
    words = part.filter("p_name NOT LIKE 'red%'").select(first.alias("pattern"))
    whole = part.filter("p_type = 'ECONOMY' AND p_size = 1").select(F.col("p_name").alias("pattern"))
    patterns = words.union(whole).distinct().withColumn("accelerator", F.upper("pattern"))
    found = joins.lookup_pattern(part, patterns, "p_name", "pattern", "accelerator", "accelerator")
    return found.select("p_partkey", "accelerator")


@query(
    "join4_rate_by_day",
    f"""WITH rates AS ({DAILY_CLOSES}),
    f AS (SELECT *, CASE WHEN l_returnflag = 'A' THEN '1-URGENT' WHEN l_returnflag = 'N' THEN '2-HIGH' ELSE '3-MEDIUM' END AS symbol,
        CAST(l_shipdate AS DATE) AS ship_day FROM lineitem)
    SELECT f.symbol, CAST(date_trunc('month', ship_day) AS DATE) AS month, count(*) AS n, count(close) AS rated,
        round(sum(l_extendedprice / close), 6) AS converted
    FROM f ASOF LEFT JOIN rates r ON f.symbol = r.symbol AND f.ship_day >= r.day GROUP BY ALL""",
)
def rate_by_day(spark, sf_dir):
    """Ship dates meet the last business-day rate at or before them."""
    facts = lineitem(spark, sf_dir).withColumn(
        "symbol",
        F.when(F.col("l_returnflag") == "A", "1-URGENT").when(F.col("l_returnflag") == "N", "2-HIGH").otherwise("3-MEDIUM"),
    )
    until = facts.agg(F.max("l_shipdate").alias("d")).first()["d"]
    calendar = joins.rate_calendar(daily_closes(spark, sf_dir), ["symbol"], "day", "close", until)
    rated = joins.join_rate(facts, calendar, ["symbol"], F.col("l_shipdate"), "day", "close", "rate")
    return rated.groupBy("symbol", F.trunc("l_shipdate", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("rate").alias("rated"),
        rounded(F.sum(F.col("l_extendedprice") / F.col("rate"))).alias("converted"),
    )


@query(
    "join4_asof_exact",
    """WITH views AS (SELECT user_id, ts AS view_ts, max(value) AS view_value FROM events WHERE event_type = 'view' GROUP BY ALL)
    SELECT e.event_id, v.view_value FROM (SELECT * FROM events WHERE event_type <> 'view') e
    ASOF LEFT JOIN views v ON e.user_id = v.user_id AND e.ts >= v.view_ts""",
)
def asof_exact(spark, sf_dir):
    """The value of the user's latest view at every other event."""
    df = events(spark, sf_dir)
    found = joins.asof_join(
        df.filter("event_type <> 'view'").select("event_id", "user_id", "ts"),
        df.filter("event_type = 'view'"),
        ["user_id"], "ts", "ts", "value", "view_value",
    )
    return found.select("event_id", "view_value")


@query(
    "join4_asof_hot_rates",
    """WITH rates AS (SELECT user_id % 2 AS k, ts AS rate_ts, max(value) AS rate FROM events WHERE event_type <> 'signup' GROUP BY ALL)
    SELECT e.event_id, r.rate FROM (SELECT *, user_id % 2 AS k FROM events WHERE event_type = 'signup') e
    ASOF LEFT JOIN rates r ON e.k = r.k AND e.ts >= r.rate_ts""",
)
def asof_hot_rates(spark, sf_dir):
    """Few facts and many rates of two keys: the rates decide how short a segment is."""
    df = events(spark, sf_dir).withColumn("k", F.col("user_id") % 2)
    facts = df.filter("event_type = 'signup'").select("event_id", "k", "ts")
    rates = df.filter("event_type <> 'signup'").select("k", F.col("ts").alias("rate_ts"), F.col("value").alias("v"))
    return joins.asof_join(facts, rates, ["k"], "ts", "rate_ts", "v", "rate", segment_rows=50).select("event_id", "rate")


COST_SQL = """WITH carbon AS (SELECT event_type AS country, date_trunc('hour', ts) AS h, avg(value) AS intensity FROM events GROUP BY ALL),
    efficiency AS (SELECT p_brand AS accelerator, p_type AS model_name, max(p_retailprice) AS speed, avg(p_size) * 10 AS tdp FROM part GROUP BY ALL),
    price AS (SELECT event_type AS country, 'Brand#' || (user_id % 25 + 1) AS accelerator, CAST(ts AS DATE) AS day, avg(value) + 1 AS price FROM events GROUP BY ALL)
"""


def _cost_inputs(spark, sf_dir):
    df = events(spark, sf_dir)
    carbon = df.groupBy(F.col("event_type").alias("country"), F.date_trunc("hour", "ts").alias("timestamp_hour")).agg(
        F.avg("value").alias("carbon_intensity_gco2_kwh")
    )
    efficiency = table(spark, sf_dir, "part").groupBy(
        F.col("p_brand").alias("accelerator"), F.col("p_type").alias("model_name")
    ).agg(F.max("p_retailprice").alias("tokens_per_sec"), (F.avg("p_size") * 10).alias("tdp_watts"))
    efficiency = efficiency.withColumn(
        "wh_per_million_tokens", formulas.wh_per_million_tokens("tdp_watts", "tokens_per_sec")
    )
    brand = F.concat(F.lit("Brand#"), (F.col("user_id") % 25 + 1).cast("string"))
    pricing = df.groupBy(
        F.col("event_type").alias("country"), brand.alias("accelerator"), F.to_date("ts").alias("valid_from")
    ).agg((F.avg("value") + 1).alias("price_eur_per_hour"))
    # the three Silver tables are written before Gold reads them
    return stage(carbon, "silver"), stage(efficiency, "silver"), stage(pricing, "silver")


@query(
    "join5_hourly_cost",
    COST_SQL + """SELECT country, accelerator, count(*) AS n,
        round(avg(price / (speed * 3600) * 1e6), 6) AS eur_per_million_tokens,
        round(avg(intensity * (tdp / speed / 3600 * 1e6) / 1000), 6) AS gco2_per_million_tokens
    FROM carbon JOIN price p USING (country) JOIN efficiency USING (accelerator)
    WHERE CAST(h AS DATE) = p.day GROUP BY ALL""",
)
def hourly_cost(spark, sf_dir):
    rows = joins.hourly_cost_join(*_cost_inputs(spark, sf_dir))
    eur = formulas.eur_per_million_tokens("price_eur_per_hour", formulas.tokens_per_hour("tokens_per_sec"))
    gco2 = formulas.gco2_per_million_tokens("carbon_intensity_gco2_kwh", "wh_per_million_tokens")
    return rows.groupBy("country", "accelerator").agg(
        F.count(F.lit(1)).alias("n"),
        rounded(F.avg(eur)).alias("eur_per_million_tokens"),
        rounded(F.avg(gco2)).alias("gco2_per_million_tokens"),
    )


@query(
    "gold1_ai_inference_cost",
    COST_SQL + """, bounds AS (SELECT CAST(max(ts) AS DATE) AS last_day FROM events),
    spans AS (SELECT country, accelerator, unnest(generate_series(min(day), (SELECT last_day FROM bounds), INTERVAL 1 DAY))::DATE AS day
        FROM price GROUP BY country, accelerator),
    filled AS (SELECT s.country, s.accelerator, s.day, p.price FROM spans s
        ASOF LEFT JOIN price p ON s.country = p.country AND s.accelerator = p.accelerator AND s.day >= p.day),
    greenest AS (SELECT *, intensity < quantile_cont(intensity, 0.25) OVER (PARTITION BY country, CAST(h AS DATE)) AS green FROM carbon),
    mart AS (SELECT g.country, accelerator, g.h, g.green, f.price,
        price / (speed * 3600) * 1e6 AS eur, intensity * (tdp / speed / 3600 * 1e6) / 1000 AS gco2
        FROM greenest g JOIN filled f ON g.country = f.country AND CAST(g.h AS DATE) = f.day JOIN efficiency USING (accelerator)),
    flagged AS (SELECT *, price < quantile_cont(price, 0.25) OVER (PARTITION BY accelerator, CAST(h AS DATE)) AS cheap FROM mart)
    SELECT country, accelerator, count(*) AS n, count(*) FILTER (green) AS greenest_hours, count(*) FILTER (cheap) AS cheapest_hours,
        round(avg(eur), 6) AS eur_per_million_tokens, round(avg(gco2), 6) AS gco2_per_million_tokens
    FROM flagged GROUP BY ALL""",
)
def ai_inference_cost(spark, sf_dir):
    """The whole Gold table, reported per country and accelerator."""
    carbon, efficiency, pricing = _cost_inputs(spark, sf_dir)
    # the instance type stands for the accelerator, the region for the country
    pricing = pricing.select(
        F.lit("cloud").alias("provider"), F.col("accelerator").alias("instance_type"),
        F.col("country").alias("region"), "accelerator", "price_eur_per_hour", "valid_from",
    )
    regions = carbon.select(F.col("country").alias("region"), "country").distinct()
    cost = gold.ai_inference_cost(carbon, efficiency, pricing, regions)
    return cost.groupBy("country", "accelerator").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("greenest_hour_flag").alias("greenest_hours"),
        F.count_if("cheapest_hour_flag").alias("cheapest_hours"),
        rounded(F.avg("eur_per_million_tokens")).alias("eur_per_million_tokens"),
        rounded(F.avg("gco2_per_million_tokens")).alias("gco2_per_million_tokens"),
    )


@query(
    "silver1_carbon_intensity",
    """WITH factors AS (SELECT event_type AS psr_type, min(user_id) + 10.0 AS gco2 FROM events WHERE event_type <> 'error' GROUP BY ALL),
    hourly AS (SELECT date_trunc('hour', ts) AS h, 'Z' || (user_id % 5) AS country, event_type AS psr_type, avg(value) AS mw FROM events GROUP BY ALL)
    SELECT h AS timestamp_hour, country,
        round(sum(mw * gco2) / nullif(sum(CASE WHEN gco2 IS NOT NULL THEN mw END), 0), 6) AS carbon_intensity_gco2_kwh
    FROM hourly LEFT JOIN factors USING (psr_type) GROUP BY ALL""",
)
def carbon_intensity(spark, sf_dir):
    """Event types as plant types, users as zones; the type error has no factor."""
    df = events(spark, sf_dir)
    factors = df.filter("event_type <> 'error'").groupBy(F.col("event_type").alias("psr_type")).agg(
        (F.min("user_id") + 10.0).alias("gco2_kwh")
    )
    generation = df.select(
        F.col("ts").alias("timestamp_utc"),
        F.concat(F.lit("Z"), (F.col("user_id") % 5).cast("string")).alias("country"),
        F.col("event_type").alias("psr_type"),
        F.col("value").alias("quantity_mw"),
    )
    out = silver.carbon_intensity(generation, factors)
    return out.select(ntz("timestamp_hour").alias("timestamp_hour"), "country", rounded("carbon_intensity_gco2_kwh").alias("carbon_intensity_gco2_kwh"))


@query(
    "silver2_benchmark_efficiency",
    """WITH tdp AS (SELECT p_brand, CAST(max(p_size) * 10 AS DOUBLE) AS tdp FROM part WHERE p_brand <> 'Brand#3' GROUP BY p_brand),
    best AS (SELECT 'v' || year(l_shipdate) || '.0' AS round_id, p_type AS model_name, p_brand AS accelerator,
        max(l_quantity - 10) AS tokens_per_sec FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE l_linestatus = 'O' AND l_quantity - 10 >= 0 GROUP BY ALL)
    SELECT round_id, model_name, accelerator, tokens_per_sec, tdp AS tdp_watts,
        round(tdp / nullif(tokens_per_sec, 0) / 3600 * 1e6, 6) AS wh_per_million_tokens
    FROM best LEFT JOIN tdp ON accelerator = p_brand""",
)
def benchmark_efficiency(spark, sf_dir):
    """Line items as benchmark results: ship year as round, part type as model."""
    part = table(spark, sf_dir, "part")
    tdp = part.filter("p_brand <> 'Brand#3'").groupBy(F.col("p_brand").alias("accelerator")).agg(
        (F.max("p_size") * 10.0).alias("tdp_watts")
    )
    results = joins.lookup(
        lineitem(spark, sf_dir), part, "l_partkey", "p_partkey", {"model_name": "p_type", "accelerator": "p_brand"}
    ).select(
        F.concat(F.lit("v"), F.year("l_shipdate").cast("string"), F.lit(".0")).alias("round_id"),
        "model_name", "accelerator",
        F.when(F.col("l_linestatus") == "O", "Offline").otherwise("Server").alias("scenario"),
        (F.col("l_quantity") - 10).alias("tokens_per_sec"),
    )
    out = silver.mlperf_efficiency(results, tdp)
    return out.withColumn("wh_per_million_tokens", rounded("wh_per_million_tokens"))


@query(
    "silver3_instance_pricing",
    """WITH prices AS (SELECT o_orderstatus AS provider, p_name AS instance_type, o_orderpriority AS region, l_extendedprice AS usd,
            l_shipdate AS captured_at, l_orderkey || '-' || l_linenumber || '-' || l_suppkey AS sku
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
    latest AS (SELECT *, CAST(captured_at AS DATE) AS valid_from FROM prices
        QUALIFY row_number() OVER (PARTITION BY provider, instance_type, region ORDER BY captured_at DESC, sku DESC, usd DESC) = 1),
    fx AS (SELECT CAST(o_orderdate AS DATE) AS day, 1 + avg(o_totalprice) / 1e6 AS rate FROM orders WHERE isodow(o_orderdate) <= 5 GROUP BY ALL),
    words AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS w FROM part WHERE split_part(p_name, ' ', 2) <> 'bolt')
    SELECT provider, instance_type, region, upper(w) AS accelerator, round(usd / rate, 6) AS price_eur_per_hour, valid_from
    FROM latest ASOF LEFT JOIN fx ON valid_from >= day LEFT JOIN words ON contains(instance_type, w)""",
)
def instance_pricing(spark, sf_dir):
    """Line items as price quotes: the latest quote per status, part name and priority."""
    lines = joins.lookup(
        lineitem(spark, sf_dir), table(spark, sf_dir, "part"), "l_partkey", "p_partkey", {"instance_type": "p_name"}
    )
    placed = lines.join(
        table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("provider"), F.col("o_orderpriority").alias("region")
        ),
        "l_orderkey",
    )
    prices = placed.select(
        "provider", "instance_type", "region", F.col("l_extendedprice").alias("price_usd_per_hour"),
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_suppkey")]).alias("sku_name"),
        F.col("l_shipdate").cast("timestamp").alias("captured_at"),
    )
    fx = business_days(orders(spark, sf_dir), "o_orderdate").groupBy(F.col("o_orderdate").alias("observation_date")).agg(
        (F.avg("o_totalprice") / 1e6 + 1).alias("eur_usd")
    )
    second = F.split_part("p_name", F.lit(" "), F.lit(2))
    patterns = table(spark, sf_dir, "part").select(second.alias("pattern")).distinct().filter("pattern <> 'bolt'")
    out = silver.cloud_gpu_pricing(prices, fx, patterns.withColumn("accelerator", F.upper("pattern")))
    return out.withColumn("price_eur_per_hour", rounded("price_eur_per_hour"))


@query(
    "join6_event_offsets",
    f"""WITH closes AS ({DAILY_CLOSES}),
    s AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY day) AS n FROM closes),
    e AS (SELECT DISTINCT o_orderpriority AS symbol, CAST(date_trunc('month', o_orderdate) AS DATE) AS event_day FROM orders),
    placed AS (SELECT e.symbol, e.event_day, max(n) AS pos FROM e JOIN s ON s.symbol = e.symbol AND s.day <= e.event_day GROUP BY ALL)
    SELECT p.symbol, event_day, CAST(n - pos AS INTEGER) AS "offset", day AS offset_day, close
    FROM placed p JOIN s ON s.symbol = p.symbol AND n BETWEEN pos - 5 AND pos + 5""",
)
def event_offsets(spark, sf_dir):
    months = orders(spark, sf_dir).select(
        F.col("o_orderpriority").alias("symbol"), F.trunc("o_orderdate", "month").alias("event_day")
    ).distinct()
    out = joins.join_event_offsets(months, daily_closes(spark, sf_dir), ["symbol"], "event_day", "day", "close")
    return out.select("symbol", "event_day", "offset", "offset_day", "close")


@query(
    "join7_hourly_features",
    """WITH g AS (SELECT user_id % 10 AS zone, date_trunc('hour', ts) AS h, avg(value) AS mw FROM events WHERE event_type = 'view' GROUP BY ALL),
    w AS (SELECT user_id % 10 AS zone, date_trunc('hour', ts) AS h, avg(value) AS t FROM events WHERE event_type = 'click' GROUP BY ALL)
    SELECT g.zone, g.h AS timestamp_hour, round(mw, 6) AS quantity_mw, round(t, 6) AS temperature FROM g LEFT JOIN w USING (zone, h)""",
)
def hourly_features(spark, sf_dir):
    """Views stand for generation, clicks for weather, of ten zones."""
    df = events(spark, sf_dir).withColumn("zone", F.col("user_id") % 10)
    generation = resample(df.filter("event_type = 'view'"), ["zone"], "ts", "value", out="quantity_mw")
    weather = resample(df.filter("event_type = 'click'"), ["zone"], "ts", "value", out="t")
    out = joins.join_hourly(generation, weather, ["zone", "timestamp_hour"], {"temperature": "t"})
    return out.select(
        "zone", ntz("timestamp_hour").alias("timestamp_hour"), rounded("quantity_mw").alias("quantity_mw"), rounded("temperature").alias("temperature")
    )


@query(
    "join8_lineage_record",
    """WITH snap AS (SELECT l_suppkey, l_orderkey, l_quantity FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) = 1),
    run AS (SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT s_suppkey AS dataset_id, s_name AS owner, l_orderkey AS snapshot_id, l_quantity AS snapshot_rows,
        o_orderkey AS run_id, o_orderstatus AS status
    FROM supplier LEFT JOIN snap ON s_suppkey = l_suppkey LEFT JOIN run ON s_suppkey = o_custkey""",
)
def lineage_record(spark, sf_dir):
    """Suppliers as datasets, their latest line item as snapshot, an order as run."""
    contracts = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("dataset_id"), F.col("s_name").alias("owner"))
    snapshots = latest_per_key(
        lineitem(spark, sf_dir), ["l_suppkey"], "l_shipdate", ["l_orderkey", "l_linenumber", "l_extendedprice"]
    ).select(F.col("l_suppkey").alias("dataset_id"), F.col("l_orderkey").alias("snapshot_id"), F.col("l_quantity").alias("rows"))
    runs = latest_per_key(orders(spark, sf_dir), ["o_custkey"], "o_orderdate", ["o_orderkey"]).select(
        F.col("o_custkey").alias("dataset_id"), F.col("o_orderkey").alias("run_id"), F.col("o_orderstatus").alias("status")
    )
    shape = "contract struct<owner string>, snapshot struct<snapshot_id long, rows double>, run struct<run_id long, status string>"
    parsed = F.from_json("record", shape)
    return lineage.lineage_records(contracts, snapshots, runs).select("dataset_id", parsed.alias("r")).select(
        "dataset_id", "r.contract.owner", "r.snapshot.snapshot_id",
        F.col("r.snapshot.rows").alias("snapshot_rows"), "r.run.run_id", "r.run.status",
    )


CHAIN_SQL = """WITH RECURSIVE edges AS (SELECT DISTINCT conv_id || '/' || turn AS c, conv_id || '/' || (turn - 1) AS p
        FROM conversations WHERE turn > 0
        UNION SELECT conv_id || '/0', role FROM conversations WHERE turn = 0),
    chain(dataset, upstream, depth) AS (SELECT c, p, 1 FROM edges
        UNION SELECT dataset, p, depth + 1 FROM chain JOIN edges ON upstream = c)
"""


def _turn_edges(spark, sf_dir):
    df = table(spark, sf_dir, "conversations")
    name = lambda turn: F.concat_ws("/", F.col("conv_id").cast("string"), turn.cast("string"))
    turns = df.filter("turn > 0").select(name(F.col("turn")).alias("c"), name(F.col("turn") - 1).alias("p"))
    return turns.unionByName(df.filter("turn = 0").select(name(F.col("turn")).alias("c"), F.col("role").alias("p")))


@query(
    "join9_upstream_chain",
    CHAIN_SQL + "SELECT dataset, upstream, CAST(min(depth) AS INTEGER) AS depth FROM chain GROUP BY ALL",
)
def upstream_chain(spark, sf_dir):
    """Turns follow from the turn before them, first turns from their speaker."""
    return lineage.upstream_chain(_turn_edges(spark, sf_dir), "c", "p")


@query(
    "join9_original_sources",
    CHAIN_SQL + """SELECT dataset, upstream, CAST(min(depth) AS INTEGER) AS depth FROM chain
    WHERE upstream NOT IN (SELECT c FROM edges) GROUP BY ALL""",
)
def original_sources(spark, sf_dir):
    edges = _turn_edges(spark, sf_dir)
    return lineage.original_sources(lineage.upstream_chain(edges, "c", "p"), edges, "c")
