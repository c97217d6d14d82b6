"""Bronze to Silver to Gold in one chain: Gold reads nothing but Silver outputs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarn.operators.series import below_quartile
from tarn.operators.validate import business_days, ingest, non_negative
from tarn.plans import gold, silver
from tarn.plans.bindings.registry import events, query, rounded, table
from tarn.plans.refresh import Step, refresh
from tarn.session import scratch_database, stage
from tarn.sources.schemas import TableSchema, columns

BRONZE = {
    "generation": columns(timestamp_utc="timestamptz", country="string", psr_type="string", quantity_mw="double"),
    "results": columns(round_id="string", model_name="string", accelerator="string", scenario="string", tokens_per_sec="double"),
    "prices": columns(
        provider="string", instance_type="string", region="string", sku_name="string",
        price_usd_per_hour="double", captured_at="timestamptz",
    ),
    "rates": columns(currency="string", observation_date="date", eur_usd="double"),
}


def _bronze(spark, sf_dir) -> str:
    """Four Bronze tables out of events and parts; the rates come twice, wrong ones first."""
    db, df = scratch_database(spark, "chain"), events(spark, sf_dir)
    user = lambda n: (F.col("user_id") % n).cast("string")
    signups = business_days(df.filter("event_type = 'signup'"), "ts")
    rates = signups.groupBy(F.lit("USD").alias("currency"), F.to_date("ts").alias("observation_date")).agg(
        (F.avg("value") / 1000 + 1).alias("eur_usd")
    )
    deliveries = [
        ("generation", 1, df.select(
            F.col("ts").alias("timestamp_utc"), F.concat(F.lit("Z"), user(5)).alias("country"),
            F.col("event_type").alias("psr_type"), F.col("value").alias("quantity_mw"),
        )),
        ("results", 1, table(spark, sf_dir, "part").select(
            F.lit("v4.0").alias("round_id"), F.col("p_type").alias("model_name"),
            F.concat(F.lit("A"), (F.col("p_partkey") % 7).cast("string")).alias("accelerator"),
            F.lit("Offline").alias("scenario"), F.col("p_retailprice").alias("tokens_per_sec"),
        )),
        ("prices", 1, df.filter("event_type = 'purchase'").select(
            F.concat(F.lit("cloud"), user(3)).alias("provider"), F.concat(F.lit("Standard_A"), user(7)).alias("instance_type"),
            F.concat(F.lit("r"), user(5)).alias("region"), F.col("event_id").cast("string").alias("sku_name"),
            (F.col("value") + 1).alias("price_usd_per_hour"), F.col("ts").alias("captured_at"),
        )),
        ("rates", 1, rates.withColumn("eur_usd", F.col("eur_usd") * 9)),
        ("rates", 2, rates),
    ]
    rules = {"prices": [non_negative("price_usd_per_hour")], "results": [non_negative("tokens_per_sec")]}
    for name, day, rows in deliveries:
        stamp = dt.datetime(2024, 3, day, tzinfo=dt.UTC)
        ingest(rows, name, TableSchema(name, BRONZE[name]), stamp, rules.get(name, ()), db, read_once=False)
    return db


CHAIN_SQL = """WITH factors AS (SELECT event_type AS psr_type, min(user_id) + 10.0 * length(any_value(event_type)) AS gco2 FROM events WHERE event_type <> 'error' GROUP BY ALL),
    hourly AS (SELECT date_trunc('hour', ts) AS h, 'Z' || (user_id % 5) AS country, event_type AS psr_type, avg(value) AS mw FROM events GROUP BY ALL),
    carbon AS (SELECT h, country, CAST(h AS DATE) AS day, sum(mw * gco2) / nullif(sum(CASE WHEN gco2 IS NOT NULL THEN mw END), 0) AS intensity
        FROM hourly LEFT JOIN factors USING (psr_type) GROUP BY h, country),
    efficiency AS (SELECT p_type AS model_name, 'A' || (p_partkey % 7) AS accelerator, max(p_retailprice) AS speed,
        CAST(100 * (any_value(p_partkey % 7) + 1) AS DOUBLE) AS tdp FROM part WHERE p_retailprice >= 0 GROUP BY ALL),
    quotes AS (SELECT 'cloud' || (user_id % 3) AS provider, 'Standard_A' || (user_id % 7) AS instance_type, 'r' || (user_id % 5) AS region,
        CAST(ts AS DATE) AS day, value + 1 AS usd FROM events WHERE event_type = 'purchase' AND value + 1 >= 0
        QUALIFY row_number() OVER (PARTITION BY provider, instance_type, region, day ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) = 1),
    fx AS (SELECT CAST(ts AS DATE) AS fx_day, 1 + avg(value) / 1000 AS rate FROM events WHERE event_type = 'signup' AND isodow(ts) <= 5 GROUP BY ALL),
    price AS (SELECT provider, instance_type, region, day, usd / rate AS eur FROM quotes ASOF LEFT JOIN fx ON day >= fx_day),
    spans AS (SELECT provider, instance_type, region, unnest(generate_series(min(day), greatest(max(day), (SELECT max(day) FROM carbon)), INTERVAL 1 DAY))::DATE AS day
        FROM price GROUP BY provider, instance_type, region),
    filled AS (SELECT s.*, p.eur FROM spans s ASOF LEFT JOIN (SELECT * FROM price WHERE eur IS NOT NULL) p
        ON s.provider = p.provider AND s.instance_type = p.instance_type AND s.region = p.region AND s.day >= p.day),
    offers AS (SELECT f.*, 'Z' || substring(region, 2) AS country, substring(instance_type, 10) AS accelerator FROM filled f),
    mart AS (SELECT c.h, c.day, c.country, c.intensity, o.provider, o.instance_type, o.region, o.accelerator, o.eur, e.model_name, e.speed, e.tdp
        FROM carbon c JOIN offers o ON c.country = o.country AND c.day = o.day JOIN efficiency e ON e.accelerator = o.accelerator),
    flagged AS (SELECT *, eur < quantile_cont(eur, 0.25) OVER (PARTITION BY provider, instance_type, day) AS cheap,
        intensity < (SELECT quantile_cont(x.intensity, 0.25) FROM carbon x WHERE x.country = mart.country AND x.day = mart.day) AS green FROM mart),
    best AS (SELECT * FROM flagged
        QUALIFY row_number() OVER (PARTITION BY country, h, model_name, accelerator ORDER BY eur NULLS LAST, provider, instance_type, region) = 1)
"""


@query(
    "gold1_from_bronze",
    CHAIN_SQL + """SELECT country, accelerator, count(*) AS n, count(DISTINCT (h, model_name)) AS grain,
        count(*) FILTER (green) AS greenest_hours, count(*) FILTER (cheap) AS cheapest_hours,
        round(avg(eur / (speed * 3600) * 1e6), 6) AS eur_per_million_tokens,
        round(avg(intensity * (tdp / speed / 3600 * 1e6) / 1000), 6) AS gco2_per_million_tokens
    FROM best GROUP BY ALL""",
)
def gold_from_bronze(spark, sf_dir):
    """The Gold table at its grain of country, hour, model and accelerator, reported per country and accelerator."""
    db = _bronze(spark, sf_dir)
    read = lambda name: spark.table(f"{db}.{name}")
    factors = read("generation").filter("psr_type <> 'error'")
    factor = F.min("user_id") + F.length("event_type") * 10.0
    lowest = events(spark, sf_dir).groupBy("event_type").agg(factor.alias("gco2_kwh")).withColumnRenamed("event_type", "psr_type")
    factors = factors.select("psr_type").distinct().join(lowest, "psr_type")
    names = read("results").select("accelerator").distinct()
    tdp = names.withColumn("tdp_watts", (F.substring("accelerator", 2, 9).cast("int") + 1) * 100.0)
    carbon = stage(silver.carbon_intensity(read("generation"), factors), "silver")
    efficiency = stage(silver.mlperf_efficiency(read("results"), tdp), "silver")
    patterns = names.withColumn("pattern", F.col("accelerator"))
    pricing = stage(silver.cloud_gpu_pricing(read("prices"), read("rates"), patterns, history=True), "silver")
    regions = carbon.select(F.concat(F.lit("r"), F.substring("country", 2, 9)).alias("region"), "country").distinct()
    cost = gold.ai_inference_cost(carbon, efficiency, pricing, regions, per_instance=False)
    return cost.groupBy("country", "accelerator").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("timestamp_hour", "model_name").alias("grain"),
        F.count_if("greenest_hour_flag").alias("greenest_hours"),
        F.count_if("cheapest_hour_flag").alias("cheapest_hours"),
        rounded(F.avg("eur_per_million_tokens")).alias("eur_per_million_tokens"),
        rounded(F.avg("gco2_per_million_tokens")).alias("gco2_per_million_tokens"),
    )


@query(
    "silver1_generation_mix",
    """WITH hourly AS (SELECT date_trunc('hour', ts) AS h, 'Z' || (user_id % 5) AS country, event_type AS psr_type, avg(value) AS mw FROM events GROUP BY ALL)
    SELECT h AS timestamp_hour, country, psr_type, round(mw, 6) AS quantity_mw FROM hourly""",
)
def generation_mix(spark, sf_dir):
    """The generation mix kept in the Silver carbon table, read back from its JSON."""
    df = events(spark, sf_dir)
    factors = df.groupBy(F.col("event_type").alias("psr_type")).agg((F.min("user_id") + 10.0).alias("gco2_kwh"))
    generation = df.select(
        F.col("ts").alias("timestamp_utc"), F.concat(F.lit("Z"), (F.col("user_id") % 5).cast("string")).alias("country"),
        F.col("event_type").alias("psr_type"), F.col("value").alias("quantity_mw"),
    )
    out = silver.carbon_intensity(generation, factors, mix=True)
    entries = F.explode(F.from_json("generation_mix_json", "map<string,double>")).alias("psr_type", "quantity_mw")
    return out.select(F.col("timestamp_hour").cast("timestamp_ntz").alias("timestamp_hour"), "country", entries).withColumn(
        "quantity_mw", rounded("quantity_mw")
    )


def hourly_totals(bronze):
    """Cents and numbers of events per type and hour."""
    hour = F.date_trunc("hour", "ts")
    cents = F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents")
    return bronze.groupBy("event_type", hour.alias("hour")).agg(F.count(F.lit(1)).alias("n"), cents).withColumn("day", F.to_date("hour"))


def daily_features(hourly):
    """Per type and day: the mean, the mean of three days up to it, and how many hours lie below the day's quartile."""
    flagged = below_quartile(hourly.withColumn("mean", F.col("cents") / F.col("n")), ["event_type"], "hour", "mean", "low")
    daily = flagged.groupBy("event_type", "day").agg(
        F.sum("n").alias("n"), F.sum("cents").alias("cents"), F.count_if("low").alias("low_hours")
    )
    three = Window.partitionBy("event_type").orderBy(F.unix_date("day")).rangeBetween(-2, 0)
    moving = F.sum("cents").over(three) / F.sum("n").over(three) / 100
    return daily.select("event_type", "n", (F.col("cents") / F.col("n") / 100).alias("mean"), moving.alias("mean_of_three"), "low_hours", "day")


EVENT_STEPS = (Step("hourly", "bronze", hourly_totals), Step("daily", "hourly", daily_features, back=2))


def _two_drops(spark, sf_dir) -> str:
    """Events in two drops: the second has all that is new, and late rows of a few old days."""
    db, df = scratch_database(spark, "drops"), events(spark, sf_dir)
    bounds = df.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select(
        (F.unix_micros("a") + (F.unix_micros("b") - F.unix_micros("a")) * F.lit(0.8)).cast("long").alias("cut")
    )
    cut = bounds.first()["cut"]
    late = (F.dayofmonth("ts") == 3) & (F.pmod("event_id", F.lit(5)) == 0)
    second = (F.unix_micros("ts") > cut) | F.coalesce(late, F.lit(False))
    schema = TableSchema("events", columns(event_id="long", ts="timestamptz", user_id="long", event_type="string", value="double"))
    steps = [Step(s.table, f"{db}.events" if s.source == "bronze" else s.source, s.compute, s.back) for s in EVENT_STEPS]
    for day, rows in ((1, df.filter(~second)), (2, df.filter(second))):
        ingest(rows, "events", schema, dt.datetime(2024, 3, day, tzinfo=dt.UTC), (), db, read_once=False)
        refresh(spark, f"{db}.events", "ts", steps, db)
    return db


@query(
    "ref1_incremental_silver",
    """SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
    FROM events WHERE ts IS NOT NULL GROUP BY ALL""",
)
def incremental_silver(spark, sf_dir):
    """Hours that two refreshes have made, each from what was new."""
    hourly = spark.table(f"{_two_drops(spark, sf_dir)}.hourly")
    return hourly.select("event_type", F.col("hour").cast("timestamp_ntz").alias("hour"), "n", "cents")


@query(
    "ref2_incremental_gold",
    """WITH hourly AS (SELECT event_type, date_trunc('hour', ts) AS hour, CAST(ts AS DATE) AS day, count(*) AS n, sum(CAST(round(value * 100) AS BIGINT)) AS cents
        FROM events WHERE ts IS NOT NULL GROUP BY ALL),
    flagged AS (SELECT *, cents / n < quantile_cont(cents / n, 0.25) OVER (PARTITION BY event_type, day) AS low FROM hourly),
    daily AS (SELECT event_type, day, CAST(sum(n) AS BIGINT) AS n, sum(cents) AS cents, count(*) FILTER (low) AS low_hours FROM flagged GROUP BY ALL)
    SELECT event_type, day, n, round(CAST(cents AS DOUBLE) / n / 100, 6) AS mean, low_hours,
        round(CAST(sum(cents) OVER three AS DOUBLE) / CAST(sum(n) OVER three AS DOUBLE) / 100, 6) AS mean_of_three
    FROM daily WINDOW three AS (PARTITION BY event_type ORDER BY day RANGE BETWEEN INTERVAL 2 DAY PRECEDING AND CURRENT ROW)""",
)
def incremental_gold(spark, sf_dir):
    """Days that two refreshes have made; the late rows of the second also change the two days after theirs."""
    daily = spark.table(f"{_two_drops(spark, sf_dir)}.daily")
    return daily.select("event_type", "day", "n", rounded("mean").alias("mean"), rounded("mean_of_three").alias("mean_of_three"), "low_hours")
