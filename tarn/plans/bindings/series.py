"""Calendars, changes, event studies and forecast features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarn.operators import series
from tarn.operators.validate import business_days, split
from tarn.plans import gold, silver
from tarn.plans.bindings.registry import DAILY_CLOSES, daily_closes, events, lineitem, ntz, orders, query, rounded, table
from tarn.plans.bindings.validation import event_rules


@query(
    "win1_forward_fill",
    """WITH d AS (SELECT o_orderstatus AS series, CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS rate FROM orders
        WHERE isodow(o_orderdate) <= 5 GROUP BY ALL),
    spine AS (SELECT series, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM d GROUP BY series)
    SELECT s.series, s.day, d.rate FROM spine s ASOF LEFT JOIN d ON s.series = d.series AND s.day >= d.day""",
)
def forward_fill(spark, sf_dir):
    """Weekends take the rate of the Friday before."""
    daily = (
        business_days(orders(spark, sf_dir), "o_orderdate")
        .groupBy(F.col("o_orderstatus").alias("series"), F.col("o_orderdate").alias("day"))
        .agg(F.max("o_totalprice").alias("rate"))
    )
    return series.fill_calendar(daily, ["series"], "day", ["rate"])


@query(
    "win1_carry_forward_rows",
    """SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (
        PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase FROM events""",
)
def carry_forward_rows(spark, sf_dir):
    """Forward fill over raw rows: segments are filled apart and joined by a summary."""
    from tarn.operators.scans import carry_forward, time_segment

    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    df = events(spark, sf_dir).withColumn("bought", bought)
    out = carry_forward(df, ["user_id"], "ts", "bought", time_segment(df, ["user_id"], "ts")[0], "last_purchase")
    return out.select("event_id", "last_purchase")


@query(
    "win2_change_bps",
    """WITH m AS (SELECT l_returnflag AS series, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, round(avg(l_tax) * 100, 2) AS rate
        FROM lineitem GROUP BY ALL)
    SELECT series, month, rate, round((rate - lag(rate) OVER (PARTITION BY series ORDER BY month)) * 100, 4) AS rate_change_bps FROM m""",
)
def change_bps(spark, sf_dir):
    out = series.change_bps(_monthly_rate(spark, sf_dir), ["series"], "month", "rate")
    return out.withColumn("rate_change_bps", rounded("rate_change_bps", 4))


def _monthly_rate(spark, sf_dir):
    month = F.trunc("l_shipdate", "month").alias("month")
    return (
        lineitem(spark, sf_dir).groupBy(F.col("l_returnflag").alias("series"), month)
        .agg(rounded(F.avg("l_tax") * 100, 2).alias("rate"))
    )


@query(
    "win3_simple_return",
    f"""WITH c AS ({DAILY_CLOSES})
    SELECT symbol, day, round(close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY day), 0) - 1, 6) AS daily_return FROM c""",
)
def simple_return(spark, sf_dir):
    out = series.simple_return(daily_closes(spark, sf_dir), ["symbol"], "day", "close")
    return out.select("symbol", "day", rounded("daily_return").alias("daily_return"))


@query(
    "win4_event_study",
    f"""WITH r AS (SELECT *, close / lag(close) OVER (PARTITION BY symbol ORDER BY day) - 1 AS r FROM ({DAILY_CLOSES})),
    c AS (SELECT symbol, day, close, row_number() OVER (PARTITION BY symbol ORDER BY day) AS n,
        CASE WHEN count(r) OVER w = 5 THEN stddev_samp(r) OVER w END AS volatility
        FROM r WINDOW w AS (PARTITION BY symbol ORDER BY day ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
    m AS (SELECT l_returnflag AS series, CAST(date_trunc('month', l_shipdate) AS DATE) AS event_date, round(avg(l_tax) * 100, 2) AS rate
        FROM lineitem GROUP BY ALL),
    d AS (SELECT *, (rate - lag(rate) OVER (PARTITION BY series ORDER BY event_date)) * 100 AS bps FROM m),
    e AS (SELECT d.*, symbol FROM d, (SELECT DISTINCT symbol FROM c) WHERE bps <> 0),
    p AS (SELECT e.*, b.close AS pre_close, b.volatility, u.n AS upto FROM e
        ASOF JOIN c b ON b.symbol = e.symbol AND e.event_date > b.day
        ASOF JOIN c u ON u.symbol = e.symbol AND e.event_date >= u.day)
    SELECT p.series, p.symbol, event_date, round(bps, 4) AS rate_change_bps, rate AS rate_level_pct, bps > 0 AS is_rate_hike,
        bps < 0 AS is_rate_cut, pre_close, round(x.close / pre_close - 1, 6) AS return_1d,
        round(y.close / pre_close - 1, 6) AS return_5d, round(p.volatility, 6) AS volatility_pre_5d
    FROM p JOIN c x ON x.symbol = p.symbol AND x.n = upto + 1 JOIN c y ON y.symbol = p.symbol AND y.n = upto + 5""",
)
def event_study(spark, sf_dir):
    """Monthly mean taxes as policy rates, daily mean prices as the market."""
    rates = _monthly_rate(spark, sf_dir).select("series", F.col("month").alias("observation_date"), F.col("rate").alias("rate_pct"))
    market = daily_closes(spark, sf_dir).withColumnRenamed("day", "observation_date")
    out = gold.event_features(rates, market)
    return out.withColumns(
        {
            "rate_change_bps": rounded("rate_change_bps", 4),
            "return_1d": rounded("return_1d"),
            "return_5d": rounded("return_5d"),
            "volatility_pre_5d": rounded("volatility_pre_5d"),
        }
    )


@query(
    "win5_below_quartile",
    """WITH h AS (SELECT event_type, date_trunc('hour', ts) AS timestamp_hour, avg(value) AS v FROM events
        WHERE event_type <> 'error' AND value <= 50 GROUP BY ALL)
    SELECT event_type, timestamp_hour, round(v, 6) AS value,
        v < quantile_cont(v, 0.25) OVER (PARTITION BY event_type, CAST(timestamp_hour AS DATE)) AS greenest_hour_flag FROM h""",
)
def below_quartile(spark, sf_dir):
    """Valid events, hourly means per type, and the hours below their day's quartile."""
    valid, _ = split(events(spark, sf_dir), event_rules())
    hourly = series.resample(valid, ["event_type"], "ts", "value")
    flagged = series.below_quartile(hourly, ["event_type"], "timestamp_hour", "value", "greenest_hour_flag")
    return flagged.select("event_type", ntz("timestamp_hour").alias("timestamp_hour"), rounded("value").alias("value"), "greenest_hour_flag")


@query(
    "win6_round_trend",
    """WITH m AS (SELECT o_orderpriority AS model_name, 'v' || (year(o_orderdate) - 1990) || '.1' AS round_id, year(o_orderdate) AS y,
        max(o_totalprice) AS score FROM orders GROUP BY ALL)
    SELECT model_name, round_id, score, lag(score) OVER w AS score_previous,
        round((score / nullif(lag(score) OVER w, 0) - 1) * 100, 6) AS score_change_pct
    FROM m WINDOW w AS (PARTITION BY model_name ORDER BY y)""",
)
def round_trend(spark, sf_dir):
    """Rounds v2.1 to v11.1: the order of numbers, not of text."""
    label = F.concat(F.lit("v"), (F.year("o_orderdate") - 1990).cast("string"), F.lit(".1"))
    best = orders(spark, sf_dir).groupBy(F.col("o_orderpriority").alias("model_name"), label.alias("round_id")).agg(
        F.max("o_totalprice").alias("score")
    )
    out = series.trend(best, ["model_name"], "round_id", "score")
    return out.withColumn("score_change_pct", rounded("score_change_pct"))


@query(
    "win7_resample_hourly",
    """SELECT user_id, date_trunc('hour', ts) AS timestamp_hour, round(avg(value), 6) AS quantity_mw FROM events GROUP BY ALL""",
)
def resample_hourly(spark, sf_dir):
    out = series.resample(events(spark, sf_dir), ["user_id"], "ts", "value", out="quantity_mw")
    return out.select("user_id", ntz("timestamp_hour").alias("timestamp_hour"), rounded("quantity_mw").alias("quantity_mw"))


def hourly_features(spark, sf_dir):
    # hourly totals in whole cents, so that rolling means do not depend on the order of sums
    cents = F.sum(F.round(F.col("value") * 100)).alias("value")
    hourly = events(spark, sf_dir).groupBy("event_type", F.date_trunc("hour", "ts").alias("timestamp_hour")).agg(cents)
    filled = series.fill_calendar(hourly, ["event_type"], "timestamp_hour", ["value"], interval="1 HOUR")
    return series.forecast_features(filled, ["event_type"], "timestamp_hour", "value")


@query(
    "win8_forecast_features",
    """WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hr, sum(round(value * 100)) AS v FROM events GROUP BY ALL),
    spine AS (SELECT event_type, unnest(generate_series(min(hr), max(hr), INTERVAL 1 HOUR)) AS hr FROM h GROUP BY event_type),
    f AS (SELECT s.event_type, s.hr, h.v FROM spine s ASOF LEFT JOIN h ON s.event_type = h.event_type AND s.hr >= h.hr)
    SELECT event_type, hr AS timestamp_hour, round(v, 6) AS value, round(lag(v, 1) OVER w, 6) AS lag_1, round(lag(v, 24) OVER w, 6) AS lag_24,
        round(avg(v) OVER (PARTITION BY event_type ORDER BY hr ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 6) AS mean_24,
        CAST(hour(hr) AS INTEGER) AS hour_of_day, CAST(dayofweek(hr) + 1 AS INTEGER) AS day_of_week, round(lead(v, 24) OVER w, 6) AS target
    FROM f WINDOW w AS (PARTITION BY event_type ORDER BY hr)""",
)
def forecast_features(spark, sf_dir):
    out = hourly_features(spark, sf_dir)
    measures = {c: rounded(c) for c in ("value", "lag_1", "lag_24", "mean_24", "target")}
    return out.withColumns({"timestamp_hour": ntz("timestamp_hour"), **measures})


@query(
    "win9_time_folds",
    """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
    s AS (SELECT day, ntile(6) OVER (ORDER BY day) AS slice FROM d),
    n AS (SELECT slice, count(*) AS n FROM events JOIN s ON CAST(ts AS DATE) = day GROUP BY slice)
    SELECT CAST(k AS INTEGER) AS fold, CAST(sum(n) FILTER (slice <= k) AS BIGINT) AS train_rows,
        CAST(sum(n) FILTER (slice = k + 1) AS BIGINT) AS test_rows
    FROM n, range(1, 6) r(k) GROUP BY k""",
)
def time_folds(spark, sf_dir):
    return series.fold_sizes(series.time_folds(events(spark, sf_dir), "ts"))


@query(
    "win10_spikes",
    """WITH w AS (SELECT event_id, value, count(value) OVER f AS n, avg(value) OVER f AS m, stddev_samp(value) OVER f AS s FROM events
        WINDOW f AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
    z AS (SELECT event_id, CASE WHEN n = 20 THEN (value - m) / nullif(s, 0) END AS zscore FROM w)
    SELECT event_id, round(zscore, 4) AS zscore, coalesce(abs(zscore) > 3, false) AS is_spike FROM z""",
)
def spikes(spark, sf_dir):
    """Five event types hold all rows; hours and blocks of them are worked on apart."""
    out = series.spikes(events(spark, sf_dir), ["event_type"], "ts", "event_id", "value")
    return out.select("event_id", rounded("zscore", 4).alias("zscore"), "is_spike")


@query(
    "win10_robust_spikes",
    """WITH m AS (SELECT event_type, median(value) AS median FROM events GROUP BY ALL),
    d AS (SELECT e.*, median, abs(value - median) AS dev FROM events e JOIN m USING (event_type)),
    a AS (SELECT event_type, median(dev) AS mad FROM d GROUP BY ALL)
    SELECT event_id, round((value - median) / nullif(mad * 1.4826, 0), 4) AS robust_z,
        coalesce(abs((value - median) / nullif(mad * 1.4826, 0)) > 3.5, false) AS is_spike FROM d JOIN a USING (event_type)""",
)
def robust_spikes(spark, sf_dir):
    out = series.robust_spikes(events(spark, sf_dir), ["event_type"], "value")
    return out.select("event_id", rounded("robust_z", 4).alias("robust_z"), "is_spike")


@query(
    "win11_calendar_gaps",
    """WITH d AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders),
    p AS (SELECT *, lag(day) OVER (PARTITION BY o_custkey ORDER BY day) AS previous_day FROM d),
    g AS (SELECT *, (day - previous_day) // 7 * 5 + (SELECT count(*) FROM range(1, 7) r(i)
        WHERE i <= (day - previous_day) % 7 AND isodow(previous_day + CAST(i AS INTEGER)) <= 5) AS business_days
        FROM p WHERE previous_day IS NOT NULL)
    SELECT o_custkey, day, previous_day, CAST(business_days AS BIGINT) AS business_days FROM g WHERE business_days > 200""",
)
def calendar_gaps(spark, sf_dir):
    return series.calendar_gaps(orders(spark, sf_dir), ["o_custkey"], "o_orderdate", 200)


@query(
    "win11_not_increasing",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, previous_day FROM (SELECT *, CAST(lag(o_orderdate) OVER (
        PARTITION BY o_orderpriority ORDER BY o_orderkey) AS DATE) AS previous_day FROM orders)
    WHERE CAST(o_orderdate AS DATE) <= previous_day""",
)
def not_increasing(spark, sf_dir):
    """Five priorities hold all rows; load order is checked block by block."""
    out = series.not_increasing(orders(spark, sf_dir), ["o_orderpriority"], "o_orderkey", "o_orderdate")
    return out.select("o_orderkey", "o_orderdate", "previous_day")


@query(
    "silver4_policy_rates",
    """WITH last AS (SELECT event_type AS series, CAST(ts AS DATE) AS observation_date, value AS rate FROM events
        WHERE event_type IN ('view', 'signup') AND isodow(ts) <= 5
        QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, value) = 1),
    spine AS (SELECT series, unnest(generate_series(min(observation_date), max(observation_date), INTERVAL 1 DAY))::DATE AS observation_date
        FROM last GROUP BY series),
    filled AS (SELECT s.series, s.observation_date, l.rate FROM spine s
        ASOF LEFT JOIN last l ON s.series = l.series AND s.observation_date >= l.observation_date)
    SELECT series, observation_date, rate AS rate_pct,
        round((rate - lag(rate) OVER (PARTITION BY series ORDER BY observation_date)) * 100, 4) AS rate_change_bps FROM filled""",
)
def policy_rates(spark, sf_dir):
    """The day's last event value as rate, published on weekdays only."""
    bronze = business_days(events(spark, sf_dir), "ts").select(
        F.col("event_type").alias("series"), F.to_date("ts").alias("observation_date"),
        F.col("value").alias("rate_pct"), F.col("ts").alias("_ingestion_timestamp"),
    )
    out = silver.policy_rates(bronze, ["view", "signup"])
    return out.withColumn("rate_change_bps", rounded("rate_change_bps", 4))


@query(
    "silver5_market_days",
    """WITH last AS (SELECT event_type AS symbol, CAST(ts AS DATE) AS observation_date, value + 1 AS close FROM events WHERE isodow(ts) <= 5
        QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC, value) = 1)
    SELECT symbol, observation_date, close,
        round(close / lag(close) OVER (PARTITION BY symbol ORDER BY observation_date) - 1, 6) AS daily_return FROM last""",
)
def market_days(spark, sf_dir):
    bronze = events(spark, sf_dir).select(
        F.col("event_type").alias("symbol"), F.to_date("ts").alias("observation_date"),
        (F.col("value") + 1).alias("close"), F.col("ts").alias("_ingestion_timestamp"),
    )
    return silver.market_days(bronze).withColumn("daily_return", rounded("daily_return"))


@query(
    "gold2_efficiency_over_time",
    """WITH b AS (SELECT 'v' || (year(l_shipdate) - 1990) || '.0' AS round_id, year(l_shipdate) AS y, p_type AS model_name, p_brand AS accelerator,
        avg(l_extendedprice / l_quantity) AS wh FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
    SELECT round_id, model_name, accelerator, round(wh, 6) AS wh_per_million_tokens, round(lag(wh) OVER w, 6) AS wh_per_million_tokens_previous,
        round((wh / nullif(lag(wh) OVER w, 0) - 1) * 100, 4) AS wh_per_million_tokens_change_pct
    FROM b WINDOW w AS (PARTITION BY model_name, accelerator ORDER BY y)""",
)
def efficiency_over_time(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("model_name"), F.col("p_brand").alias("accelerator")
    )
    label = F.concat(F.lit("v"), (F.year("l_shipdate") - 1990).cast("string"), F.lit(".0"))
    rows = lineitem(spark, sf_dir).join(part, "l_partkey").groupBy(label.alias("round_id"), "model_name", "accelerator").agg(
        F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("wh_per_million_tokens")
    )
    out = gold.efficiency_over_time(rows)
    return out.withColumns(
        {
            "wh_per_million_tokens": rounded("wh_per_million_tokens"),
            "wh_per_million_tokens_previous": rounded("wh_per_million_tokens_previous"),
            "wh_per_million_tokens_change_pct": rounded("wh_per_million_tokens_change_pct", 4),
        }
    )
