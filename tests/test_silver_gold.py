"""Joins, aggregates, series and the domain tables on small cases with known results."""

import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tarn.functions import fixed_values, formulas
from tarn.operators import aggregates as agg
from tarn.operators import joins, lineage, series
from tarn.plans import gold, silver

UTC = dt.UTC
DAY = dt.date(2024, 3, 1)  # a Friday


def at(hour, minute=0, day=1):
    return dt.datetime(2024, 3, day, hour, minute, tzinfo=UTC)


def tdp(spark):
    return spark.createDataFrame(list(fixed_values.ACCELERATOR_TDP_WATTS.items()), "accelerator string, tdp_watts double")


RESULTS = "round_id string, model_name string, accelerator string, submitter string, scenario string, tokens_per_sec double"


def test_efficiency(spark):
    data = [
        ("v4.0", "llama", "NVIDIA H100 SXM5 80GB", "a", "Offline", 1000.0),
        ("v4.0", "llama", "NVIDIA H100 SXM5 80GB", "b", "Offline", 900.0),
        ("v4.0", "llama", "NVIDIA H100 SXM5 80GB", "b", "Server", 5000.0),
        ("v4.0", "llama", "TPU v4", "c", "Offline", 10.0),
        ("v4.0", "gpt", "nvidia  t4 ", "c", "Offline", -1.0),
        ("v4.0", "bert", " nvidia  T4", "c", "Offline", 7.0),
    ]
    out = silver.mlperf_efficiency(spark.createDataFrame(data, RESULTS), tdp(spark))
    got = {(r["model_name"], r["accelerator"]): r for r in out.collect()}
    assert len(got) == 3
    h100 = got["llama", "NVIDIA H100 SXM5 80GB"]
    assert (h100["tokens_per_sec"], h100["tdp_watts"]) == (1000.0, 700.0)
    assert h100["wh_per_million_tokens"] == pytest.approx(194.4444444)
    assert got["llama", "TPU v4"]["tdp_watts"] is None and got["llama", "TPU v4"]["wh_per_million_tokens"] is None
    assert got["bert", " nvidia  T4"]["tdp_watts"] == 70.0


def test_efficiency_of_nothing(spark):
    out = silver.mlperf_efficiency(spark.createDataFrame([], RESULTS), tdp(spark))
    assert out.columns[-2:] == ["tdp_watts", "wh_per_million_tokens"] and out.isEmpty()


PRICES = "provider string, instance_type string, region string, price_usd_per_hour double, sku_name string, captured_at timestamp"


def accelerators(spark):
    pairs = [*fixed_values.INSTANCE_ACCELERATORS.items(), ("NC24", "wrong: shorter")]
    return spark.createDataFrame(pairs, "pattern string, accelerator string")


def prices(spark):
    return spark.createDataFrame(
        [
            ("azure", "Standard_NC24ads_A100_v4", "west", 9.9, "s", at(1)),
            ("azure", "Standard_NC24ads_A100_v4", "west", 2.2, "s", at(5, day=3)),
            ("azure", "Standard_D2", "west", 1.1, "s", at(5, day=1)),
            ("azure", "Standard_D2", "east", 1.1, "s", dt.datetime(2023, 1, 1, tzinfo=UTC)),
        ],
        PRICES,
    )


def test_pricing(spark):
    fx = spark.createDataFrame([(DAY, 1.1)], "observation_date date, eur_usd double")
    out = silver.cloud_gpu_pricing(prices(spark), fx, accelerators(spark))
    got = {(r["instance_type"], r["region"]): r for r in out.collect()}
    a100 = got["Standard_NC24ads_A100_v4", "west"]
    assert a100["accelerator"] == "NVIDIA A100 PCIe 80GB"
    assert a100["price_eur_per_hour"] == pytest.approx(2.0)  # Friday's rate on Sunday
    assert a100["valid_from"] == dt.date(2024, 3, 3)
    assert got["Standard_D2", "west"]["accelerator"] is None
    assert got["Standard_D2", "west"]["price_eur_per_hour"] == pytest.approx(1.0)
    assert got["Standard_D2", "east"]["price_eur_per_hour"] is None  # before the first rate


def test_pricing_without_rates(spark):
    fx = spark.createDataFrame([], "observation_date date, eur_usd double")
    for rates in (fx, None):
        out = silver.cloud_gpu_pricing(prices(spark), rates, accelerators(spark))
        assert {r["price_eur_per_hour"] for r in out.collect()} == {2.2, 1.1}
    assert silver.cloud_gpu_pricing(spark.createDataFrame([], PRICES), None, accelerators(spark)).isEmpty()


def test_carbon_intensity(spark):
    data = [
        (at(0, 0), "ES", "B16", 50.0), (at(0, 15), "ES", "B16", 150.0), (at(0), "ES", "B04", 300.0),
        (at(0), "ES", "B19", None), (at(0), "ES", "B20", 777.0), (at(1), "ES", "B16", 0.0),
    ]
    generation = spark.createDataFrame(data, "timestamp_utc timestamp, country string, psr_type string, quantity_mw double")
    factors = spark.createDataFrame([("B16", 10.0), ("B04", 50.0), ("B19", 1.0)], "psr_type string, gco2_kwh double")
    out = silver.carbon_intensity(generation, factors)
    got = {r["h"]: r["carbon_intensity_gco2_kwh"] for r in out.withColumn("h", F.hour("timestamp_hour")).collect()}
    assert got == {0: pytest.approx(40.0), 1: None}


def test_formulas(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("v")).first()["v"]
    assert value(formulas.price_eur_per_hour(F.lit(2.2), F.lit(1.1))) == pytest.approx(2.0)
    assert value(formulas.price_eur_per_hour(F.lit(2.2), F.lit(0.0))) is None
    assert value(formulas.wh_per_million_tokens(F.lit(700.0), F.lit(1000.0))) == pytest.approx(194.4444444)
    assert value(formulas.eur_per_million_tokens(F.lit(3.6), formulas.tokens_per_hour(F.lit(10.0)))) == pytest.approx(100.0)
    assert value(formulas.gco2_per_million_tokens(F.lit(100.0), F.lit(50.0))) == pytest.approx(5.0)


def test_quartile_flag(spark):
    data = [("ES", at(h), v) for h, v in enumerate([1.0, 2.0, 3.0, 4.0])] + [("FR", at(h), 5.0) for h in range(4)]
    df = spark.createDataFrame(data, "country string, ts timestamp, v double")
    out = series.below_quartile(df, ["country"], "ts", "v", "flag").filter("flag")
    assert rows(out, "country", "v") == [("ES", 1.0)]


def test_forward_fill(spark):
    data = [("a", DAY, 1.1), ("a", DAY + dt.timedelta(3), 1.2), ("b", DAY, None), ("b", DAY + dt.timedelta(1), 2.0)]
    df = spark.createDataFrame(data, "k string, d date, v double")
    out = series.fill_calendar(df, ["k"], "d", ["v"])
    assert [r["v"] for r in out.filter("k = 'a'").orderBy("d").collect()] == [1.1, 1.1, 1.1, 1.2]
    assert [r["v"] for r in out.filter("k = 'b'").orderBy("d").collect()] == [None, 2.0]


def weekdays(start, n):
    days, d = [], start
    while len(days) < n:
        if d.weekday() < 5:
            days.append(d)
        d += dt.timedelta(1)
    return days


def study(spark, event_day, closes):
    """An event on ``event_day`` against closes on consecutive weekdays from 2024-02-26 (Monday)."""
    days = weekdays(dt.date(2024, 2, 26), len(closes))
    market = spark.createDataFrame([("DAX", d, float(c)) for d, c in zip(days, closes, strict=True)], "symbol string, observation_date date, close double")
    rates = spark.createDataFrame(
        [("MRO", event_day - dt.timedelta(1), 4.0), ("MRO", event_day, 4.25)], "series string, observation_date date, rate_pct double"
    )
    return gold.event_features(rates, market).collect()


def test_event_study(spark):
    closes = [100, 101, 102, 103, 104, 105, 106]
    # the event is on Tuesday, the base Monday, then five trading days
    (row,) = study(spark, dt.date(2024, 2, 27), closes)
    assert row["pre_close"] == 100 and row["rate_change_bps"] == pytest.approx(25)
    assert row["return_1d"] == pytest.approx(0.02) and row["return_5d"] == pytest.approx(0.06)
    assert row["is_rate_hike"] and not row["is_rate_cut"] and row["volatility_pre_5d"] is None
    assert study(spark, dt.date(2024, 2, 27), closes[:-1]) == []


def test_event_on_a_weekend(spark):
    (row,) = study(spark, dt.date(2024, 3, 2), [10, 10, 10, 10, 20, 30, 1, 1, 1, 40])
    assert row["pre_close"] == 20
    assert row["return_1d"] == pytest.approx(0.5) and row["return_5d"] == pytest.approx(1.0)


def test_event_volatility(spark):
    closes = [100, 110, 121, 121, 133.1, 133.1, 1, 1, 1, 1, 1, 1]
    (row,) = study(spark, weekdays(dt.date(2024, 2, 26), 7)[6], closes)
    import statistics

    returns = [closes[i] / closes[i - 1] - 1 for i in range(1, 6)]
    assert row["volatility_pre_5d"] == pytest.approx(statistics.stdev(returns))


def test_policy_rates_and_market_days(spark):
    bronze = spark.createDataFrame(
        [("MRO", DAY, 4.0, at(1)), ("MRO", DAY, 4.1, at(2)), ("MRO", DAY + dt.timedelta(2), 4.35, at(2)), ("DFR", DAY, 1.0, at(1))],
        "series string, observation_date date, rate_pct double, _ingestion_timestamp timestamp",
    )
    out = silver.policy_rates(bronze, ["MRO"]).orderBy("observation_date").collect()
    assert [r["rate_pct"] for r in out] == [4.1, 4.1, 4.35]
    assert [r["rate_change_bps"] for r in out] == [None, 0.0, pytest.approx(25.0)]
    market = spark.createDataFrame(
        [("DAX", DAY, 100.0, at(1)), ("DAX", DAY + dt.timedelta(1), 1.0, at(1)), ("DAX", DAY + dt.timedelta(3), 110.0, at(1))],
        "symbol string, observation_date date, close double, _ingestion_timestamp timestamp",
    )
    days = silver.market_days(market).orderBy("observation_date").collect()
    assert [r["daily_return"] for r in days] == [None, pytest.approx(0.1)]


def test_inference_cost(spark):
    carbon = spark.createDataFrame([("ES", at(h, day=d), float(10 + h)) for d in (1, 2) for h in range(4)], "country string, timestamp_hour timestamp, carbon_intensity_gco2_kwh double")
    efficiency = spark.createDataFrame([("m", "A100", 10.0, 360.0, 10_000.0)], "model_name string, accelerator string, tokens_per_sec double, tdp_watts double, wh_per_million_tokens double")
    pricing = spark.createDataFrame([("az", "NC", "west", "A100", 3.6, DAY)], "provider string, instance_type string, region string, accelerator string, price_eur_per_hour double, valid_from date")
    regions = spark.createDataFrame([("west", "ES")], "region string, country string")
    out = gold.ai_inference_cost(carbon, efficiency, pricing, regions)
    assert out.count() == 8
    first = out.orderBy("timestamp_hour").first()
    assert first["eur_per_million_tokens"] == pytest.approx(100.0)
    assert first["gco2_per_million_tokens"] == pytest.approx(100.0)
    assert first["greenest_hour_flag"] and out.filter("greenest_hour_flag").count() == 2
    assert out.filter("cheapest_hour_flag").isEmpty()
    assert gold.country_comparison(out).first()["n"] == 8


def test_rounds_are_ordered_by_number(spark):
    df = spark.createDataFrame([("m", "v10.0", 3.0), ("m", "v4.0", 1.0), ("m", "v4.1", 2.0)], "k string, r string, v double")
    out = series.trend(df, ["k"], "r", "v")
    assert rows(out, "r", "v_previous") == [("v10.0", 2.0), ("v4.0", None), ("v4.1", 1.0)]


def test_calendar_gaps(spark):
    days = [dt.date(2024, 3, 1), dt.date(2024, 3, 4), dt.date(2024, 3, 12)]
    df = spark.createDataFrame([("a", d) for d in days], "k string, d date")
    assert rows(series.calendar_gaps(df, ["k"], "d", 0), "day", "business_days") == [(days[2], 6), (days[1], 1)]
    assert rows(series.calendar_gaps(df, ["k"], "d", 5), "day") == [(days[2],)]


def test_event_offsets(spark):
    closes = spark.createDataFrame([("s", d, i) for i, d in enumerate(weekdays(DAY, 10))], "k string, d date, c int")
    events = spark.createDataFrame([("s", dt.date(2024, 3, 3)), ("t", DAY)], "k string, e date")
    out = joins.join_event_offsets(events, closes, ["k"], "e", "d", "c", -1, 2)
    assert rows(out, "offset", "c") == [(0, 0), (1, 1), (2, 2)]


def test_latest_row_and_ties(spark):
    df = spark.createDataFrame([(1, at(1), "a"), (1, at(2), "b"), (1, at(2), "c"), (2, at(0), "d")], "k int, t timestamp, v string")
    assert rows(agg.latest_per_key(df, ["k"], "t", ["v"]), "k", "v") == [(1, "c"), (2, "d")]


def test_mix_json(spark):
    df = spark.createDataFrame([("h", "B16", 1.0), ("h", "B04", 2.0), ("h", "B16", 0.5)], "k string, c string, v double")
    assert agg.mix_json(df, ["k"], "c", "v", "j").first()["j"] == '{"B04":2.0,"B16":1.5}'


def test_fingerprint_ignores_order_and_sees_changes(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "a int, b string")
    same = rows(agg.table_fingerprint(df))
    assert rows(agg.table_fingerprint(df.orderBy(F.desc("a")).select("b", "a"))) == same
    assert rows(agg.table_fingerprint(df.distinct())) != same
    assert rows(agg.table_fingerprint(df.withColumn("b", F.coalesce("b", F.lit("y"))))) != same


def test_chain_ends_on_cycles(spark):
    edges = spark.createDataFrame([("gold", "silver"), ("silver", "bronze"), ("a", "b"), ("b", "a"), ("gold", "bronze")], "c string, p string")
    chain = lineage.upstream_chain(edges, "c", "p")
    assert rows(chain) == [
        ("a", "a", 2), ("a", "b", 1), ("b", "a", 1), ("b", "b", 2),
        ("gold", "bronze", 1), ("gold", "silver", 1), ("silver", "bronze", 1),
    ]
    sources = lineage.original_sources(chain, edges, "c")
    assert rows(sources, "dataset", "upstream") == [("gold", "bronze"), ("silver", "bronze")]


def test_training_audit(spark):
    full = ("1", "2", "3", "4", "5")
    df = spark.createDataFrame([full, ("1", " ", "3", "4", "5"), ("1", "2", "3", "4", None)], ", ".join(f"{c} string" for c in lineage.TRAINING_FIELDS))
    good, bad = lineage.audit_training(df)
    assert rows(good) == [full]
    assert rows(bad, "rejection_reason") == [("missing:data_contract_hash",), ("missing:run_id",)]


def test_longest_pattern_prefers_length_then_order(spark):
    facts = spark.createDataFrame([("p4d.24xlarge",), ("p4",), ("zz",), (None,)], "name string")
    patterns = spark.createDataFrame([("p4", "short"), ("p4d", "long"), ("4d.", "tie loses")], "p string, v string")
    out = joins.lookup_pattern(facts, patterns, "name", "p", "v", "acc")
    assert rows(out, "name", "acc") == sorted([("p4d.24xlarge", "tie loses"), ("p4", "short"), ("zz", None), (None, None)], key=repr)
