"""Inputs that once gave wrong rows or no end."""

import datetime as dt
import math

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tarn.functions import skew
from tarn.operators import lineage, text, validate, vectors
from tarn.operators.scans import exact_quantiles
from tarn.operators.series import below_quartile
from tarn.plans import gold, silver
from tarn.session import scratch_database
from tarn.sources import files
from tarn.sources.schemas import TableSchema, columns
from tarn.sources.sinks import append_table, upsert_table, with_lineage


def test_quantiles_end_on_infinities(spark):
    values = [float(i) for i in range(30)] + [math.inf, -math.inf, 1.7e308, -1.7e308]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_quantiles(df, [], "v", {"low": 0.0, "mid": 0.5}, most=3).first()
    assert (got["low"] == -math.inf or math.isnan(got["low"])) and got["mid"] == 14.5


def test_allowed_terms_are_whole_matches(spark):
    df = spark.createDataFrame([("10.0.0.1 10.0.0.100 bob@x.com bob@x.com.au\x01\x02",)], "t string")
    masked = text._tagged(df["t"], "IP_ADDRESS", text.ENTITIES["IP_ADDRESS"], ["10.0.0.1"])
    masked = df.select(masked.alias("t"))
    assert masked.first()[0] == "10.0.0.1 <IP_ADDRESS> bob@x.com bob@x.com.au\x01\x02"
    mail = text._tagged(masked["t"], "EMAIL_ADDRESS", text.ENTITIES["EMAIL_ADDRESS"], ["bob@x.com"])
    assert masked.select(mail).first()[0] == "10.0.0.1 <IP_ADDRESS> bob@x.com <EMAIL_ADDRESS>\x01\x02"


def test_append_refuses_bad_values(spark):
    schema = TableSchema("probe_strict", columns(n="long"))
    append_table(spark.createDataFrame([("1",)], "n string"), "probes", "probe_strict", schema)
    with pytest.raises(Exception, match="no bigint"):
        append_table(spark.createDataFrame([("abc",)], "n string"), "probes", "probe_strict", schema)
    assert rows(spark.table("probes.probe_strict"), "n") == [(1,)]


def test_rejects_are_whole(spark):
    bad = spark.createDataFrame([("reason", "x" * 2000)], "rejection_reason string, body string")
    assert "x" * 2000 in validate.rejected_payload(bad).first()["payload"]


def test_csv_columns_go_by_name(spark, folder):
    for name, content in (("a", "id,name\n1,Alice\n"), ("b [1]", "name,id\nBob,2\n"), ("c", ""), ("d", "id,name\nx,7\n")):
        with open(f"{folder}/{name}.csv", "w") as file:
            file.write(content)
    assert rows(files.read_directory(spark, folder, "[ab]*"), "id", "name") == [(1, "Alice"), (2, "Bob")]
    everything = files.read_directory(spark, folder, "*.csv")
    assert rows(everything, "id", "name") == [("1", "Alice"), ("2", "Bob"), ("x", "7")]


def test_each_object_is_read_once(spark, folder):
    for name in ("x-1", "x-2.CSV", "x-3.csv"):
        with open(f"{folder}/{name}", "w") as file:
            file.write(f"id\n{name[2]}\n")
    assert rows(files.read_prefix(spark, folder, "x", "*.csv"), "id") == [(1,), (2,), (3,)]
    # the key's suffix counts before the glob, which is for Parquet here
    assert rows(files.read_prefix(spark, folder, "x-3"), "id") == [(3,)]


def test_upsert_of_moved_and_null_keys(spark):
    db = scratch_database(spark, "moved")
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "n", 3)], "k int, v string, p int")
    upsert_table(old, db, "t", ["k"], "p")
    upsert_table(spark.createDataFrame([(1, "A", 2), (None, "N", 3)], "k int, v string, p int"), db, "t", ["k"], "p")
    assert rows(spark.table(f"{db}.t"), "k", "v", "p") == sorted([(1, "A", 2), (2, "b", 1), (None, "N", 3)], key=repr)
    # partition 1 is left without rows
    upsert_table(spark.createDataFrame([(2, "B", 2), (5, "e", None)], "k int, v string, p int"), db, "t", ["k"], "p")
    upsert_table(spark.createDataFrame([(5, "E", None)], "k int, v string, p int"), db, "t", ["k"], "p")
    want = [(1, "A", 2), (2, "B", 2), (None, "N", 3), (5, "E", None)]
    assert rows(spark.table(f"{db}.t"), "k", "v", "p") == sorted(want, key=repr)


def test_two_rates_of_a_day_give_one_price(spark):
    prices = spark.createDataFrame(
        [("aws", "p5", "eu", "sku", 2.2, "2024-05-01 10:00:00")],
        "provider string, instance_type string, region string, sku_name string, price_usd_per_hour double, captured_at string",
    ).withColumn("captured_at", F.to_timestamp("captured_at"))
    rates = spark.createDataFrame(
        [("2024-05-01", 1.2, "2024-05-02"), ("2024-05-01", 1.1, "2024-05-03")], "d string, eur_usd double, t string"
    ).select(F.to_date("d").alias("observation_date"), "eur_usd", F.to_timestamp("t").alias("_ingestion_timestamp"))
    named = spark.createDataFrame([("p5", "H100")], "pattern string, accelerator string")
    out = silver.cloud_gpu_pricing(prices, rates, named).collect()
    assert [round(r["price_eur_per_hour"], 6) for r in out] == [2.0]


def test_vectors_that_are_missing(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0])], "vec_id long, vector array<double>")
    asked = spark.createDataFrame(
        [(7, [1.0, 0.1]), (7, [1.0, 0.1]), (8, None)] + [(9, [float(i), 1.0]) for i in range(8)], "query_id long, vector array<double>"
    )
    assert rows(vectors.top_k(asked.filter("query_id < 9"), corpus, 3), "query_id", "vec_id", "rank") == [(7, 1, 1), (7, 3, 2)]
    assert vectors.top_k(asked.filter("query_id = 8"), corpus, 3).isEmpty()
    assert vectors.top_k(asked.limit(0), corpus, 3).isEmpty()
    # one id with more vectors than a round takes
    best = vectors.top_k(asked.filter("query_id = 9"), corpus, 1, per_round=3)
    assert rows(best, "query_id", "vec_id", "score") == [(9, 3, 1.0)]


def test_rules_on_names_with_dots(spark):
    raw = spark.createDataFrame([("1", None), ("x", "b")], "`a.b` string, `c.d` string")
    tagged = validate.tag(raw, [validate.castable("a.b", "long"), validate.required("c.d")])
    assert rows(tagged, validate.REASON) == [("missing:c.d",), ("type:a.b",)]
    assert '"a.b":"x"' in validate.rejected_payload(tagged.filter("rejection_reason like 'type%'")).first()["payload"]


def test_deep_lineage(spark):
    edges = spark.createDataFrame([(f"d{i}", f"d{i + 1}") for i in range(55)], "c string, p string")
    chain = lineage.upstream_chain(edges, "c", "p")
    assert chain.filter("dataset = 'd0'").agg({"depth": "max"}).first()[0] == 55


def test_a_batch_is_stored_once(spark):
    db, stamp = scratch_database(spark, "again"), dt.datetime(2024, 5, 1, tzinfo=dt.UTC)
    schema = TableSchema("t", columns(n="long"))
    raw = spark.createDataFrame([("1",), ("2",), ("x",)], "n string")
    # the run before stored the valid rows and failed before the rejects
    good = with_lineage(raw.filter("n != 'x'"), "t", stamp)
    append_table(good, db, "t", schema.bronze())
    for _ in range(2):
        assert validate.ingest(raw, "t", schema, stamp, namespace=db) == {"valid": 2, "rejected": 1}
    assert rows(spark.table(f"{db}.t"), "n") == [(1,), (2,)] and spark.table(f"{db}.rejected_records").count() == 1
    # another batch is another delivery
    validate.ingest(raw, "t", schema, stamp + dt.timedelta(hours=1), namespace=db)
    assert spark.table(f"{db}.t").count() == 4 and spark.table(f"{db}.rejected_records").count() == 2


def test_undeclared_columns_are_added(spark):
    db, stamp = scratch_database(spark, "undeclared"), dt.datetime(2024, 5, 1, tzinfo=dt.UTC)
    validate.ingest(spark.createDataFrame([(1, [2])], "a long, `b.c` array<int>"), "t", None, stamp, namespace=db)
    more = spark.createDataFrame([("x", 3)], "d string, a long")
    validate.ingest(more, "t", None, stamp + dt.timedelta(days=1), namespace=db)
    assert rows(spark.table(f"{db}.t"), "a", "`b.c`", "d") == [(1, "[2]", None), (3, None, "x")]


def test_hot_keys_by_rows(spark, monkeypatch):
    df = spark.createDataFrame([(i % 1000,) for i in range(3000)] + [(5,)] * 8, "k int")
    assert rows(skew.hot_keys(df, ["k"], share=0.5)) == []
    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    assert rows(skew.hot_keys(df, ["k"], share=0.5)) == [(5,)]


def test_an_event_study_of_chosen_pairs(spark):
    days = [dt.date(2024, 3, 4) + dt.timedelta(d + 2 * (d // 5)) for d in range(10)]
    market = spark.createDataFrame([(s, d, 10.0 + i) for s in "xy" for i, d in enumerate(days)], "symbol string, observation_date date, close double")
    rates = spark.createDataFrame([(s, d, r) for s in "ab" for d, r in ((days[0], 1.0), (days[1], 2.0))], "series string, observation_date date, rate_pct double")
    assert gold.event_features(rates, market).count() == 4
    pairs = spark.createDataFrame([("a", "y"), ("a", "y")], "series string, symbol string")
    assert rows(gold.event_features(rates, market, pairs), "series", "symbol", "pre_close") == [("a", "y", 10.0)]


@pytest.mark.parametrize("per_instance", [True, False])
def test_cheap_hours_equal_a_window_over_the_rows(spark, per_instance):
    day = dt.datetime(2024, 5, 1)
    hours = [("ES", day + dt.timedelta(hours=h), float(h % 3)) for h in range(30)] + [("FR", day + dt.timedelta(hours=h), 1.0) for h in range(5)]
    carbon = spark.createDataFrame(hours, "country string, timestamp_hour timestamp, carbon_intensity_gco2_kwh double")
    efficiency = spark.createDataFrame(
        [("m1", "A", 1.0, 9.0, 9.0), ("m2", "A", 2.0, 9.0, 9.0), ("m1", "B", 3.0, 9.0, 9.0)],
        "model_name string, accelerator string, tokens_per_sec double, tdp_watts double, wh_per_million_tokens double",
    )
    quotes = [("p", "i", "r1", "A", 3.0), ("p", "i", "r2", "A", 2.0), ("q", "i", "r1", "A", 1.0), ("q", "j", "r2", "B", None), ("p", "i", "r3", "A", 9.0)]
    pricing = spark.createDataFrame(
        [(*q, day.date()) for q in quotes],
        "provider string, instance_type string, region string, accelerator string, price_eur_per_hour double, valid_from date",
    )
    regions = spark.createDataFrame([("r1", "ES"), ("r2", "FR"), ("r3", "ES")], "region string, country string")
    cost = gold.ai_inference_cost(carbon, efficiency, pricing, regions, per_instance=per_instance)
    if per_instance:
        again = below_quartile(cost, ["provider", "instance_type"], "timestamp_hour", "price_eur_per_hour", "want")
        assert again.filter("not (want <=> cheapest_hour_flag)").isEmpty() and again.filter("want").count() == 10
        return
    grain = ["country", "timestamp_hour", "model_name", "accelerator"]
    assert cost.count() == cost.select(*grain).distinct().count() == 60 + 10 + 5
    assert cost.filter("country = 'ES' and price_eur_per_hour != 1.0").isEmpty()


def test_names_that_normalise_alike_count_once(spark):
    from tarn.operators.joins import lookup_name

    dim = spark.createDataFrame([("H100  SXM", None), ("h100 sxm", 700), ("H100 SXM", 650), ("a100", 400), (None, 1)], "name string, watts int")
    facts = spark.createDataFrame([(1, " h100 Sxm"), (2, "A100"), (3, "x"), (4, None)], "id int, device string")
    assert rows(lookup_name(facts, dim, "device", "name", "watts", "watts"), "id", "watts") == [(1, 650), (2, 400), (3, None), (4, None)]


@pytest.mark.parametrize("size,overlap", [(5, 0), (5, 2), (5, 4), (7, 5), (1, 0), (100, 50)])
def test_chunks_are_slices(spark, size, overlap):
    """Chunks cut from one pass over the text: line ends, signs beyond 16 bits, overlaps longer than the stride."""
    from tarn.operators.text import chunk

    texts = ["abcdefghijklmnopqrstuvwxyz", "a\nb\r\nc d", "🙂é🙃 x🙂", "abcde", "a", "", None, "x" * 203]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    want = []
    for k, t in enumerate(texts):
        n = 0
        while t:
            start = n * (size - overlap)
            want.append((k, n, start, min(start + size, len(t)), t[start : start + size]))
            if start + size >= len(t):
                break
            n += 1
    assert rows(chunk(df, ["id"], "text", size, overlap)) == sorted(want, key=repr)


def test_quarantine_is_kept_by_day(spark):
    import datetime as dt

    from tarn.operators.validate import ingest, non_negative
    from tarn.session import scratch_database
    from tarn.sources.schemas import TableSchema, columns

    db = scratch_database(spark, "days")
    raw = spark.createDataFrame([(1, -1.0), (2, 1.0)], "id long, v double")
    for day in (1, 2, 2):
        ingest(raw, "t", TableSchema("t", columns(id="long", v="double")), dt.datetime(2024, 3, day, tzinfo=dt.UTC), [non_negative("v")], db)
    shown = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {db}.rejected_records").collect()}
    assert shown == {"ingested_day=2024-03-01", "ingested_day=2024-03-02"} and spark.table(f"{db}.rejected_records").count() == 2


def test_reach_doubles(spark, monkeypatch):
    """A chain of 200 steps in at most nine rounds, and smallest distances in a graph with cycles and shortcuts."""
    import random

    rounds, kept = [], lineage.stage
    monkeypatch.setattr(lineage, "stage", lambda df, label: (rounds.append(label), kept(df, label))[1])
    chain = spark.createDataFrame([(k, k + 1) for k in range(200)], "c int, p int")
    assert rows(lineage.upstream_chain(chain, "c", "p")) == sorted([(a, b, b - a) for a in range(200) for b in range(a + 1, 201)], key=repr)
    assert len(rounds) <= 9 + 1
    pick = random.Random(9)
    edges = {(pick.randrange(30), pick.randrange(30)) for _ in range(45)}
    want = {}
    for start in range(30):
        level, depth, found = {start}, 0, {}
        while level:
            depth += 1
            level = {p for c, p in edges if c in level} - set(found)
            found.update(dict.fromkeys(level, depth))
        want.update({(start, p): d for p, d in found.items()})
    got = lineage.upstream_chain(spark.createDataFrame([*edges, (None, 1), (1, None)], "c int, p int"), "c", "p")
    assert {(r["dataset"], r["upstream"]): r["depth"] for r in got.collect()} == want
