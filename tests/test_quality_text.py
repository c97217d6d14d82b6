"""Checks, text, vectors and labels on small cases."""

import datetime as dt

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from tarn.operators import learning, quality, text, vectors
from tarn.session import scratch_database, scratch_path

UTC = dt.UTC


def test_min_rows(spark):
    assert rows(quality.min_rows(spark.range(3), 4)) == [(3,)]
    assert quality.min_rows(spark.range(3), 3).isEmpty()


def test_completeness(spark):
    df = spark.createDataFrame([(1,), (None,), (3,), (4,)], "v int")
    assert rows(quality.completeness(df, "v", 0.9)) == [(4, 3, 0.75)]
    assert quality.completeness(df, "v", 0.75).isEmpty()
    empty = spark.createDataFrame([], "v int")
    assert rows(quality.completeness(empty, "v")) == [(0, 0, None)]


def test_unique_and_accepted(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "v string")
    assert rows(quality.unique(df, "v")) == [("a", 2)]
    assert rows(quality.accepted_values(df, "v", ["a"])) == [("b", 1)]
    assert quality.not_null(df, "v").count() == 2


@pytest.mark.parametrize("lag,stale", [(29, False), (30, True)])
def test_freshness_limit(spark, lag, stale):
    as_of = dt.date(2024, 5, 31)
    db = scratch_database(spark, "bronze")
    stamp = dt.datetime.combine(as_of - dt.timedelta(lag), dt.time(23, 59), UTC)
    spark.createDataFrame([(stamp,)], "_ingestion_timestamp timestamp").write.saveAsTable(f"{db}.t")
    spark.createDataFrame([], "_ingestion_timestamp timestamp").write.saveAsTable(f"{db}.empty")
    fresh = quality.freshness(spark, {"t": f"{db}.t", "empty": f"{db}.empty", "gone": f"{db}.gone"}, as_of)
    want = [("empty", None, True), ("gone", None, True), ("t", lag, stale)]
    assert rows(fresh, "source", "lag_days", "is_stale") == want
    assert quality.stale_sources(fresh).count() == (3 if stale else 2)


def test_suite_warns_without_failing(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    warned = quality.suite({"t": (df, [quality.rows_check(2), quality.completeness_check("v", severity="warn")])})
    assert rows(warned, "check_name", "status") == [("completeness:v", "warn"), ("min_rows", "pass")]
    assert quality.run_passes(warned)
    failed = quality.suite({"t": (df.limit(0), [quality.completeness_check("v")])})
    assert rows(failed, "status", "observed") == [("fail", None)] and not quality.run_passes(failed)


NOTE = "mail a@b.com and grid@ops.org, ip 10.0.0.1 tel +34 600 123 456 iban DE89 3704 0044 0532 0130 00 card 4111-1111-1111-1111"


def test_entities(spark):
    df = spark.createDataFrame([(1, NOTE), (2, "nothing here"), (3, None)], "id int, t string")
    want = [(1, "CREDIT_CARD", 1), (1, "EMAIL_ADDRESS", 2), (1, "IBAN_CODE", 1), (1, "IP_ADDRESS", 1), (1, "PHONE_NUMBER", 1)]
    assert rows(text.detect_entities(df, ["id"], "t")) == want
    allowed = dict((r[1], r[2]) for r in rows(text.detect_entities(df, ["id"], "t", ["grid@ops.org"])))
    assert allowed["EMAIL_ADDRESS"] == 1


def test_anonymise(spark):
    df = spark.createDataFrame([(NOTE,)], "t string")
    clean = df.select(text.anonymise(F.col("t"), ["grid@ops.org"]).alias("c")).first()["c"]
    assert clean == (
        "mail <EMAIL_ADDRESS> and grid@ops.org, ip <IP_ADDRESS> tel <PHONE_NUMBER> iban <IBAN_CODE> card <CREDIT_CARD>"
    )


@pytest.mark.parametrize("length", [0, 1, 49, 50, 51, 90, 91, 500])
def test_chunks_cover_the_text(spark, length):
    body = "".join(chr(97 + i % 26) for i in range(length))
    df = spark.createDataFrame([(1, body)], "id int, t string")
    parts = text.chunk(df, ["id"], "t", 50, 10).orderBy("chunk_no").collect()
    assert "".join(p["chunk"][10 if i else 0:] for i, p in enumerate(parts)) == body
    assert all(p["chunk"] == body[p["start"]:p["end"]] and len(p["chunk"]) <= 50 for p in parts)
    assert len(parts) == (0 if length == 0 else 1 + max(0, -(-(length - 50) // 40)))


@pytest.fixture(scope="module")
def points(spark):
    generator = np.random.default_rng(5)
    matrix = generator.normal(size=(300, 8))
    matrix[7] = 0.0
    matrix[11] = matrix[10]
    data = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return matrix, spark.createDataFrame(data, "vec_id long, vector array<double>").repartition(6).cache()


def brute_force(matrix, queries, k, metric):
    out = []
    for q in queries:
        if metric == "l2":
            s = -np.sqrt(((matrix - matrix[q]) ** 2).sum(axis=1))
        else:
            s = matrix @ matrix[q]
            if metric == "cosine":
                with np.errstate(invalid="ignore"):
                    s = s / (np.linalg.norm(matrix, axis=1) * np.linalg.norm(matrix[q]))
                s = np.where(np.isnan(s), -np.inf, s)
        order = sorted(range(len(matrix)), key=lambda i: (-round(s[i], 9), i))[:k]
        out += [(q, i) for i in order]
    return sorted(out)


@pytest.mark.parametrize("metric", vectors.METRICS)
@pytest.mark.parametrize("per_round", [10_000, 4])
def test_top_k_equals_brute_force(points, metric, per_round):
    matrix, corpus = points
    wanted = list(range(20, 30))
    queries = corpus.filter(F.col("vec_id").between(20, 29)).withColumnRenamed("vec_id", "query_id")
    got = vectors.top_k(queries, corpus, 5, metric, per_round).select("query_id", "vec_id")
    assert sorted((r[0], r[1]) for r in got.collect()) == brute_force(matrix, wanted, 5, metric)


def test_unknown_metric(points):
    with pytest.raises(ValueError):
        vectors.top_k(points[1], points[1], 1, "hamming")


def test_cells_are_exact_with_all_probes_and_near_with_few(spark, points):
    matrix, corpus = points
    kept = corpus.filter("vec_id <> 7")
    path = scratch_path(spark, "cells")
    centres = vectors.build_cells(kept, path, 6)
    queries = kept.filter(F.col("vec_id").between(20, 29)).withColumnRenamed("vec_id", "query_id")
    exact = rows(vectors.top_k(queries, kept, 5), "query_id", "vec_id")
    assert rows(vectors.top_k_in_cells(queries, path, centres, 5, probes=6), "query_id", "vec_id") == exact
    few = set(rows(vectors.top_k_in_cells(queries, path, centres, 5, probes=3), "query_id", "vec_id"))
    assert len(few & set(exact)) / len(exact) > 0.6


def test_labels(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 50.0)], "id int, z double")
    out = learning.label_events(df, "id", [("r1", "spike", F.col("z") > 3), ("r2", "extreme", F.col("z") > 30)])
    assert rows(out) == [(1, "r1", "spike"), (3, "r1", "spike"), (3, "r2", "extreme")]
