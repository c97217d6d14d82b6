"""Text, vectors, labels and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarn.operators import learning, lineage, quantised, series, text, vectors
from tarn.operators.validate import REASON
from tarn.plans.bindings.registry import events, query, rounded, table
from tarn.plans.bindings.series import hourly_features
from tarn.session import scratch_path, stage


def _replaced(column: str, types: list[str]) -> str:
    for name in types:
        pattern = text.ENTITIES[name].replace("'", "''")
        column = f"regexp_replace({column}, '{pattern}', '<{name}>', 'g')"
    return column


def _entities_sql(table_name: str, keys: str) -> str:
    names, rows = list(text.ENTITIES), []
    for i, name in enumerate(names):
        pattern = text.ENTITIES[name].replace("'", "''")
        rest = _replaced("text", names[:i])
        rows.append(
            f"SELECT {keys}, '{name}' AS entity_type, len(regexp_extract_all({rest}, '{pattern}')) AS n FROM {table_name}"
        )
    return f"SELECT * FROM ({' UNION ALL '.join(rows)}) WHERE n > 0"


@query("txt1_detect_documents", _entities_sql("documents", "doc_id"))
def detect_documents(spark, sf_dir):
    return text.detect_entities(table(spark, sf_dir, "documents"), ["doc_id"], "text")


@query("txt1_detect_conversations", _entities_sql("conversations", "conv_id, turn"))
def detect_conversations(spark, sf_dir):
    return text.detect_entities(table(spark, sf_dir, "conversations"), ["conv_id", "turn"], "text")


@query("txt2_anonymise", f"SELECT doc_id, {_replaced('text', list(text.ENTITIES))} AS clean FROM documents")
def anonymise(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.anonymise(F.col("text")).alias("clean"))


def _allowed_sql() -> str:
    """One step per entity type: the text between its matches, and each match or its tag."""
    mail = text.ENTITIES["EMAIL_ADDRESS"]
    steps = [f"""allowed AS (SELECT min(regexp_extract(text, '{mail}')) AS term FROM documents WHERE regexp_matches(text, '{mail}')),
        t0 AS (SELECT doc_id, text AS t, term FROM documents, allowed)"""]
    for i, (name, pattern) in enumerate(text.ENTITIES.items()):
        steps.append(f"""t{i + 1} AS (SELECT doc_id, term, array_to_string(list_transform(
            list_zip(string_split_regex(t, '{pattern}'), regexp_extract_all(t, '{pattern}')),
            lambda x: x[1] || CASE WHEN x[2] IS NULL THEN '' WHEN x[2] = term THEN x[2] ELSE '<{name}>' END), '') AS t FROM t{i})""")
    return f"WITH {', '.join(steps)} SELECT doc_id, t AS clean FROM t{len(text.ENTITIES)}"


@query("txt2_anonymise_allowlist", _allowed_sql())
def anonymise_allowlist(spark, sf_dir):
    """The first e-mail address in text order is allowed and stays wherever it is a whole match."""
    df = table(spark, sf_dir, "documents")
    found = F.nullif(F.regexp_extract("text", text.ENTITIES["EMAIL_ADDRESS"], 0), F.lit(""))
    term = df.agg(F.min(found).alias("t")).first()["t"]
    return df.select("doc_id", text.anonymise(F.col("text"), [term] if term else []).alias("clean"))


@query(
    "txt3_chunks",
    """WITH c AS (SELECT doc_id, text, unnest(range(0, greatest(0, CAST(ceil((length(text) - 500) / 450) AS BIGINT)) + 1)) AS n
        FROM documents WHERE length(text) > 0)
    SELECT doc_id, CAST(n AS INTEGER) AS chunk_no, CAST(n * 450 AS INTEGER) AS start,
        CAST(least(n * 450 + 500, length(text)) AS INTEGER) AS "end", substring(text, n * 450 + 1, 500) AS chunk FROM c""",
)
def chunks(spark, sf_dir):
    return text.chunk(table(spark, sf_dir, "documents"), ["doc_id"], "text")


def _corpus(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))


def _label_queries(spark, sf_dir):
    """One query per label: the mean of all its vectors."""
    means = vectors.centroids(table(spark, sf_dir, "embeddings"), "label", "embedding")
    return means.select(F.col("label").cast("long").alias("query_id"), F.col("embedding").alias("vector"))


def _nearest_sql(score: str) -> str:
    return f"""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    x AS (SELECT label, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM e),
    m AS (SELECT label, i, avg(x) AS x FROM x GROUP BY ALL),
    q AS (SELECT label, list(x ORDER BY i) AS c FROM m GROUP BY label),
    s AS (SELECT q.label AS query_id, vec_id, {score} AS score FROM q, e)
    SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, round(score, 6) AS score,
        CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM s QUALIFY rank <= 10"""


def _nearest(spark, sf_dir, metric):
    found = vectors.top_k(_label_queries(spark, sf_dir), _corpus(spark, sf_dir), 10, metric)
    return found.withColumn("score", rounded("score"))


@query("vec1_top_k_cosine", _nearest_sql("list_cosine_similarity(c, v)"))
def top_k_cosine(spark, sf_dir):
    return _nearest(spark, sf_dir, "cosine")


@query("vec1_top_k_inner_product", _nearest_sql("list_inner_product(c, v)"))
def top_k_inner_product(spark, sf_dir):
    return _nearest(spark, sf_dir, "inner_product")


@query("vec1_top_k_l2", _nearest_sql("-list_distance(c, v)"))
def top_k_l2(spark, sf_dir):
    return _nearest(spark, sf_dir, "l2")


@query(
    "vec2_recall",
    """SELECT vec_id AS query_id, CAST(least(10, (SELECT count(*) FROM embeddings WHERE embedding IS NOT NULL)) AS BIGINT) AS asked, true AS recall_reached
    FROM embeddings WHERE vec_id % 100 = 0 AND embedding IS NOT NULL""",
)
def recall(spark, sf_dir):
    """Of the exact ten neighbours of all rows whose id is divisible by 100, at least 0.9 are found by codes."""
    asked = stage(_corpus(spark, sf_dir).filter("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id"), "queries")
    index = quantised.build_codes(_corpus(spark, sf_dir), scratch_path(spark, "codes"))
    near = quantised.top_k_by_codes(asked, index, 10).select("query_id", "vec_id", F.lit(1).alias("_hit"))
    exact = vectors.top_k(asked, _corpus(spark, sf_dir), 10).select("query_id", "vec_id")
    both = stage(exact.join(near, ["query_id", "vec_id"], "left").groupBy("query_id").agg(F.count(F.lit(1)).alias("asked"), F.count("_hit").alias("hits")), "hits")
    share = both.agg((F.sum("hits") / F.sum("asked")).alias("share")).first()["share"] or 0.0
    return both.select("query_id", "asked", F.lit(share >= 0.9).alias("recall_reached"))


@query("vec2_approximate_top_k")
def approximate_top_k(spark, sf_dir):
    """Neighbours from the 4 nearest of 16 cells."""
    folder = scratch_path(spark, "cells")
    centres = vectors.build_cells(_corpus(spark, sf_dir), folder, 16)
    found = vectors.top_k_in_cells(_label_queries(spark, sf_dir), folder, centres, 10, probes=4)
    return found.withColumn("score", rounded("score"))


@query("vec2_every_cell", _nearest_sql("list_cosine_similarity(c, v)"))
def every_cell(spark, sf_dir):
    """With all cells probed the answer is exact."""
    folder = scratch_path(spark, "cells")
    centres = vectors.build_cells(_corpus(spark, sf_dir), folder, 8)
    found = vectors.top_k_in_cells(_label_queries(spark, sf_dir), folder, centres, 10, probes=8)
    return found.withColumn("score", rounded("score"))


@query(
    "lab1_event_labels",
    """WITH w AS (SELECT event_id, event_type, value, count(value) OVER f AS n, avg(value) OVER f AS m, stddev_samp(value) OVER f AS s FROM events
        WINDOW f AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
    z AS (SELECT *, CASE WHEN n = 20 THEN (value - m) / nullif(s, 0) END AS z FROM w)
    SELECT event_id, 'spike' AS rule_id, 'anomaly' AS label FROM z WHERE z > 3
    UNION ALL SELECT event_id, 'failed', 'error' FROM z WHERE event_type = 'error'
    UNION ALL SELECT event_id, 'low', 'idle' FROM z WHERE value < 0.5""",
)
def event_labels(spark, sf_dir):
    scored = series.spikes(events(spark, sf_dir), ["event_type"], "ts", "event_id", "value")
    rules = [
        ("spike", "anomaly", F.col("zscore") > 3),
        ("failed", "error", F.col("event_type") == "error"),
        ("low", "idle", F.col("value") < 0.5),
    ]
    return learning.label_events(scored, "event_id", rules)


@query(
    "ml1_forecast_folds",
    """WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hr, sum(value) AS v FROM events GROUP BY ALL),
    spine AS (SELECT event_type, unnest(generate_series(min(hr), max(hr), INTERVAL 1 HOUR)) AS hr FROM h GROUP BY event_type),
    f AS (SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY event_type) AS total FROM spine WINDOW w AS (PARTITION BY event_type ORDER BY hr)),
    kept AS (SELECT CAST(hr AS DATE) AS day FROM f WHERE n > 24 AND n + 24 <= total),
    s AS (SELECT day, ntile(6) OVER (ORDER BY day) AS slice FROM (SELECT DISTINCT day FROM kept))
    SELECT CAST(slice - 1 AS INTEGER) AS fold, count(*) AS test_rows, true AS near_baseline
    FROM kept JOIN s USING (day) WHERE slice > 1 GROUP BY slice""",
)
def forecast_folds(spark, sf_dir):
    """A boosted 24-hour forecast, tested on five later slices of time.

    Events fall at random, so a forecast cannot beat the training mean by much; it
    must not be far worse.
    """
    inputs = ["value", "lag_1", "lag_24", "mean_24", "hour_of_day", "day_of_week"]
    measures = learning.cross_validate(
        hourly_features(spark, sf_dir), "timestamp_hour", inputs, "target", iterations=5, depth=3
    )
    return measures.select("fold", "test_rows", (F.col("mae") <= 1.5 * F.col("mae_of_mean")).alias("near_baseline"))


@query(
    "ml2_training_audit",
    """WITH r AS (SELECT CASE WHEN event_type = 'error' THEN 'missing:run_id' WHEN value < 1 THEN 'missing:feature_version'
        WHEN user_id = 7 THEN 'missing:code_commit' END AS reason FROM events)
    SELECT coalesce(reason, 'accepted') AS outcome, count(*) AS runs FROM r GROUP BY ALL""",
)
def training_audit(spark, sf_dir):
    """Events as training runs, some of them lacking one of the five fields."""
    runs = events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("snapshot_id"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("run_id"),
        F.when(F.col("value") >= 1, F.col("value").cast("string")).otherwise(" ").alias("feature_version"),
        F.when(F.col("user_id") != 7, F.col("user_id")).alias("code_commit"),
        lineage.contract_hash("event_type", "props").alias("data_contract_hash"),
    )
    accepted, rejected = lineage.audit_training(runs)
    outcome = accepted.select(F.lit("accepted").alias("outcome")).unionByName(
        rejected.select(F.col(REASON).alias("outcome"))
    )
    return outcome.groupBy("outcome").agg(F.count(F.lit(1)).alias("runs"))


@query("ml3_clusters", "SELECT count(*) AS placed, 8::BIGINT AS clusters FROM embeddings")
def clusters(spark, sf_dir):
    """Every vector gets one of eight clusters, none of which stays empty."""
    out = learning.cluster(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 8)
    return out.agg(F.count("cluster").alias("placed"), F.count_distinct("cluster").alias("clusters"))


@query(
    "ml3_classified",
    "SELECT CAST(label = 0 AS INTEGER) AS target, count(*) AS scored, true AS mostly_right FROM embeddings GROUP BY target",
)
def classified(spark, sf_dir):
    """Vectors of label 0 against the rest, each classed by a model that has not seen it."""
    df = table(spark, sf_dir, "embeddings").withColumn("target", (F.col("label") == 0).cast("int"))
    out = stage(learning.classify_held_out(df, "vec_id", "embedding", "target", iterations=3), "classified")
    right = out.agg(F.avg((F.col("predicted") == F.col("target")).cast("int")).alias("share")).first()["share"]
    return out.groupBy("target").agg(F.count("predicted").alias("scored"), F.lit(right > 0.5).alias("mostly_right"))
