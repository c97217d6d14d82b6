"""Training and scoring of tabular models with Spark ML, and rule-based labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.operators.series import time_folds
from tarn.session import stage


def label_events(scored: DataFrame, key: str, rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """A label table keyed to the source rows: one row per event and rule that applies.

    ``rules`` are (rule id, label, condition).
    """
    labels = [
        F.when(
            F.coalesce(condition, F.lit(False)),
            F.struct(F.lit(rule).alias("rule_id"), F.lit(label).alias("label")),
        )
        for rule, label, condition in rules
    ]
    return scored.select(key, F.inline(F.array_compact(F.array(*labels))))


def cross_validate(
    features: DataFrame,
    ts: str,
    inputs: Sequence[str],
    target: str,
    folds: int = 5,
    iterations: int = 10,
    depth: int = 4,
    seed: int = 7,
) -> DataFrame:
    """Train a boosted regressor on expanding time folds; error measures per fold.

    Rows lacking an input or the target take no part. Each fold's scores are
    reduced to its measures on the executors. ``mae_of_mean`` is the error of
    predicting the mean of the training rows.
    """
    rows = stage(time_folds(features.dropna(subset=[*inputs, target]), ts, folds), "folds")
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="_features")
    measures = []
    for k in range(1, folds + 1):
        trees = GBTRegressor(
            featuresCol="_features", labelCol=target, predictionCol="_predicted",
            maxIter=iterations, maxDepth=depth, seed=seed,
        )
        train = rows.filter(F.col("slice") <= k)
        model = Pipeline(stages=[assembler, trees]).fit(train)
        mean = train.agg(F.avg(target).alias("m")).first()["m"]
        error = F.col("_predicted") - F.col(target)
        scored = model.transform(rows.filter(F.col("slice") == k + 1))
        measures.append(
            scored.agg(
                F.lit(k).alias("fold"),
                F.count(F.lit(1)).alias("test_rows"),
                F.avg(F.abs(error)).alias("mae"),
                F.sqrt(F.avg(error * error)).alias("rmse"),
                F.avg(F.abs(F.col(target) - F.lit(mean))).alias("mae_of_mean"),
            )
        )
    return reduce(DataFrame.unionByName, measures)


def cluster(df: DataFrame, key: str, vector: str, k: int, seed: int = 7) -> DataFrame:
    """K-means cluster of each row's feature vector."""
    ready = df.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("_features"))
    model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster").fit(ready)
    return model.transform(ready).select(key, "cluster")


def classify(
    train: DataFrame, rows: DataFrame, key: str, vector: str, label: str,
    iterations: int = 5, depth: int = 3, seed: int = 7,
) -> DataFrame:
    """Boosted two-class classifier: trained on labelled rows, applied to all."""
    def ready(df: DataFrame, *extra: Column) -> DataFrame:
        return df.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("_features"), *extra)

    model = GBTClassifier(
        featuresCol="_features", labelCol="_label", maxIter=iterations, maxDepth=depth, seed=seed
    ).fit(ready(train, F.col(label).cast("double").alias("_label")))
    return model.transform(ready(rows)).select(key, F.col("prediction").cast("int").alias("predicted"))


def classify_held_out(
    df: DataFrame, key: str, vector: str, label: str, folds: int = 2, seed: int = 7, **settings: int
) -> DataFrame:
    """Every row's class by a model that was trained without its fold: (key, label, predicted)."""
    fold = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(folds))
    rows = stage(df.select(key, vector, label).withColumn("_fold", fold), "folds")
    parts = [
        classify(rows.filter(fold_is), rows.filter(~fold_is), key, vector, label, seed=seed, **settings)
        for fold_is in [F.col("_fold") != k for k in range(folds)]
    ]
    return reduce(DataFrame.unionByName, parts).join(rows.select(key, label), key).select(key, label, "predicted")
