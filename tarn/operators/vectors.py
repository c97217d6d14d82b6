"""Similarity search over embedding columns.

The corpus is the large side and stays where it is: each task compares its own
rows with the queries in blocks and keeps the k best per query, so what is
shuffled grows with queries x tasks, not with queries x corpus. Queries are
shipped only after their number is known to be below a bound; more of them are
searched in several rounds.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarn.functions.skew import fits_broadcast
from tarn.session import stage

# task functions travel with their code, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUERIES_PER_ROUND = 10_000
SCORES_AT_ONCE = 2_000_000  # a task's array of queries x rows
FOUND = "query_id long, vec_id long, score double"
METRICS = ("cosine", "inner_product", "l2")


def _scores(queries: np.ndarray, block: np.ndarray, metric: str) -> np.ndarray:
    """Queries x block scores, higher is nearer. A null vector scores NaN under cosine."""
    products = queries @ block.T
    if metric == "inner_product":
        return products
    if metric == "cosine":
        norms = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(block, axis=1)[None, :]
        with np.errstate(invalid="ignore", divide="ignore"):
            return products / norms
    squares = (queries**2).sum(axis=1)[:, None] + (block**2).sum(axis=1)[None, :]
    return -np.sqrt(np.maximum(squares - 2 * products, 0))


class _Best:
    """The k best (score, id) pairs per query seen so far by one task."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores = np.full((queries, k), -np.inf)
        self.ids = np.zeros((queries, k), dtype=np.int64)
        self.filled = np.zeros((queries, k), dtype=bool)

    def add(self, asked: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        all_scores = np.concatenate([self.scores[asked], scores], axis=1)
        all_ids = np.concatenate([self.ids[asked], np.broadcast_to(ids, scores.shape)], axis=1)
        filled = np.concatenate([self.filled[asked], np.ones(scores.shape, dtype=bool)], axis=1)
        # equal scores are ordered by id, as in the final ranking
        order = np.lexsort((all_ids, -all_scores, ~filled), axis=1)[:, : self.k]
        self.scores[asked] = np.take_along_axis(all_scores, order, axis=1)
        self.ids[asked] = np.take_along_axis(all_ids, order, axis=1)
        self.filled[asked] = np.take_along_axis(filled, order, axis=1)

    def rows(self, names: np.ndarray) -> pd.DataFrame:
        query, slot = np.nonzero(self.filled)
        return pd.DataFrame(
            {
                "query_id": names[query],
                "vec_id": self.ids[query, slot],
                "score": self.scores[query, slot],
            }
        )


def _local_best(names, matrix, cells, k, metric):
    """Task function: the k best rows of one partition per query.

    ``cells`` holds the queries that look into each cell; None means all
    queries look at all rows.
    """
    everyone = np.arange(len(names))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = _Best(len(names), k)
        for batch in batches:
            if batch.empty:
                continue
            parts = [(None, batch)] if cells is None else batch.groupby("cell")
            for cell, rows in parts:
                asked = everyone if cells is None else cells.get(int(cell), everyone[:0])
                if not len(asked):
                    continue
                vectors = np.stack(rows["vector"].to_numpy()).astype(np.float64)
                ids = rows["vec_id"].to_numpy()
                step = max(1, SCORES_AT_ONCE // len(asked))
                for at in range(0, len(ids), step):
                    scores = _scores(matrix[asked], vectors[at : at + step], metric)
                    scores = np.where(np.isnan(scores), -np.inf, scores)
                    best.add(asked, ids[at : at + step], scores)
        yield best.rows(names)

    return run


def _rounds(queries: DataFrame, per_round: int) -> list[DataFrame]:
    """Split staged queries into parts that are each below the bound."""
    if fits_broadcast(queries, per_round):
        return [queries]
    parts = 2 * (queries.count() // per_round + 1)
    # an id may come with several vectors; equal rows were dropped, so every part gets smaller
    bucket = F.pmod(F.xxhash64("query_id", "vector", F.lit(parts)), F.lit(parts))
    split = [queries.filter(bucket == i) for i in range(parts)]
    return [r for part in split for r in _rounds(part, per_round)]


def top_k(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    metric: str = "cosine",
    per_round: int = QUERIES_PER_ROUND,
) -> DataFrame:
    """The k nearest corpus rows of every query, exact.

    ``queries`` is (query_id long, vector), ``corpus`` (vec_id long, vector).
    ``score`` is the cosine, the inner product or the negative distance. Rows without
    a vector find nothing and are not found; a repeated query counts once; no queries
    give no rows.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}, known: {METRICS}")
    return _search(queries, corpus, None, k, metric, per_round)


def _search(queries, corpus, probes, k, metric, per_round):
    queries = stage(queries.select("query_id", "vector").filter("vector is not null").dropDuplicates(), "queries")
    corpus = corpus.filter("vector is not null")
    found, rounds = [], _rounds(queries, per_round)
    for part in rounds:
        local = part.toPandas()
        if local.empty:
            continue
        names = local["query_id"].to_numpy()
        matrix = np.stack(local["vector"].to_numpy()).astype(np.float64)
        cells = probes(matrix) if probes else None
        rows = corpus if cells is None else corpus.filter(F.col("cell").isin(sorted(cells)))
        near = _ranked(rows.mapInPandas(_local_best(names, matrix, cells, k, metric), FOUND), k)
        if len(rounds) == 1:
            return near
        # run each round now, so that the driver holds the queries of one at a time
        found.append(stage(near.drop("rank"), "found"))
    if not found:
        return _ranked(queries.sparkSession.createDataFrame([], FOUND), k)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return _ranked(out, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best per query. The filter also runs before the shuffle: k rows per query and task."""
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def centroids(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Mean vector per group, averaged element by element."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    mean = Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>")))
    return df.groupBy(group).agg(vector_to_array(mean).alias(vector))


def build_cells(corpus: DataFrame, path: str, cells: int, seed: int = 7, iterations: int = 10) -> np.ndarray:
    """Cluster unit vectors into cells and write the corpus as one folder per cell.

    Large cells are split into several files by the rebalance, so no task has
    to hold one. Returns the cell centres (``cells`` x dimension).
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    unit = corpus.withColumn(
        "_unit",
        array_to_vector(F.transform("vector", lambda x: F.coalesce(F.try_divide(x.cast("double"), norm), F.lit(0.0)))),
    )
    model = KMeans(
        k=cells, seed=seed, maxIter=iterations, featuresCol="_unit", predictionCol="cell"
    ).fit(unit)
    placed = model.transform(unit).select("vec_id", "vector", "cell")
    placed.hint("rebalance", "cell").write.partitionBy("cell").parquet(path)
    return np.stack(model.clusterCenters())


def top_k_in_cells(
    queries: DataFrame,
    path: str,
    centres: np.ndarray,
    k: int,
    probes: int,
    metric: str = "cosine",
    per_round: int = QUERIES_PER_ROUND,
) -> DataFrame:
    """Approximate neighbours: each query looks only into its ``probes`` nearest cells.

    Cells no query asks for are pruned as folders. With as many probes as
    cells the result is exact.
    """
    corpus = queries.sparkSession.read.parquet(path)

    def nearest(matrix: np.ndarray) -> dict[int, np.ndarray]:
        picked = np.argsort(-_scores(matrix, centres, "cosine"), axis=1)[:, :probes]
        return {
            int(c): np.flatnonzero((picked == c).any(axis=1)) for c in np.unique(picked)
        }

    return _search(queries, corpus, nearest, k, metric, per_round)
