"""Approximate neighbours by cosine over product-quantised codes.

Every row of the corpus is kept in the folder of its nearest cell as a code of a few
bytes: per group of dimensions the nearest of up to 256 code vectors of what the cell's
centre leaves over. A search reads codes only. A query is compared with the code vectors
once, so that a row costs a few lookups (asymmetric distance), and each query keeps a
shortlist. The vectors of the shortlist alone are read then, and ranked exactly.

Cells and code vectors are fitted on a bounded sample of rows, picked by a hash of the id;
every row is indexed. How much is found is measured (``vec2_recall``).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions.skew import fits_broadcast
from tarn.operators.vectors import FOUND, QUERIES_PER_ROUND, _Best, _ranked, _rounds
from tarn.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE_ROWS = 50_000  # that cells and code vectors are fitted on
CODES = 256
SCORES_AT_ONCE = 2_000_000


@dataclass
class Codes:
    """A written index: the folder, the cell centres, and the code vectors of each group of dimensions."""

    path: str
    centres: np.ndarray
    books: list[np.ndarray]

    def encode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell and the code of each unit vector."""
        cell = _nearest(units, self.centres)
        left, codes, at = units - self.centres[cell], [], 0
        for book in self.books:
            codes.append(_nearest(left[:, at : at + book.shape[1]], book))
            at += book.shape[1]
        return cell, np.stack(codes, axis=1).astype(np.uint8)

    def tables(self, units: np.ndarray) -> np.ndarray:
        """Products of each query with all code vectors: queries x groups x codes."""
        out, at = np.zeros((len(units), len(self.books), CODES)), 0
        for k, book in enumerate(self.books):
            out[:, k, : len(book)] = units[:, at : at + book.shape[1]] @ book.T
            at += book.shape[1]
        return out


def _units(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def _nearest(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The number of the nearest point of each row, the first of equally near ones."""
    half = (points**2).sum(axis=1) / 2
    step = max(1, SCORES_AT_ONCE // max(1, len(points)))
    parts = [np.argmax(rows[i : i + step] @ points.T - half, axis=1) for i in range(0, len(rows), step)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def _means(rows: np.ndarray, k: int, seed: int, rounds: int = 15) -> np.ndarray:
    """k-means by plain rounds; of fewer distinct rows than ``k`` all."""
    distinct = np.unique(rows, axis=0)
    if len(distinct) <= k:
        return distinct
    points = distinct[np.sort(np.random.default_rng(seed).choice(len(distinct), k, replace=False))]
    for _ in range(rounds):
        of = _nearest(rows, points)
        held = np.bincount(of, minlength=len(points))
        sums = np.zeros_like(points)
        np.add.at(sums, of, rows)
        points = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], points)
    return points


def build_codes(
    corpus: DataFrame, path: str, cells: int = 16, groups: int = 16, sample_rows: int = SAMPLE_ROWS, seed: int = 7
) -> Codes:
    """Index ``corpus`` (vec_id long, vector) below ``path``, a folder per cell.

    Rows without a vector are left out. Large cells are split into several files, so no
    task has to hold one.
    """
    known = corpus.filter("vector IS NOT NULL").select("vec_id", "vector")
    total = known.count()
    share = F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1 << 20))
    # about as many rows as asked for, and never more than twice that
    picked = known.filter(share < int(min(1.0, sample_rows / max(1, total)) * (1 << 20)) + 1).limit(2 * sample_rows).toPandas()
    if picked.empty:
        picked = known.limit(sample_rows).toPandas()
    if picked.empty:
        raise ValueError("an index needs vectors")
    picked = picked.sort_values("vec_id", kind="stable")
    units = _units(np.stack(picked["vector"].to_numpy()).astype(np.float64))
    centres = _means(units, cells, seed)
    left = units - centres[_nearest(units, centres)]
    books = [_means(part, CODES, seed + k) for k, part in enumerate(np.array_split(left, min(groups, left.shape[1]), axis=1))]
    index = Codes(path, centres, books)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                cell, codes = index.encode(_units(np.stack(batch["vector"].to_numpy()).astype(np.float64)))
                yield batch.assign(code=[c.tobytes() for c in codes], cell=cell.astype(np.int32))

    kind = known.schema["vector"].dataType.simpleString()
    coded = known.mapInPandas(encode, f"vec_id long, vector {kind}, code binary, cell int")
    coded.hint("rebalance", "cell").write.partitionBy("cell").parquet(path)
    return index


def _shortlist(names: np.ndarray, units: np.ndarray, index: Codes, probes: int, keep: int):
    """Task function: the best ``keep`` rows of a partition per query, by codes."""
    near = units @ index.centres.T
    asked_cells = np.argsort(-near, axis=1, kind="stable")[:, :probes]
    queries_of = {c: np.flatnonzero((asked_cells == c).any(axis=1)) for c in range(len(index.centres))}
    tables = index.tables(units).astype(np.float32)
    groups = np.arange(len(index.books))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = _Best(len(names), keep)
        for batch in batches:
            for cell, rows in batch.groupby("cell"):
                asked = queries_of[int(cell)]
                if not len(asked):
                    continue
                codes = np.frombuffer(b"".join(rows["code"]), dtype=np.uint8).reshape(len(rows), -1)
                ids = rows["vec_id"].to_numpy()
                step = max(1, SCORES_AT_ONCE // (len(asked) * len(groups)))
                for at in range(0, len(ids), step):
                    found = tables[asked][:, groups[None, :], codes[at : at + step]].sum(axis=2)
                    best.add(asked, ids[at : at + step], near[asked, int(cell)][:, None] + found)
        yield best.rows(names)

    return run, sorted(c for c, q in queries_of.items() if len(q))


def top_k_by_codes(
    queries: DataFrame, index: Codes, k: int, probes: int | None = None, shortlist: int | None = None,
    per_round: int = QUERIES_PER_ROUND,
) -> DataFrame:
    """About the k nearest rows of every query by cosine: query_id, vec_id, score (exact) and rank.

    Each query reads the codes of its ``probes`` nearest cells (all, if None) and ranks
    ``shortlist`` rows exactly (20 x k, if None). A repeated query counts once; vectors
    without a direction find nothing and are found last.
    """
    spark, probes, keep = queries.sparkSession, probes or len(index.centres), shortlist or 20 * k
    corpus = spark.read.parquet(index.path)
    queries = stage(queries.select("query_id", "vector").filter("vector IS NOT NULL").dropDuplicates(), "queries")
    found = spark.createDataFrame([], "query_id long, vec_id long")
    for part in _rounds(queries, per_round):
        local = part.toPandas()
        if local.empty:
            continue
        units = _units(np.stack(local["vector"].to_numpy()).astype(np.float64))
        run, cells = _shortlist(local["query_id"].to_numpy(), units, index, probes, keep)
        coded = corpus.select("vec_id", "code", "cell").filter(F.col("cell").isin(cells))
        near = _ranked(coded.mapInPandas(run, FOUND), keep).select("query_id", "vec_id")
        found = found.unionByName(stage(near, "shortlist"))

    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    product = F.aggregate(
        F.zip_with("vector", "_asked", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda a, x: a + x
    )
    # the shortlist is small beside the corpus; its size is checked
    rows = corpus.select("vec_id", "vector")
    wanted = stage(found.distinct(), "wanted")
    joined = rows.join(F.broadcast(wanted) if fits_broadcast(wanted) else wanted, "vec_id")
    asked = queries.withColumnRenamed("vector", "_asked")
    joined = joined.join(F.broadcast(asked) if fits_broadcast(asked) else asked, "query_id")
    scored = joined.select("query_id", "vec_id", F.try_divide(product, norm(F.col("vector")) * norm(F.col("_asked"))).alias("score"))
    return _ranked(scored.filter("score IS NOT NULL"), k)
