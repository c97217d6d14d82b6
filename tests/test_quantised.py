"""Neighbours by codes against exact ones."""

import numpy as np
import pytest

from tarn.operators import quantised, vectors
from tarn.operators.quantised import _means, _nearest, _units, build_codes, top_k_by_codes


def table(spark, made, parts=4):
    return spark.createDataFrame([(k, None if v is None else [float(x) for x in v]) for k, v in enumerate(made)], "vec_id long, vector array<float>").repartition(parts)


def recall(spark, docs, asked, index, folder, **more):
    exact = {(r["query_id"], r["vec_id"]) for r in vectors.top_k(asked, docs, 10).collect()}
    found = top_k_by_codes(asked, index, 10, **more).collect()
    assert all(r["rank"] <= 10 for r in found)
    return len(exact & {(r["query_id"], r["vec_id"]) for r in found}) / len(exact)


def test_recall_of_rows_without_structure(spark, folder):
    """Gaussian vectors have no clusters, the hardest case for cells; a third of the rows is one vector."""
    pick = np.random.default_rng(1)
    made = list(pick.normal(size=(2000, 32))) + [np.ones(32)] * 1000
    docs = table(spark, made)
    asked = docs.filter("vec_id % 100 = 0 AND vec_id < 2000").withColumnRenamed("vec_id", "query_id")
    index = build_codes(docs, f"{folder}/codes", cells=8, groups=8, sample_rows=1500)
    assert recall(spark, docs, asked, index, folder) >= 0.9
    assert recall(spark, docs, asked, index, folder, per_round=3) >= 0.9
    assert spark.read.parquet(f"{folder}/codes").count() == 3000
    # the more rows are ranked exactly, the more is found
    few, many = (recall(spark, docs, asked, index, folder, shortlist=n) for n in (10, 600))
    assert few <= many and many >= 0.97


def test_scores_are_exact(spark, folder):
    pick = np.random.default_rng(2)
    docs = table(spark, pick.normal(size=(300, 12)))
    asked = docs.filter("vec_id < 5").withColumnRenamed("vec_id", "query_id")
    index = build_codes(docs, f"{folder}/codes", cells=4, groups=5)
    want = {(r["query_id"], r["vec_id"]): (r["score"], r["rank"]) for r in vectors.top_k(asked, docs, 3).collect()}
    got = {(r["query_id"], r["vec_id"]): (r["score"], r["rank"]) for r in top_k_by_codes(asked, index, 3, shortlist=300).collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_cells_that_are_not_probed_are_not_read(spark, folder):
    pick = np.random.default_rng(3)
    centres = np.eye(8) * 10
    docs = table(spark, np.concatenate([c + pick.normal(size=(50, 8)) * 0.1 for c in centres]))
    index = build_codes(docs, f"{folder}/codes", cells=8, groups=4)
    run, cells = quantised._shortlist(np.array([1]), _units(centres[:1]), index, 2, 5)
    assert len(cells) == 2 < len(index.centres)


def test_odd_rows(spark, folder):
    """Null vectors are left out, vectors without a direction are found by nobody, few rows make few codes."""
    docs = table(spark, [[1, 0, 0], [0, 1, 0], [0, 0, 0], None, [1, 0, 0], [1, 1, 0]])
    index = build_codes(docs, f"{folder}/codes")
    asked = spark.createDataFrame([(1, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (2, [0.0, 0.0, 0.0]), (3, None)], "query_id long, vector array<float>")
    got = [(r["query_id"], r["vec_id"], r["rank"]) for r in top_k_by_codes(asked, index, 3).orderBy("query_id", "rank").collect()]
    assert got == [(1, 0, 1), (1, 4, 2), (1, 5, 3)]
    assert top_k_by_codes(asked.filter("query_id > 5"), index, 3).collect() == []
    with pytest.raises(ValueError, match="needs vectors"):
        build_codes(docs.filter("vec_id = 3"), f"{folder}/none")


def test_nearest_and_means():
    pick = np.random.default_rng(4)
    rows, points = pick.normal(size=(500, 6)), pick.normal(size=(20, 6))
    want = np.argmin(((rows[:, None] - points[None]) ** 2).sum(axis=2), axis=1)
    assert (_nearest(rows, points) == want).all()
    assert len(_means(np.repeat(points, 5, axis=0), 30, 1)) == 20
    fitted = _means(rows, 16, 1)
    assert ((rows - fitted[_nearest(rows, fitted)]) ** 2).sum() < ((rows - rows.mean(axis=0)) ** 2).sum() * 0.8
    assert (_means(rows, 16, 1) == fitted).all()
