"""Connected components of edges, as a few rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.session import stage


def connected(edges: DataFrame) -> DataFrame:
    """For each vertex ``v`` of the edges (``a``, ``b``) the smallest vertex of its component, as ``label``.

    A round hands each vertex the smallest label among its neighbours and then the
    label of that label, so labels travel twice as far in each round. A round is
    written to the shared folder, and the loop ends when nothing changes. Hot
    vertices are combined on the map side; joins on them are ones that adaptive
    execution splits.
    """
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(both.filter("a != b").distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("v", "b"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        nearer = labels.join(near, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        target = labels.select(F.col("v").alias("label"), F.col("label").alias("next"))
        jumped = nearer.join(target, "label", "left").select("v", "old", F.least("label", F.coalesce("next", "label")).alias("label"))
        jumped = stage(jumped, "labels")
        if jumped.filter("label < old").isEmpty():
            return jumped.select("v", "label")
        labels = jumped.select("v", "label")
