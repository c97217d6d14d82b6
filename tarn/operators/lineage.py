"""Lineage and contract records held as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.functions.skew import salted_join
from tarn.operators.validate import Rule, split
from tarn.session import stage

TRAINING_FIELDS = (
    "snapshot_id",
    "run_id",
    "feature_version",
    "code_commit",
    "data_contract_hash",
)


def lineage_records(
    contracts: DataFrame, snapshots: DataFrame, runs: DataFrame, key: str = "dataset_id"
) -> DataFrame:
    """Contract, snapshot and run of each dataset as one JSON record.

    Snapshots and runs must hold one row per dataset (see ``latest_per_key``);
    a dataset without one keeps its record with that part left out.
    """

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.struct(*[c for c in df.columns if c != key]).alias(name))

    joined = (
        part(contracts, "contract")
        .join(part(snapshots, "snapshot"), key, "left")
        .join(part(runs, "run"), key, "left")
    )
    return joined.select(
        key, F.to_json(F.struct(key, "contract", "snapshot", "run")).alias("record")
    )


def upstream_chain(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """Every upstream dataset of each dataset with its smallest distance.

    The reach doubles each round: a shortest path longer than h steps is one of h steps
    and a shortest path behind it. So with all pairs up to a distance h known, those at
    exactly h are joined with all, which gives the pairs up to 2 h. A chain of d steps takes
    about log2 d rounds; pairs that are known are dropped, so cycles end. A round is
    written, which cuts its lineage.
    """
    first = edges.select(F.col(child).alias("dataset"), F.col(parent).alias("upstream")).dropna().distinct()
    seen = stage(first.withColumn("depth", F.lit(1)), "chain")
    half = 1
    while True:
        far = seen.filter(F.col("depth") == half).select("dataset", F.col("upstream").alias("_mid"), F.col("depth").alias("_far"))
        behind = seen.select(F.col("dataset").alias("_mid"), "upstream", F.col("depth").alias("_more"))
        found = far.join(behind, "_mid").groupBy("dataset", "upstream").agg(F.min(F.col("_far") + F.col("_more")).alias("depth"))
        found = stage(found.join(seen.select("dataset", "upstream"), ["dataset", "upstream"], "left_anti"), "chain")
        if found.isEmpty():
            return seen
        seen, half = seen.unionByName(found), 2 * half


def original_sources(chain: DataFrame, edges: DataFrame, child: str) -> DataFrame:
    """The part of a chain that ends in datasets without any upstream of their own."""
    derived = edges.select(F.col(child).alias("upstream")).distinct()
    return salted_join(chain, derived, ["upstream"], "left_anti")


def training_rules(fields: Sequence[str] = TRAINING_FIELDS) -> list[Rule]:
    return [
        Rule(f"missing:{f}", F.col(f).isNull() | (F.trim(F.col(f).cast("string")) == ""))
        for f in fields
    ]


def audit_training(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training runs that carry all five lineage fields, and those rejected."""
    return split(runs, training_rules())


def contract_hash(*columns: Column | str) -> Column:
    return F.sha2(F.to_json(F.struct(*columns)), 256)
