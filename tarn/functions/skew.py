"""Joins that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.session import stage

# A side is broadcast only if it was counted and stays below both bounds.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024

# A key is hot from this share of the rows on, or from this many rows, whichever is less.
HOT_SHARE = 0.002
HOT_ROWS = 2_000_000
SALTS = 64


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether ``df`` was counted to be below a number of rows and of bytes of JSON text.

    Both are plain aggregates; the text is measured only if the rows are few.
    """
    if df.count() > max_rows:
        return False
    size = df.select(F.octet_length(F.to_json(F.struct("*"))).alias("b")).agg(F.sum("b")).first()[0]
    return (size or 0) <= max_bytes


def null_safe_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left"
) -> DataFrame:
    """Equi-join that also matches null keys; ``right`` brings its other columns."""
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns]
    )
    condition = None
    for c in on:
        term = left[c].eqNullSafe(renamed[f"_r_{c}"])
        condition = term if condition is None else condition & term
    if condition is None:
        raise ValueError("a join needs at least one key")
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in on])


def row_salt(columns: Sequence[str], salts: int) -> Column:
    """Stable spread of rows over ``salts`` values.

    The partition id keeps copies of one row apart and, unlike a random
    number, does not change when a lost task runs again.
    """
    return F.pmod(F.xxhash64(*columns, F.spark_partition_id()), F.lit(salts)).cast("int")


def hashable(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if "map<" not in t and "variant" not in t]


def hot_keys(facts: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys holding more than ``share`` of the rows or than ``HOT_ROWS``.

    A hot key always has more than 1 / BROADCAST_ROWS of the rows, so that many
    keys at most are hot.
    """
    total = facts.count()
    most = max(min(total * share, HOT_ROWS), total / BROADCAST_ROWS)
    return (
        facts.dropna(subset=list(on))
        .groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > F.lit(most))
        .drop("_n")
    )


def _in_order(joined: DataFrame, facts: DataFrame, dim: DataFrame, on: list[str], how: str) -> DataFrame:
    """Columns of the facts as they were, then those the other side brings."""
    brought = [] if how in ("left_semi", "left_anti") else [c for c in dim.columns if c not in on]
    return joined.select(*facts.columns, *brought)


def salted_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    salts: int = SALTS,
    share: float = HOT_SHARE,
) -> DataFrame:
    """Shuffled join in which hot keys are spread over ``salts`` tasks.

    ``how`` is left, inner, left_semi or left_anti. Rows of ``dim`` are copied
    only for the hot keys, so its volume hardly grows. Rows of ``facts`` with a
    null key match nothing and are spread as well.
    """
    on = list(on)
    hot = F.broadcast(stage(hot_keys(facts, on, share), "hot").withColumn("_hot", F.lit(True)))
    null_key = F.lit(False)
    for c in on:
        null_key = null_key | F.col(c).isNull()
    left = facts.join(hot, on, "left").withColumn(
        "_salt",
        F.when(F.col("_hot") | null_key, row_salt(hashable(facts), salts)).otherwise(F.lit(0)),
    )
    right = dim.join(hot, on, "left").withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
                F.array(F.lit(0))
            )
        ),
    )
    joined = left.drop("_hot").join(right.drop("_hot"), [*on, "_salt"], how)
    return _in_order(joined, facts, dim, on, how)


def dimension_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    derived: bool = False,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join facts to a side that is normally small.

    The side is counted first. Within the bound it is broadcast and the facts
    are not shuffled; beyond it the join is a salted shuffle. ``derived`` marks
    a side computed from large input: it is written once, so that counting and
    joining do not compute it twice.
    """
    if derived:
        dim = stage(dim, "dim")
    if fits_broadcast(dim, max_rows):
        return _in_order(facts.join(F.broadcast(dim), list(on), how), facts, dim, list(on), how)
    return salted_join(facts, dim, on, how)
