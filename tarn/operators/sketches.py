"""Sketches that are kept in tables and merged: distinct counts and quantiles of any coarser grain.

A state per key and day has a row count, an HLL sketch per counted column and a KLL
sketch per measured one. States of days add up to those of months or of fewer keys
without the rows they came from, and a new day only adds its own state
(``plans.refresh`` computes the states of new days alone). Both kinds of sketch are
made and merged by Spark on the map side; a state has a bounded size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HLL_BITS = 12  # a standard error of about 1.6 %
KLL_SIZE = 200  # a rank error of about 1.7 %


def daily_states(
    df: DataFrame, keys: Sequence[str], ts: str, distinct: Sequence[str] = (), measured: Sequence[str] = (),
    hll_bits: int = HLL_BITS, kll_size: int = KLL_SIZE,
) -> DataFrame:
    """A state per key and day: ``n``, ``hll_<column>`` and ``kll_<column>``, and ``day``.

    Nulls are neither counted nor measured; a column that is all null has an empty state.
    """
    states = [F.count(F.lit(1)).alias("n")]
    states += [F.hll_sketch_agg(F.col(c), hll_bits).alias(f"hll_{c}") for c in distinct]
    # not-a-number has no rank
    states += [F.kll_sketch_agg_double(F.nanvl(F.col(c).cast("double"), F.lit(None)), kll_size).alias(f"kll_{c}") for c in measured]
    return df.groupBy(*keys, F.to_date(ts).alias("day")).agg(*states)


def merged_states(states: DataFrame, keys: Sequence[str], grain: str | None = None) -> DataFrame:
    """States of fewer keys or of longer spans: ``grain`` is a unit of ``date_trunc``, or None for all days."""
    sums = [F.sum("n").alias("n")]
    for c in states.columns:
        if c.startswith("hll_"):
            sums.append(F.hll_union_agg(c, F.lit(True)).alias(c))
        elif c.startswith("kll_"):
            sums.append(F.kll_merge_agg_double(c).alias(c))
    span = [F.to_date(F.date_trunc(grain, "day")).alias("day")] if grain else []
    return states.groupBy(*keys, *span).agg(*sums)


def distinct_count(column: str) -> Column:
    """About how many different values of the column the state has seen."""
    return F.hll_sketch_estimate(f"hll_{column}")


def quantile(column: str, q: float) -> Column:
    """About the value of the column that the share ``q`` of the rows does not exceed; null if there was none."""
    state = F.col(f"kll_{column}")
    return F.when(F.kll_sketch_get_n_double(state) > 0, F.kll_sketch_get_quantile_double(state, F.lit(q)))


def rank(column: str, value: Column | float) -> Column:
    """About which share of the rows does not exceed the value."""
    state = F.col(f"kll_{column}")
    return F.when(F.kll_sketch_get_n_double(state) > 0, F.kll_sketch_get_rank_double(state, value if isinstance(value, Column) else F.lit(float(value))))
