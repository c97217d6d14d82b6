"""Helpers that the text operators share."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.functions.skew import fits_broadcast

# white space and words as byte classes; everything else belongs to a word
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(name: str) -> Column:
    """The column as text; null is empty."""
    return F.coalesce(column(name), F.lit(""))


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def words(text: Column) -> Column:
    """The words of a text, as an array."""
    return F.array_remove(F.split(text, SPACE), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where lambdas use it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole_row(df: DataFrame) -> Column:
    """All columns of a row in one struct, so that names an operator adds cannot clash with them."""
    return F.struct(*[column(c) for c in df.columns])


def columns_of(df: DataFrame, struct: str, like: DataFrame) -> DataFrame:
    """The columns that ``whole_row`` packed."""
    return df.select(*[F.col(struct).getField(c).alias(c) for c in like.columns])


def small_join(facts: DataFrame, side: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join to a side that is normally small: broadcast if counted to be so, else a shuffled join.

    The shuffled form leaves hot keys to the adaptive split of skewed join partitions.
    """
    if fits_broadcast(side, max_rows=200_000, max_bytes=16 * 1024 * 1024):
        side = F.broadcast(side)
    return facts.join(side, on, how)


def worker_memo(name: str) -> dict:
    """A dict that lives as long as a Python worker, for values that are costly to make."""
    home = sys.modules.setdefault("tarn_worker_memo", types.ModuleType("tarn_worker_memo"))
    return home.__dict__.setdefault(name, {})
