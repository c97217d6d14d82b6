"""Registry of bound queries and shared column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def query(name: str, sql: str | None = None):
    """Register a query, and the SQL to check it with."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their times as UTC instants."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their dates as dates."""
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))


def ntz(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


def rounded(column: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, digits)


def daily_closes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean order price per priority and business day: the stand-in for a market series."""
    from tarn.operators.validate import business_days

    # whole cents, so that the sum does not depend on the order of its terms
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return (
        business_days(orders(spark, sf_dir), "o_orderdate")
        .groupBy(F.col("o_orderpriority").alias("symbol"), F.col("o_orderdate").alias("day"))
        .agg((F.sum(cents).cast("double") / (F.count(F.lit(1)) * 100)).alias("close"))
    )


DAILY_CLOSES = """
    SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS day, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / (count(*) * 100) AS close
    FROM orders WHERE isodow(o_orderdate) <= 5 GROUP BY ALL
"""
