"""Gold tables: hourly inference cost, comparisons, and event features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarn.functions import formulas
from tarn.functions.skew import dimension_join
from tarn.operators.aggregates import compare_groups
from tarn.operators.joins import hourly_cost_join
from tarn.operators.series import below_quartile, event_study, fill_calendar, trend
from tarn.operators.validate import deduplicate


def ai_inference_cost(
    carbon: DataFrame, efficiency: DataFrame, pricing: DataFrame, regions: DataFrame, per_instance: bool = True
) -> DataFrame:
    """One row per country, hour, model and accelerator (and priced instance).

    ``regions`` is (region, country). Prices hold from ``valid_from`` until the
    next one of the same instance. The quartile flags compare hours of one day.
    With ``per_instance=False`` a row takes the cheapest instance of its country and
    accelerator on that day, by provider, type and region among equal prices.
    """
    placed = dimension_join(pricing, regions, ["region"], "inner")
    daily = fill_calendar(
        placed,
        ["country", "provider", "instance_type", "region", "accelerator"],
        "valid_from",
        ["price_eur_per_hour"],
        until=carbon.agg(F.to_date(F.max("timestamp_hour")).alias("d")).first()["d"],
    )
    greenest = below_quartile(
        carbon, ["country"], "timestamp_hour", "carbon_intensity_gco2_kwh", "greenest_hour_flag"
    )
    priced = _cheap_days(carbon, efficiency, daily)
    if not per_instance:
        order = [F.col("price_eur_per_hour").asc_nulls_last(), "provider", "instance_type", "region"]
        priced = deduplicate(priced, ["country", "accelerator", "valid_from"], order)
    rows = hourly_cost_join(greenest, efficiency, priced)
    return (
        rows.withColumn("tokens_per_hour", formulas.tokens_per_hour("tokens_per_sec"))
        .withColumn(
            "eur_per_million_tokens",
            formulas.eur_per_million_tokens("price_eur_per_hour", "tokens_per_hour"),
        )
        .withColumn(
            "gco2_per_million_tokens",
            formulas.gco2_per_million_tokens("carbon_intensity_gco2_kwh", "wh_per_million_tokens"),
        )
    )


def _cheap_days(carbon: DataFrame, efficiency: DataFrame, daily: DataFrame, q: float = 0.25) -> DataFrame:
    """Daily prices flagged below the quartile of their instance over the rows of the table to come.

    A price stands for as many rows as its country has hours that day, times the
    models of its accelerator; the quartile counts it so often, and no window
    sees those rows.
    """
    hours = carbon.groupBy("country", F.to_date("timestamp_hour").alias("valid_from")).agg(
        F.count(F.lit(1)).alias("_hours")
    )
    models = efficiency.groupBy("accelerator").agg(F.count(F.lit(1)).alias("_models"))
    # both sides are as short as a calendar and a list of devices; adaptive execution sees their sizes
    counted = daily.join(hours, ["country", "valid_from"]).join(models, "accelerator")
    of_day = Window.partitionBy("provider", "instance_type", "valid_from")
    bound = F.percentile("price_eur_per_hour", F.lit(q), F.col("_hours") * F.col("_models")).over(of_day)
    return counted.withColumn("cheapest_hour_flag", F.col("price_eur_per_hour") < bound).drop("_hours", "_models")


def country_comparison(cost: DataFrame) -> DataFrame:
    return compare_groups(cost, ["country"], ["gco2_per_million_tokens", "eur_per_million_tokens"])


def efficiency_over_time(efficiency: DataFrame) -> DataFrame:
    return trend(efficiency, ["model_name", "accelerator"], "round_id", "wh_per_million_tokens")


def event_features(rates: DataFrame, market: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Event study of every rate change of every series against every symbol, or those ``pairs`` names."""
    return event_study(
        rates,
        market,
        day="observation_date",
        rate="rate_pct",
        series_day="observation_date",
        close="close",
        symbol=["symbol"],
        series_of_rate=["series"],
        pairs=pairs,
    )
