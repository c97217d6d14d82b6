"""Silver tables of the energy and cost domain: pure table-to-table functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.functions import formulas
from tarn.functions.skew import null_safe_join
from tarn.operators.aggregates import best_per_group, latest_per_key, mix_json, weighted_mean
from tarn.operators.joins import join_rate, lookup, lookup_name, lookup_pattern, rate_calendar
from tarn.operators.series import change_bps, fill_calendar, simple_return
from tarn.session import stage
from tarn.operators.validate import business_days, deduplicate, only_series


def carbon_intensity(generation: DataFrame, factors: DataFrame, mix: bool = False) -> DataFrame:
    """Hourly share-weighted carbon intensity per country.

    ``factors`` is (psr_type, gco2_kwh). Quarter-hour points are averaged to
    hours first; a plant type without a factor does not count. With ``mix`` the
    hour's generation per plant type is added as JSON.
    """
    hourly = generation.groupBy(
        F.date_trunc("hour", "timestamp_utc").alias("timestamp_hour"), "country", "psr_type"
    ).agg(F.avg("quantity_mw").alias("quantity_mw"))
    known = lookup(hourly, factors, "psr_type", "psr_type", {"gco2_kwh": "gco2_kwh"})
    keys = ["timestamp_hour", "country"]
    intensity = weighted_mean(known, keys, "quantity_mw", "gco2_kwh", "carbon_intensity_gco2_kwh")
    if not mix:
        return intensity
    return null_safe_join(intensity, mix_json(hourly, keys, "psr_type", "quantity_mw", "generation_mix_json"), keys)


def mlperf_efficiency(
    results: DataFrame,
    tdp: DataFrame,
    keys: tuple[str, ...] = ("round_id", "model_name", "accelerator"),
    scenario: str | None = "Offline",
) -> DataFrame:
    """Best result per key with board power and energy per million tokens.

    ``tdp`` is (accelerator, tdp_watts); an unknown accelerator gives nulls.
    """
    if scenario is not None:
        results = results.filter(F.col("scenario") == scenario)
    best = best_per_group(results, keys, "tokens_per_sec")
    powered = lookup_name(best, tdp, "accelerator", "accelerator", "tdp_watts", "tdp_watts")
    return powered.withColumn(
        "wh_per_million_tokens", formulas.wh_per_million_tokens("tdp_watts", "tokens_per_sec")
    ).select(*keys, "tokens_per_sec", "tdp_watts", "wh_per_million_tokens")


def cloud_gpu_pricing(
    prices: DataFrame, fx_rates: DataFrame | None, accelerators: DataFrame, history: bool = False
) -> DataFrame:
    """Latest price per instance and region in euro, with the accelerator behind it.

    ``accelerators`` is (pattern, accelerator). Without any rate the price is
    kept 1:1; with rates, a day before the first one gives null. Of several rates of
    a day the one ingested last counts, then the smallest. Rates may name their
    currency; those of dollars are used. With ``history`` there is a price for each
    day of capture, which is what the Gold table asks for.
    """
    dated = prices.withColumn("valid_from", F.to_date("captured_at"))
    keys = ["provider", "instance_type", "region", *(["valid_from"] if history else [])]
    # a row per instance and region (and day), read several times from here on
    latest = stage(latest_per_key(dated, keys, "captured_at", ["sku_name", "price_usd_per_hour"]), "latest")
    if fx_rates is None or fx_rates.isEmpty():
        rated = latest.withColumn("eur_usd", F.lit(1.0))
    else:
        until = latest.agg(F.max("valid_from").alias("d")).first()["d"]
        newest = [F.col("_ingestion_timestamp").desc()] if "_ingestion_timestamp" in fx_rates.columns else []
        quoted = fx_rates if "currency" in fx_rates.columns else fx_rates.withColumn("currency", F.lit("USD"))
        daily = deduplicate(
            quoted, ["currency", "observation_date"], [F.col("eur_usd").isNull(), *newest, F.col("eur_usd")]
        )
        calendar = rate_calendar(daily, ["currency"], "observation_date", "eur_usd", until)
        rated = join_rate(
            latest.withColumn("currency", F.lit("USD")), calendar, ["currency"],
            F.col("valid_from"), "observation_date", "eur_usd", "eur_usd",
        )
    named = lookup_pattern(
        rated, accelerators, "instance_type", "pattern", "accelerator", "accelerator"
    )
    return named.select(
        "provider",
        "instance_type",
        "region",
        "accelerator",
        formulas.price_eur_per_hour("price_usd_per_hour", "eur_usd").alias("price_eur_per_hour"),
        "valid_from",
    )


def policy_rates(bronze: DataFrame, names: list[str]) -> DataFrame:
    """Chosen rate series on a complete calendar, with the change of each day."""
    chosen = only_series(bronze, "series", names)
    daily = deduplicate(
        chosen, ["series", "observation_date"], [F.col("_ingestion_timestamp").desc(), F.col("rate_pct")]
    )
    filled = fill_calendar(daily, ["series"], "observation_date", ["rate_pct"])
    return change_bps(filled, ["series"], "observation_date", "rate_pct")


def market_days(bronze: DataFrame) -> DataFrame:
    """Closes of trading days with the daily return; weekends and repeats dropped."""
    weekdays = business_days(bronze, "observation_date").filter("close is not null")
    daily = deduplicate(
        weekdays, ["symbol", "observation_date"], [F.col("_ingestion_timestamp").desc(), F.col("close")]
    ).select("symbol", "observation_date", "close")
    return simple_return(daily, ["symbol"], "observation_date", "close")
