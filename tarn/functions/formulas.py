"""Unit formulas of the energy and cost tables, as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wh_per_million_tokens(tdp_watts: Column | str, tokens_per_sec: Column | str) -> Column:
    return F.try_divide(_col(tdp_watts), _col(tokens_per_sec)) / F.lit(3600.0) * F.lit(1e6)


def tokens_per_hour(tokens_per_sec: Column | str) -> Column:
    return _col(tokens_per_sec) * F.lit(3600.0)


def eur_per_million_tokens(
    price_eur_per_hour: Column | str, tokens_per_hour_: Column | str
) -> Column:
    return F.try_divide(_col(price_eur_per_hour), _col(tokens_per_hour_)) * F.lit(1e6)


def gco2_per_million_tokens(
    carbon_intensity_gco2_kwh: Column | str, wh_per_million_tokens_: Column | str
) -> Column:
    return _col(carbon_intensity_gco2_kwh) * _col(wh_per_million_tokens_) / F.lit(1000.0)


def price_eur_per_hour(price_usd_per_hour: Column | str, eur_usd: Column | str) -> Column:
    """``eur_usd`` is dollars per euro, so a dollar price is divided by it."""
    return F.try_divide(_col(price_usd_per_hour), _col(eur_usd))
