"""The ways taken beyond the bounds give the same rows: nothing broadcast, short segments, narrow ranges."""

import pytest
from compare import difference

from tarn.functions import skew
from tarn.operators import scans

NAMES = [
    "join1_dimension_lookup",
    "join2_attribute_by_name",
    "join3_longest_pattern",
    "join4_rate_by_day",
    "join5_hourly_cost",
    "silver1_carbon_intensity",
    "silver3_instance_pricing",
    "win9_time_folds",
    "agg13_quantiles_whole_table",
    "win10_robust_spikes",
]


@pytest.mark.parametrize("name", NAMES)
def test_without_broadcasts(spark, sf, name, monkeypatch):
    monkeypatch.setattr(skew, "fits_broadcast", lambda *args, **kw: False)
    assert difference(spark, sf, name) is None


@pytest.mark.parametrize("name", ["win10_spikes", "agg_sessions", "win1_carry_forward_rows", "join4_asof_exact"])
def test_with_short_segments(spark, sf, name, monkeypatch):
    whole_segment = scans.time_segment

    def short(df, keys, ts, rows=0):
        return whole_segment(df, keys, ts, rows=3)

    for module in ("tarn.operators.series", "tarn.operators.aggregates", "tarn.operators.joins", "tarn.operators.scans"):
        monkeypatch.setattr(f"{module}.time_segment", short)
    assert difference(spark, sf, name) is None
