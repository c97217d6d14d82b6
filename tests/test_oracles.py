"""Every bound query against its oracle SQL, values compared exactly."""

import pytest
from compare import difference

from tarn.plans.bindings import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, sf, name):
    assert difference(spark, sf, name) is None


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(ORACLES) > 100


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert not entry.entry(spark).isEmpty()
