"""Every query against its SQL on the smallest tables, and its plan for joins of all pairs."""

from pathlib import Path

import pytest

from checks.compare import compare, oracle_connection
from checks.registry import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF, name).startswith("ok")


@pytest.mark.parametrize("name", ["fact_offers", "flag_duplicates", "idw_impute", "surrogate_key", "city_median", "nearest_poi", "asof_demography", "interval_periods", "snapshot_changes"])
def test_no_join_of_all_pairs(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
