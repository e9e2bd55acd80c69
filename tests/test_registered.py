import pytest

import check_oracle
from tests.conftest import SMALL
from waitflow.oracle import ORACLES
from waitflow.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert check_oracle.compare(spark, con, SMALL, name) == ""


def test_no_python_workers_in_plans(spark):
    for name in ("q1_national_trend", "silver_incomplete", "star_incomplete", "ingest_preamble"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Cartesian" not in plan


def test_scan_reads_only_needed_columns_and_pushes_filters(spark):
    plan = QUERIES["period_coverage"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "l_partkey" not in plan
    assert "EqualTo(l_linestatus,O)" in plan
