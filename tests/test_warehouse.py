from pyspark.sql import functions as F

from tests.conftest import SMALL
from waitflow import warehouse
from waitflow.data import Data


def test_stored_tables_answer_sql(spark, tmp_path):
    out = str(tmp_path / "warehouse")
    warehouse.build(spark, SMALL, out)
    views = warehouse.open_views(spark, out)
    assert {n for n, v in views.items() if v.isEmpty()} == set()

    d = Data(spark, SMALL)
    stored = spark.table("v_national_monthly").select("period_date", "total_waiting")
    fresh = d.national().select(*stored.columns)
    assert stored.exceptAll(fresh).isEmpty() and fresh.exceptAll(stored).isEmpty()

    long_waiters = spark.sql(
        "SELECT sum(waiting_count) AS n FROM fact_rtt_wait_band_star WHERE is_long_waiter = 1 AND trust_key IS NOT NULL"
    )
    assert long_waiters.first().n == d.activity().agg(F.sum("waiting_over_52wks")).first()[0]

    pruned = views["fact_rtt_incomplete_star"].filter("financial_year = '2021/22'")
    assert "PartitionFilters: [isnotnull(financial_year" in pruned._jdf.queryExecution().executedPlan().toString()
