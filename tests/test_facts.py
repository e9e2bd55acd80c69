import datetime as dt
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from waitflow import schemas as S
from waitflow.data import Data
from waitflow.plans import dims, facts, kpis, marts, stars

M = dt.date(2020, 1, 1)
ROWS = "period_date date, provider_id long, treatment_function_code string, wait_week int, patients int, is_open boolean, is_done boolean, is_admitted boolean"


def rows(spark, *items):
    return spark.createDataFrame([(M, 1, "T", *i) for i in items], ROWS)


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(7)
    weeks = [[int(w) for w in rng.integers(0, 53, n)] for n in (1, 2, 3, 10, 57)]
    data = [(M, i, "T", w, 1, True, False, False) for i, ws in enumerate(weeks) for w in ws]
    found = facts.incomplete(spark.createDataFrame(data, ROWS)).orderBy("provider_id").collect()
    for r, ws in zip(found, weeks):
        assert r["median_wait_weeks"] == statistics.median(ws)
        assert r["percentile_92_wait_weeks"] == pytest.approx(np.percentile(ws, 92), abs=1e-6)


def test_activity_with_and_without_waits_agree(spark):
    base = Data(spark, SMALL).rows()
    plain, waits = facts.activity(base), facts.activity(base, waits=True).select(*facts.activity(base).columns)
    assert plain.exceptAll(waits).isEmpty() and waits.exceptAll(plain).isEmpty()


def test_no_fan_out(spark):
    """Three bands, two pathways and one new row per key: each count appears once."""
    df = rows(
        spark,
        (1, 10, True, False, False),
        (20, 5, True, False, False),
        (52, 2, True, False, False),
        (3, 7, False, True, True),
        (4, 4, False, True, False),
    )
    got = facts.activity(df, waits=True).first()
    assert (got["total_waiting"], got["waiting_over_18wks"], got["waiting_over_52wks"]) == (17, 7, 2)
    assert (got["completed_admitted"], got["completed_non_admitted"], got["total_completed"]) == (7, 4, 11)
    assert got["new_rtt_periods"] == 5
    assert (got["completed_median_sum"], got["completed_median_n"]) == (7.0, 2)


def test_activity_from_facts_equals_one_pass(spark):
    d = Data(spark, SMALL)
    one = marts.monthly_summary(d.coded(d.activity(waits=True)))
    other = marts.monthly_summary(facts.activity_from_facts(d.incomplete(), d.completed(), d.new_periods()))
    names = [*S.CELL_KEY, *marts.MEASURES, "avg_median_wait_weeks", "avg_p92_wait_weeks"]
    assert one.select(*names).exceptAll(other.select(*names)).isEmpty()
    assert one.count() == other.count()


def test_unpivot_keeps_totals_and_drops_empty_cells(spark):
    inc = Data(spark, SMALL).incomplete()
    long = facts.banded(inc, S.CELL_KEY)
    assert long.filter("patients_waiting <= 0").isEmpty()
    total = inc.agg(F.sum("total_waiting")).first()[0]
    assert long.agg(F.sum("patients_waiting")).first()[0] == total
    back = long.groupBy(*S.CELL_KEY).agg(F.sum("patients_waiting").alias("total_waiting"))
    assert inc.select(*back.columns).exceptAll(back).isEmpty()


def test_left_join_keeps_and_inner_join_drops_unresolved_rows(spark):
    d = Data(spark, SMALL)
    inc = d.incomplete()
    some = d.dim_trust().filter("trust_key <= 3")
    dimensions = {**d.dimensions(), "dim_trust": some}
    kept = stars.star_incomplete(inc, dimensions)
    assert kept.count() == inc.count()
    assert kept.filter("trust_key IS NULL").count() > 0
    loaded = stars.load_new_periods(d.new_periods(), some, d.dim_treatment_function())
    assert 0 < loaded.count() < d.new_periods().count()


def test_union_pathways_drops_unreadable_dates(spark):
    admitted = spark.createDataFrame([("2020-01-01", 1), ("Unknown", 2)], "period_date string, n int")
    other = spark.createDataFrame([("January 2020", 3), (None, 4)], "period_date string, n int")
    got = stars.union_pathways(admitted, other).orderBy("n").collect()
    assert [(r["n"], r["pathway_type"], r["period_date"]) for r in got] == [(1, "Admitted", M), (3, "Non-Admitted", M)]


def test_dense_grid_size_and_fill(spark):
    d = Data(spark, SMALL)
    dense = marts.dense_monthly(
        d.activity(waits=True), d.provider_ids(), d.specialties(), "2019-01-01", "2020-12-01"
    )
    specialties = d.specialties().count()
    assert dense.count() == 24 * d.provider_ids().count() * specialties
    assert dense.filter("total_waiting IS NULL").isEmpty()
    inside = d.activity().filter(marts.in_months("2019-01-01", "2020-12-01"))
    assert dense.agg(F.sum("total_waiting")).first()[0] == inside.agg(F.sum("total_waiting")).first()[0]


def test_provider_without_region_is_ranked(spark):
    columns = "provider_org_code string, provider_org_name string, region_code string, region_name string, period_date date"
    measures = ["total_waiting", "waiting_over_18wks", "waiting_over_52wks", "completed_admitted", "completed_non_admitted", "total_completed", "new_rtt_periods"]
    rows = [("A", "a", "R1", "r1", 9), ("B", "b", "R1", "r1", 5), ("C", "c", None, None, 3), ("D", "d", None, None, 4)]
    frame = spark.createDataFrame([(*r[:4], M) for r in rows], columns).join(
        spark.createDataFrame([(r[0], r[4]) for r in rows], "provider_org_code string, over long"), "provider_org_code"
    )
    frame = frame.withColumns({m: F.lit(10).cast("long") for m in measures} | {"avg_median_wait_weeks": F.lit(1.0)})
    frame = frame.withColumn("waiting_over_18wks", F.col("over")).drop("over")
    got = {r.provider_org_code: r.breach_rank_in_region for r in kpis.trust_alltime(frame).collect()}
    assert got == {"A": 1, "B": 2, "C": 2, "D": 1}


def test_months_after_the_seed_calendar_are_kept(spark):
    d = Data(spark, SMALL)
    late = d.incomplete().withColumn("period_date", F.add_months("period_date", 240))
    star = stars.star_wait_band(late, {**d.dimensions(), "dim_wait_band": dims.dim_wait_band(spark)})
    assert star.agg(F.sum("waiting_count")).first()[0] == late.agg(F.sum("total_waiting")).first()[0]
    totals = late.groupBy("period_date").agg(F.sum("total_waiting").alias("total_waiting")).withColumns(
        {"new_rtt_periods": F.lit(1), "total_completed": F.lit(1)}
    )
    insight = kpis.core_insight(totals, dims.standard_dim_date(spark))
    assert insight.agg(F.sum("total_waiting")).first()[0] == late.agg(F.sum("total_waiting")).first()[0]


def test_mart_totals_equal_fact_totals(spark):
    d = Data(spark, SMALL)
    national = d.national().agg(F.sum("total_waiting")).first()[0]
    assert national == d.incomplete().agg(F.sum("total_waiting")).first()[0]


def test_wait_band_flags(spark):
    d = Data(spark, SMALL)
    got = stars.star_wait_band(d.incomplete(), {**d.dimensions(), "dim_wait_band": dims.dim_wait_band(spark)})
    breach = got.agg(F.sum(F.col("waiting_count") * F.col("is_breach"))).first()[0]
    assert breach == d.activity().agg(F.sum("waiting_over_18wks")).first()[0]
