import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from waitflow.data import Data
from waitflow.plans import explore, kpis, marts, measures, notebook, patterns, quality

FIELDS = "period_date date, region_name string, total_waiting long, waiting_over_18wks long, waiting_over_52wks long, completed_admitted long, completed_non_admitted long, total_completed long, new_rtt_periods long"


def month(n):
    return dt.date(2019 + (n + 3) // 12, (n + 3) % 12 + 1, 1)


def frame(spark, *items):
    """(month number from April 2019, region, waiting, over 18, over 52, treated, referred)."""
    rows = [(month(n), r, w, a, b, t, 0, t, s) for n, r, w, a, b, t, s in items]
    return spark.createDataFrame(rows, FIELDS)


def by_month(df, column):
    return {r["period_date"]: r[column] for r in df.collect()}


def test_row_lag_and_calendar_shift_differ_on_a_gap(spark):
    df = frame(spark, (0, "N", 10, 0, 0, 1, 1), (1, "N", 12, 0, 0, 1, 1), (3, "N", 20, 0, 0, 1, 1))
    rows = by_month(kpis.national_trend(marts.national_monthly(df)), "mom_change")
    shifted = by_month(measures.waiting_mom(df, []), "waiting_mom_change")
    assert rows[month(3)] == 8 and shifted[month(3)] is None
    assert rows[month(1)] == shifted[month(1)] == 2
    blank = by_month(measures.waiting_mom(df, [], blank_as_zero=True), "waiting_mom_change")
    assert blank[month(0)] == 10 and blank[month(3)] == 20


def test_yoy_percent(spark):
    df = frame(spark, (0, "N", 10, 0, 0, 1, 1), (12, "N", 15, 0, 0, 1, 1))
    got = measures.waiting_yoy(df, ["region_name"])
    assert by_month(got, "waiting_yoy_change")[month(12)] == 5
    assert by_month(got, "waiting_yoy_pct")[month(12)] == 50.0


def test_rolling_uses_calendar_months_present(spark):
    df = frame(spark, (0, "N", 10, 0, 0, 1, 1), (2, "N", 20, 0, 0, 1, 1), (3, "N", 40, 0, 0, 1, 1))
    got = by_month(measures.rolling(df, [], "total_waiting", 3, "v"), "v")
    assert got == {month(0): 10.0, month(2): 15.0, month(3): 30.0}


def test_fytd_restarts_in_april(spark):
    df = frame(spark, (10, "N", 1, 0, 0, 5, 1), (11, "N", 1, 0, 0, 7, 1), (12, "N", 1, 0, 0, 2, 1))
    got = by_month(measures.fytd_treated(df, []), "fytd_treated")
    assert got == {month(10): 5, month(11): 12, month(12): 2}


def test_zero_denominators(spark):
    df = frame(spark, (0, "N", 0, 0, 0, 0, 0))
    assert measures.rates(df, []).first()["breach_rate_pct"] == 0.0
    assert measures.ratio_flow(df, []).first()["referral_to_treatment_ratio"] is None
    assert marts.national_monthly(df).first()["treatment_per_referral_ratio"] is None
    totals = df.select("period_date", "total_waiting", "total_completed", "new_rtt_periods")
    assert notebook.national(totals).first()["rtt_ratio"] == 1.0


def test_suppression_needs_both_conditions(spark):
    df = frame(
        spark,
        (0, "N", 10, 0, 0, 5, 1),
        (1, "N", 8, 0, 0, 5, 1),
        (2, "N", 9, 0, 0, 5, 1),
        (3, "N", 5, 0, 0, 1, 5),
    )
    got = by_month(kpis.suppression_flag(marts.national_monthly(df)), "demand_suppressed")
    assert list(got.values()) == [False, True, False, False]


def test_regional_index_and_national_difference(spark):
    df = frame(spark, (0, "N", 10, 5, 1, 1, 30), (0, "S", 10, 1, 1, 1, 10))
    index = {r["region_name"]: r["regional_referral_index"] for r in measures.regional_index(df, ["period_date", "region_name"]).collect()}
    assert index == {"N": 1.5, "S": 0.5}
    diff = {r["region_name"]: r["vs_national_breach_rate"] for r in measures.vs_national_breach(df, ["period_date", "region_name"]).collect()}
    assert diff["N"] == pytest.approx(20.0) and diff["S"] == pytest.approx(-20.0)


def test_peak_month_tie_takes_the_earliest(spark):
    df = frame(spark, (0, "N", 1, 0, 4, 1, 1), (1, "N", 1, 0, 9, 1, 1), (2, "N", 1, 0, 9, 1, 1))
    got = explore.peak_month(marts.national_monthly(df)).first()
    assert (got["peak_month"], got["peak_value"]) == (month(1), 9)


def test_recovery_is_100_at_baseline(spark):
    items = [(n, "N", 10, 1, 1, 20, 30) for n in range(12)] + [(12, "N", 20, 1, 1, 10, 30)]
    got = kpis.recovery_national(marts.national_monthly(frame(spark, *items)))
    last = got.filter(F.col("period_date") == F.lit(month(12))).first()
    assert (last["waiting_list_index"], last["treatment_recovery_index"], last["referral_recovery_index"]) == (200.0, 50.0, 100.0)


def test_core_insight_fills_months_without_data(spark):
    totals = frame(spark, (9, "N", 10, 0, 0, 5, 4)).select("period_date", "total_waiting", "total_completed", "new_rtt_periods")
    got = kpis.core_insight(totals, Data(spark, SMALL).dim_date())
    assert got.count() == 132
    row = got.filter("full_date = DATE'2020-01-01'").first()
    assert (row["referral_index_vs_jan2020"], row["net_flow"]) == (100.0, -1)
    empty = got.filter("full_date = DATE'2015-01-01'").first()
    assert empty["new_referrals"] == 0 and empty["referral_index_vs_jan2020"] is None


def test_full_outer_alignment_keeps_every_month(spark):
    one = lambda n, c: spark.createDataFrame([(month(n), 1)], f"period_date date, {c} long")
    got = marts.align_series(one(0, "a"), one(1, "b"), one(2, "c"))
    assert got.count() == 3


def test_display_rounds_like_the_reports(spark):
    df = spark.createDataFrame([(12.345, 1.23456)], "breach_rate_pct double, referral_to_treatment_ratio double")
    row = kpis.display(df).first()
    assert tuple(row) == (12.35, 1.235)


def test_slicers_combine(spark):
    d = Data(spark, SMALL)
    everything = d.labelled_summary()
    got = explore.slice_by(everything, region="ASIA", group="Medical", covid=False, financial_years=["2022/23"])
    assert {r["region_name"] for r in got.select("region_name").distinct().collect()} <= {"ASIA"}
    assert explore.slice_by(everything).count() == everything.count()


def test_waterfall_parts_add_up(spark):
    rows = explore.waterfall(Data(spark, SMALL).specialty_summary()).collect()
    assert all(r["added"] >= 0 >= r["cleared"] for r in rows if r["added"] is not None)


def test_scorecard_ranks_start_at_one(spark):
    got = kpis.trust_scorecard(Data(spark, SMALL).labelled_summary(waits=True))
    best = got.groupBy("region_name", "financial_year").agg(F.min("breach_rank_in_region").alias("r"))
    assert best.filter("r <> 1").isEmpty()


def test_summary_blocks(spark):
    got = notebook.summary(notebook.national(Data(spark, SMALL).month_totals()))
    assert {r["block"] for r in got.collect()} == set(notebook.BLOCKS)
    shown = notebook.summary_formatted(got).first()
    assert "," not in shown["rtt_ratio"] and len(shown["rtt_ratio"].split(".")[1]) == 3


def test_missing_keys_are_counted(spark):
    a = spark.createDataFrame([(1, None), (None, 2)], "date_key int, trust_key int")
    row = quality.missing_keys({"a": a.withColumn("region_key", F.lit(1)), "b": a}).filter("table_name = 'a'").first()
    assert (row["missing_date_key"], row["missing_trust_key"], row["missing_region_key"]) == (1, 1, 0)
    assert row["missing_wait_band_key"] is None


def test_negative_null_and_duplicate_reports(spark):
    df = spark.createDataFrame([(-1, "a"), (2, "a"), (None, None)], "n int, c string")
    assert {tuple(r) for r in quality.negatives(df, ["n"]).collect()} == {("n", 1)}
    assert {tuple(r) for r in quality.not_null(df, ["n", "c"]).collect()} == {("n", 1), ("c", 1)}
    assert quality.duplicate_codes({"d": (df, "c")}).first()["n_duplicated"] == 1


def test_breach_analysis_order(spark):
    d = spark.createDataFrame(
        [("2019/20", "R", "T", "19-23 weeks", 1, 0, 5), ("2019/20", "R", "T", "52+ weeks", 1, 1, 9), ("2019/20", "R", "T", "0-5 weeks", 0, 0, 99)],
        "financial_year string, region_name string, treatment_function_name string, band_label string, is_breach int, is_long_waiter int, patients_waiting long",
    )
    assert [r["band_label"] for r in patterns.breach_analysis(d, 1).collect()] == ["52+ weeks"]
