"""The seven questions, in their relational and lakehouse variants.

Windows without a partition run on month-grain frames only (at most one row per calendar month).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from waitflow import schemas as S
from waitflow.functions import calendar
from waitflow.functions.numeric import percent, ratio, steady, zero
from waitflow.plans.marts import NATIONAL, in_months, since, sums


def by_month() -> WindowSpec:
    return Window.orderBy("period_date")


def all_rows() -> WindowSpec:
    return Window.partitionBy()


def change(c: str, months: int = 1, partition: list[str] | None = None) -> Column:
    """Difference to the row `months` rows earlier (row based, like LAG)."""
    w = Window.partitionBy(*partition).orderBy("period_date") if partition else by_month()
    return F.col(c) - F.lag(c, months).over(w)


# Decimals shown for each published column.
DISPLAY_DIGITS = {
    "rolling_12m_avg": 0,
    "referral_to_treatment_ratio": 3,
    "treatment_per_referral_ratio": 3,
    "referral_index_vs_jan2020": 1,
    "referral_index_vs_start": 1,
    "long_waiter_pct": 2,
    "throughput_pct": 1,
    "avg_median_wait_weeks": 1,
    "referral_index_vs_national": 2,
    "breach_rate_pct": 2,
    "referral_recovery_index": 1,
    "treatment_recovery_index": 1,
    "waiting_list_index": 1,
}


def display(df: DataFrame) -> DataFrame:
    """Rounds for presentation; the frames themselves stay unrounded."""
    shown = {c: F.round(c, d) for c, d in DISPLAY_DIGITS.items() if c in df.columns}
    return df.withColumns(shown) if shown else df


def national_trend(national: DataFrame) -> DataFrame:
    last_12 = by_month().rowsBetween(-11, 0)
    return calendar.with_attributes(national, ["financial_year", "is_covid_period"]).select(
        "period_date",
        "financial_year",
        "is_covid_period",
        "total_waiting",
        "total_completed",
        "new_rtt_periods",
        "breach_rate_pct",
        steady(F.avg("total_waiting").over(last_12)).alias("rolling_12m_avg"),
        change("total_waiting").alias("mom_change"),
        change("total_waiting", 12).alias("yoy_change"),
    )


def core_insight(totals: DataFrame, months: DataFrame) -> DataFrame:
    """Referrals against treatments for every month of the calendar or the data, indexed to one month of the frame."""
    named = totals.select(
        F.col("period_date").alias("full_date"),
        F.col("new_rtt_periods").alias("starts"),
        F.col("total_completed").alias("done"),
        F.col("total_waiting").alias("waiting"),
    )
    joined = months.select("full_date").join(named, "full_date", "full_outer")
    base = F.max(F.when(F.col("full_date") == F.lit(S.INDEX_MONTH).cast("date"), F.col("starts"))).over(all_rows())
    starts, done = zero("starts"), zero("done")
    d = F.col("full_date")
    return joined.select(
        "full_date",
        calendar.financial_year(d).alias("financial_year"),
        calendar.is_covid(d).cast("int").alias("is_covid_period"),
        starts.alias("new_referrals"),
        done.alias("total_treated"),
        zero("waiting").alias("total_waiting"),
        (starts - done).alias("net_flow"),
        ratio(starts, done).alias("referral_to_treatment_ratio"),
        percent(F.col("starts"), base).alias("referral_index_vs_jan2020"),
    )


def index_vs_start(national: DataFrame) -> DataFrame:
    whole = by_month().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.first("new_rtt_periods").over(whole)
    return national.select(
        "period_date",
        F.col("new_rtt_periods").alias("new_referrals"),
        F.col("total_completed").alias("total_treated"),
        "total_waiting",
        "net_list_change",
        "treatment_per_referral_ratio",
        percent(F.col("new_rtt_periods"), first).alias("referral_index_vs_start"),
    )


def _long_pct() -> Column:
    return percent(F.col("waiting_over_52wks"), F.col("total_waiting")).alias("long_waiter_pct")


def _breach_pct() -> Column:
    return percent(F.col("waiting_over_18wks"), F.col("total_waiting")).alias("breach_rate_pct")


def _throughput() -> Column:
    return percent(F.col("total_completed"), F.col("new_rtt_periods")).alias("throughput_pct")


def _gap(name: str) -> Column:
    return (F.col("new_rtt_periods") - F.col("total_completed")).alias(name)


def long_waiters(national: DataFrame) -> DataFrame:
    return calendar.with_attributes(national, ["financial_year"]).select(
        "period_date",
        "financial_year",
        "total_waiting",
        "waiting_over_18wks",
        "waiting_over_52wks",
        _long_pct(),
        "breach_rate_pct",
        change("waiting_over_52wks").alias("long_waiters_mom_change"),
    )


def _completed_median() -> Column:
    """Mean over the completed rows (one per pathway) of the group."""
    return steady(F.sum("completed_median_sum") / F.nullif(F.sum("completed_median_n"), F.lit(0)))


def _list_sizes() -> list[Column]:
    """The list is a stock: its months are summed as published, and averaged per month beside it."""
    months = F.countDistinct("period_date")
    return [
        F.sum("total_waiting").alias("sum_waiting"),
        steady(F.sum("total_waiting").cast("double") / months).alias("avg_monthly_waiting"),
    ]


def specialty_pressure(summary: DataFrame) -> DataFrame:
    """Financial year x specialty."""
    key = ["financial_year", "treatment_function_name", "specialty_group"]
    grouped = (
        calendar.with_attributes(summary, ["financial_year"])
        .groupBy(*key)
        .agg(*sums(), *_list_sizes(), _completed_median().alias("avg_median_wait_weeks"))
        .filter("sum_waiting > 0")
    )
    return grouped.select(
        *key,
        "sum_waiting",
        "avg_monthly_waiting",
        F.col("new_rtt_periods").alias("total_new_referrals"),
        F.col("total_completed").alias("total_treated"),
        _gap("cumulative_demand_gap"),
        _throughput(),
        "avg_median_wait_weeks",
        _long_pct(),
    )


def specialty_alltime(summary: DataFrame) -> DataFrame:
    grouped = summary.groupBy("treatment_function_name").agg(*sums()).filter("total_waiting > 0")
    return grouped.select(
        "treatment_function_name",
        "total_waiting",
        F.col("new_rtt_periods").alias("total_referrals"),
        F.col("total_completed").alias("total_treated"),
        _gap("cumulative_demand_gap"),
        _throughput(),
        _long_pct(),
    )


def regional(summary: DataFrame) -> DataFrame:
    """Month x region against the mean region of the same month."""
    grouped = summary.groupBy("period_date", "region_code", "region_name").agg(*sums())
    mean = F.avg("new_rtt_periods").over(Window.partitionBy("period_date"))
    return calendar.with_attributes(grouped, ["financial_year"]).select(
        "period_date",
        "financial_year",
        "region_code",
        "region_name",
        "total_waiting",
        F.col("new_rtt_periods").alias("new_referrals"),
        F.col("total_completed").alias("total_treated"),
        steady(ratio(F.col("new_rtt_periods"), mean)).alias("referral_index_vs_national"),
        _breach_pct(),
        _long_pct(),
    )


def _breach_rank(*group: str) -> Column:
    """RANK by breach rate inside a region. Providers are already grouped: a region has one row for each."""
    return F.rank().over(Window.partitionBy(*group).orderBy(F.desc_nulls_last("breach_rate_pct")))


def trust_scorecard(summary: DataFrame) -> DataFrame:
    """Provider x financial year, ranked by breach rate inside region and year."""
    key = ["provider_org_code", "provider_org_name", "region_name", "financial_year"]
    grouped = (
        calendar.with_attributes(summary, ["financial_year"])
        .groupBy(*key)
        .agg(*sums(), *_list_sizes(), _completed_median().alias("avg_median_wait_weeks"))
        .filter("sum_waiting > 0")
    )
    shown = grouped.select(
        *key,
        "sum_waiting",
        "avg_monthly_waiting",
        "avg_median_wait_weeks",
        _breach_pct(),
        _throughput(),
        _gap("referral_vs_treatment_gap"),
    )
    # A provider without a region is ranked among those without one, as in the all-time table.
    return shown.withColumn("breach_rank_in_region", _breach_rank("region_name", "financial_year"))


def trust_alltime(summary: DataFrame) -> DataFrame:
    key = ["provider_org_code", "provider_org_name", "region_code"]
    grouped = (
        summary.groupBy(*key)
        .agg(*sums(), steady(F.avg("avg_median_wait_weeks")).alias("avg_median_wait_weeks"))
        .filter("total_waiting > 0")
    )
    shown = grouped.select(
        *key,
        "total_waiting",
        "avg_median_wait_weeks",
        _breach_pct(),
        _throughput(),
        _gap("referral_vs_treatment_gap"),
    )
    return shown.withColumn("breach_rank_in_region", _breach_rank("region_code"))


RECOVERY = {
    "referral_recovery_index": "new_rtt_periods",
    "treatment_recovery_index": "total_completed",
    "waiting_list_index": "total_waiting",
}


def _recovery(partition: list[str], base_months: Column) -> list[Column]:
    w = Window.partitionBy(*partition) if partition else all_rows()
    found = []
    for name, c in RECOVERY.items():
        base = F.avg(F.when(base_months, F.col(c))).over(w)
        found.append(steady(percent(F.col(c), base)).alias(name))
    return found


def recovery_regional(totals: DataFrame) -> DataFrame:
    """Month x region against the region's own monthly mean of the baseline year, in one pass."""
    base = F.col("financial_year") == S.BASELINE_FY
    framed = calendar.with_attributes(totals.filter(since()), ["financial_year"])
    return framed.select("period_date", "financial_year", "region_name", *_recovery(["region_name"], base))


def recovery_national(national: DataFrame) -> DataFrame:
    base = in_months(S.BASELINE_START, S.BASELINE_END)
    return national.filter(since()).select(
        "period_date", "total_waiting", "new_rtt_periods", "total_completed", *_recovery([], base)
    )


def suppression_flag(national: DataFrame) -> DataFrame:
    """True where fewer were referred than treated while the list shrank."""
    flow = ratio(F.col("new_rtt_periods"), F.col("total_completed"))
    flagged = national.withColumns({"referral_to_treatment_ratio": flow, "list_change": change("total_waiting")})
    flag = (F.col("referral_to_treatment_ratio") < 1.0) & (F.col("list_change") < 0)
    return flagged.select(
        "period_date",
        "total_waiting",
        "referral_to_treatment_ratio",
        "list_change",
        F.coalesce(flag, F.lit(False)).alias("demand_suppressed"),
    )


def ratio_trend(national: DataFrame) -> DataFrame:
    """Ratio and the direction of its change (-1, 0, 1)."""
    flow = ratio(F.col("new_rtt_periods"), F.col("total_completed"))
    framed = national.select("period_date", flow.alias("referral_to_treatment_ratio"))
    return framed.withColumn("trend", F.signum(change("referral_to_treatment_ratio")).cast("int"))


# Headline periods by financial year or month window.
HEADLINES = ["Pre-COVID", "COVID peak", "Latest year"]


def headline_periods(national: DataFrame) -> DataFrame:
    """Monthly means in the year before, the peak months, and the latest financial year."""
    year = F.col("financial_year")
    framed = calendar.with_attributes(national, ["financial_year"]).withColumn(
        "is_latest", year == F.max(year).over(all_rows())
    )
    before, peak, last = HEADLINES
    labels = F.array_compact(
        F.array(
            F.when(year == S.BASELINE_FY, F.lit(before)),
            F.when(in_months(S.COVID_PEAK_START, S.COVID_PEAK_END), F.lit(peak)),
            F.when(F.col("is_latest"), F.lit(last)),
        )
    )
    grouped = framed.withColumn("headline", F.explode(labels)).groupBy("headline").agg(
        *sums(), F.count(F.lit(1)).alias("n_months")
    )
    mean = {m: steady(F.col(m).cast("double") / F.col("n_months")) for m in NATIONAL}
    return grouped.select(
        "headline",
        "n_months",
        mean["total_waiting"].alias("avg_waiting"),
        mean["new_rtt_periods"].alias("avg_referrals"),
        mean["waiting_over_52wks"].alias("avg_long_waiters"),
        ratio(F.col("new_rtt_periods"), F.col("total_completed")).alias("referral_to_treatment_ratio"),
        _breach_pct(),
    )


def scatter_trust(summary: DataFrame) -> DataFrame:
    """Referral index (to the index month of the same provider) against breach rate."""
    starts = F.col("new_rtt_periods")
    index_month = F.col("period_date") == F.lit(S.INDEX_MONTH).cast("date")
    grouped = summary.groupBy("provider_org_code").agg(
        *sums(),
        F.countDistinct("period_date").alias("n_months"),
        F.sum(F.when(index_month, starts)).alias("index_starts"),
    )
    monthly = starts.cast("double") / F.col("n_months")
    return grouped.select(
        "provider_org_code", steady(percent(monthly, F.col("index_starts"))).alias("referral_index"), _breach_pct()
    )
