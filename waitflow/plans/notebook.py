"""The exploratory analysis: national series, regimes, summary blocks and top specialties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitflow import schemas as S
from waitflow.functions import calendar
from waitflow.functions.numeric import percent, ratio, steady
from waitflow.plans.kpis import all_rows
from waitflow.plans.marts import in_months


def national(totals: DataFrame) -> DataFrame:
    """Every month of any series; missing series stay NULL, a missing ratio becomes 1.0."""
    base = in_months(S.BASELINE_START, S.NOTEBOOK_BASELINE_END)
    starts, done = F.col("new_rtt_periods"), F.col("total_treated")

    def indexed(c: Column) -> Column:
        return steady(percent(c, F.avg(F.when(base, c)).over(all_rows())))

    named = totals.withColumnsRenamed({"total_waiting": "patients_waiting", "total_completed": "total_treated"})
    return named.select(
        "period_date",
        "patients_waiting",
        "total_treated",
        "new_rtt_periods",
        calendar.is_covid(F.col("period_date")).alias("is_covid"),
        ratio(starts, done, alternate=1.0).alias("rtt_ratio"),
        (starts - done).alias("net_flow"),
        indexed(starts).alias("referral_index"),
        indexed(done).alias("treatment_index"),
    )


def ratio_regime(series: DataFrame) -> DataFrame:
    r = F.col("rtt_ratio")
    regime = F.when(r < 1.0, "more treated than referred").when(r > 1.0, "list growing").otherwise("level")
    return series.select("period_date", "rtt_ratio", regime.alias("regime"))


def covid_bounds(series: DataFrame) -> DataFrame:
    month = F.when(F.col("is_covid"), F.col("period_date"))
    return series.agg(F.min(month).alias("covid_start"), F.max(month).alias("covid_end"))


# Block labels.
BLOCKS = ["Pre-COVID (FY 2019/20)", "COVID peak (Apr-Jun 2020)", "Latest (6-month avg)"]
SUMMARY = {
    "new_referrals_per_month": "new_rtt_periods",
    "treatments_per_month": "total_treated",
    "waiting_list": "patients_waiting",
    "rtt_ratio": "rtt_ratio",
}


def summary(series: DataFrame) -> DataFrame:
    """Mean month of three blocks, one row each. The series has one row per month, so the six latest months
    are found by a window over it and every block comes from one pass."""
    latest = F.row_number().over(all_rows().orderBy(F.desc("period_date"))) <= 6
    inside = [
        in_months(S.BASELINE_START, S.NOTEBOOK_BASELINE_END),
        in_months(S.COVID_PEAK_START, S.COVID_PEAK_END),
        F.col("is_latest"),
    ]
    labels = F.array_compact(F.array(*[F.when(c, F.lit(b)) for b, c in zip(BLOCKS, inside)]))
    rows = series.withColumn("is_latest", latest).withColumn("block", F.explode(labels))
    return rows.groupBy("block").agg(*[steady(F.avg(c)).alias(n) for n, c in SUMMARY.items()])


def summary_formatted(summary_frame: DataFrame) -> DataFrame:
    whole = [n for n in SUMMARY if n != "rtt_ratio"]
    shown = [F.format_number(n, 0).alias(n) for n in whole]
    return summary_frame.select("block", *shown, F.format_string("%.3f", "rtt_ratio").alias("rtt_ratio"))


def latest_cells(cells: DataFrame, by: list[str]) -> DataFrame:
    """Cells of the last month, from one pass over what they are built from.

    Every key keeps its newest cell first. The last month is then taken from that same frame: the newest cell is one
    value, so both uses need the same shuffle and Spark runs it once.
    """
    values = [c for c in cells.columns if c not in by and c != "period_date"]
    newest = cells.groupBy(*by).agg(F.max(F.struct("period_date", *values)).alias("_newest"))
    last = newest.agg(F.max("_newest.period_date").alias("m")).scalar()
    return newest.filter(F.col("_newest.period_date") == last).select(*by, "_newest.*")


def latest_of(grouped: DataFrame) -> DataFrame:
    """The same for a frame already grouped to few rows per month: one pass, no second scan."""
    framed = grouped.withColumn("_latest", F.max("period_date").over(all_rows()))
    return framed.filter("period_date = _latest").drop("_latest")


def top_specialties(df: DataFrame, measure: str, rows: int) -> DataFrame:
    """Largest specialties by a summed measure; the name settles ties."""
    grouped = df.groupBy("treatment_function_name").agg(F.sum(measure).alias(measure))
    return grouped.orderBy(F.desc(measure), "treatment_function_name").limit(rows)
