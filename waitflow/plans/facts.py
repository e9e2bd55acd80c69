"""Fact frames at month x provider x specialty grain, built from pathway rows or from loaded facts.

Every fact is one aggregate. The state of a percentile holds a count for each of at most 53 wait weeks, and tasks
combine their rows before the shuffle, so a hot key costs one small row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitflow import schemas as S
from waitflow.functions.numeric import steady

GRAIN = ["period_date", "provider_id", "treatment_function_code"]
QUANTILES = {"median": 0.5, "p92": 0.92}


def _patients(condition: str) -> Column:
    return F.expr(f"coalesce(sum(CASE WHEN {condition} THEN patients END), 0L)")


def band_sums(condition: str = "true") -> list[Column]:
    """Twelve sums over the wait week, of pathway rows or of week cells."""
    return [
        _patients(f"{condition} AND wait_week BETWEEN {first} AND {last}").alias(c) for c, _, first, last, *_ in S.BANDS
    ]


def _quantiles(condition: str = "true") -> Column:
    """Median and 92nd percentile of the waits under a condition; NULL where there are none."""
    places = ", ".join(f"{q}D" for q in QUANTILES.values())
    return F.expr(f"percentile(CASE WHEN {condition} THEN wait_week END, array({places}))")


def _quantile(found: str, name: str) -> Column:
    return steady(F.col(found)[list(QUANTILES).index(name)])


_WAITS = {"median_wait_weeks": "median", "percentile_92_wait_weeks": "p92"}


def _with_waits(grouped: DataFrame, kept: list[str]) -> DataFrame:
    return grouped.select(*kept, *[_quantile("_waits", q).alias(n) for n, q in _WAITS.items()])


def incomplete(rows: DataFrame, grain: list[str] = GRAIN) -> DataFrame:
    """Patients still waiting: 12 bands, the total, median and 92nd percentile."""
    total = F.sum("patients").alias("total_waiting")
    found = rows.filter("is_open").groupBy(*grain).agg(*band_sums(), total, _quantiles().alias("_waits"))
    return _with_waits(found, [*grain, *S.BAND_COLUMNS, "total_waiting"])


def completed(rows: DataFrame, grain: list[str] = GRAIN) -> DataFrame:
    """Treated patients per pathway: total, median and 92nd percentile."""
    pathway = F.when(F.col("is_admitted"), S.ADMITTED).otherwise(S.NON_ADMITTED)
    key = [*grain, "pathway_type"]
    done = rows.filter("is_done").withColumn("pathway_type", pathway).groupBy(*key)
    found = done.agg(F.sum("patients").alias("total_completed"), _quantiles().alias("_waits"))
    return _with_waits(found, [*key, "total_completed"])


def new_periods(rows: DataFrame, grain: list[str] = GRAIN) -> DataFrame:
    """Clock starts: one per pathway row."""
    return rows.groupBy(*grain).agg(F.count(F.lit(1)).alias("new_rtt_periods"))


_CLASSES = {"waiting": "is_open", "admitted": "is_done AND is_admitted", "other": "is_done AND NOT is_admitted"}


def _activity_sums() -> list[Column]:
    return [
        F.expr("count(CASE WHEN is_open THEN 1 END) AS n_incomplete"),
        _patients("is_open").alias("total_waiting"),
        _patients(f"is_open AND wait_week >= {S.BREACH_WEEK}").alias("waiting_over_18wks"),
        _patients(f"is_open AND wait_week >= {S.LONG_WEEK}").alias("waiting_over_52wks"),
        F.expr("count(CASE WHEN is_done THEN 1 END) AS n_completed"),
        _patients("is_done AND is_admitted").alias("completed_admitted"),
        _patients("is_done AND NOT is_admitted").alias("completed_non_admitted"),
        _patients("is_done").alias("total_completed"),
        F.expr("count(1) AS n_new"),
        F.expr("count(1) AS new_rtt_periods"),
    ]


def activity(rows: DataFrame, grain: list[str] = GRAIN, waits: bool = False) -> DataFrame:
    """All three facts side by side from one scan; nothing is joined, so nothing can fan out.

    One shuffle does it, and Catalyst drops the sums a query does not use. With waits the medians and percentiles of
    each class of rows are added.
    """
    if not waits:
        return rows.groupBy(*grain).agg(*_activity_sums())
    found = rows.groupBy(*grain).agg(*_activity_sums(), *[_quantiles(c).alias(f"_{n}") for n, c in _CLASSES.items()])
    added = {}
    for name in QUANTILES:
        parts = [_quantile(f"_{c}", name) for c in ("admitted", "other")]
        added[f"waiting_{name}"] = _quantile("_waiting", name)
        added[f"completed_{name}_sum"] = steady(sum((F.coalesce(p, F.lit(0.0)) for p in parts), F.lit(0.0)))
        added[f"completed_{name}_n"] = sum((p.isNotNull().cast("int") for p in parts), F.lit(0))
    plain = [c for c in found.columns if not c.startswith("_")]
    return found.select(*plain, *[c.alias(n) for n, c in added.items()])


ACTIVITY_COUNTS = [
    "n_incomplete",
    "total_waiting",
    "waiting_over_18wks",
    "waiting_over_52wks",
    "n_completed",
    "completed_admitted",
    "completed_non_admitted",
    "total_completed",
    "n_new",
    "new_rtt_periods",
    "completed_median_sum",
    "completed_median_n",
    "completed_p92_sum",
    "completed_p92_n",
]


def activity_from_facts(
    inc: DataFrame, done: DataFrame, new: DataFrame, grain: list[str] = S.CELL_KEY
) -> DataFrame:
    """The same frame from three loaded fact tables.

    The facts are stacked and aggregated once instead of joined twice: each row is counted exactly once
    however many bands, pathways or duplicates a key has, and only one shuffle is needed.
    """
    breach = sum(F.col(c) for c in S.BREACH_COLUMNS)
    waiting = inc.select(
        *grain,
        F.lit(1).alias("n_incomplete"),
        "total_waiting",
        breach.alias("waiting_over_18wks"),
        F.col(S.LONG_COLUMN).alias("waiting_over_52wks"),
        F.col("median_wait_weeks").alias("waiting_median"),
        F.col("percentile_92_wait_weeks").alias("waiting_p92"),
    )
    by_pathway = {"completed_admitted": S.ADMITTED, "completed_non_admitted": S.NON_ADMITTED}
    treated = done.select(
        *grain,
        F.lit(1).alias("n_completed"),
        "total_completed",
        *[F.when(F.col("pathway_type") == p, F.col("total_completed")).alias(c) for c, p in by_pathway.items()],
        F.col("median_wait_weeks").alias("completed_median_sum"),
        F.col("median_wait_weeks").isNotNull().cast("int").alias("completed_median_n"),
        F.col("percentile_92_wait_weeks").alias("completed_p92_sum"),
        F.col("percentile_92_wait_weeks").isNotNull().cast("int").alias("completed_p92_n"),
    )
    starts = new.select(*grain, F.lit(1).alias("n_new"), "new_rtt_periods")
    stacked = waiting.unionByName(treated, allowMissingColumns=True).unionByName(starts, allowMissingColumns=True)
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ACTIVITY_COUNTS]
    means = [F.avg(c).alias(c) for c in ("waiting_median", "waiting_p92")]
    return stacked.groupBy(*grain).agg(*sums, *means)


def banded(inc: DataFrame, ids: list[str]) -> DataFrame:
    """Twelve band columns to rows in one pass, empty cells dropped."""
    labels = [F.when(F.col("band_column") == c, F.lit(label)) for c, label in S.BAND_LABELS.items()]
    return (
        inc.unpivot(ids, S.BAND_COLUMNS, "band_column", "patients_waiting")
        .filter("patients_waiting > 0")
        .select(*ids, F.coalesce(*labels).alias("band_label"), "patients_waiting")
    )


def pivot_pathways(done: DataFrame, ids: list[str]) -> DataFrame:
    """One row per key with admitted and non-admitted side by side."""
    is_admitted = F.col("pathway_type") == S.ADMITTED
    is_other = F.col("pathway_type") == S.NON_ADMITTED
    count = F.col("total_completed")
    return (
        done.groupBy(*ids)
        .agg(
            F.sum(F.when(is_admitted, count).otherwise(0)).alias("completed_admitted"),
            F.sum(F.when(is_other, count).otherwise(0)).alias("completed_non_admitted"),
            F.avg("median_wait_weeks").alias("median_wait_weeks"),
            steady(F.avg("percentile_92_wait_weeks")).alias("percentile_92_wait_weeks"),
        )
        .withColumn("total_completed", F.col("completed_admitted") + F.col("completed_non_admitted"))
    )
