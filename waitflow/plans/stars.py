"""Key resolution: natural keys to surrogate keys, in both flavours.

`load_*` follows the relational track (inner joins, unresolved rows drop); `star_*` follows the lakehouse
track (left joins, unresolved rows stay with NULL keys). The date key is computed from the month in both, so
no calendar can be too short. The bands (12) have a fixed size and are broadcast by hint; the other dimensions
grow with the data and are left to Spark's size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitflow import schemas as S
from waitflow.functions import calendar
from waitflow.functions.text import parse_period
from waitflow.plans.facts import banded, pivot_pathways


def _trusts(dim_trust: DataFrame) -> DataFrame:
    return dim_trust.select(F.col("trust_code").alias("provider_org_code"), "trust_key", "region_key")


def _functions(dim_tf: DataFrame) -> DataFrame:
    return dim_tf.select("treatment_function_code", "treatment_function_key")


def _bands(dim_band: DataFrame) -> DataFrame:
    return F.broadcast(dim_band.select("wait_band_key", "band_label", "is_breach", "is_long_waiter"))


def _resolve(facts: DataFrame, dim_trust: DataFrame, dim_tf: DataFrame, how: str) -> DataFrame:
    return facts.join(_functions(dim_tf), "treatment_function_code", how).join(
        _trusts(dim_trust), "provider_org_code", how
    )


LOAD_KEY = ["date_key", "trust_key", "treatment_function_key"]


def load_incomplete(facts: DataFrame, dim_trust: DataFrame, dim_tf: DataFrame, dim_band: DataFrame) -> DataFrame:
    """Month x trust x specialty x band with patients; keys resolve before the rows are multiplied."""
    keyed = _resolve(facts, dim_trust, dim_tf, "inner").withColumn(
        "date_key", calendar.date_key(F.col("period_date"))
    )
    rows = banded(keyed, LOAD_KEY).join(_bands(dim_band), "band_label")
    return rows.select(*LOAD_KEY, "wait_band_key", "patients_waiting")


def load_completed(facts: DataFrame, dim_trust: DataFrame, dim_tf: DataFrame) -> DataFrame:
    """Admitted and non-admitted side by side with the stored total."""
    wide = pivot_pathways(facts, S.CELL_KEY)
    return _resolve(wide, dim_trust, dim_tf, "inner").select(
        calendar.date_key(F.col("period_date")).alias("date_key"),
        "trust_key",
        "treatment_function_key",
        "completed_admitted",
        "completed_non_admitted",
        "total_completed",
        "median_wait_weeks",
        "percentile_92_wait_weeks",
    )


def load_new_periods(facts: DataFrame, dim_trust: DataFrame, dim_tf: DataFrame) -> DataFrame:
    return _resolve(facts.filter("new_rtt_periods > 0"), dim_trust, dim_tf, "inner").select(
        calendar.date_key(F.col("period_date")).alias("date_key"),
        "trust_key",
        "treatment_function_key",
        "new_rtt_periods",
    )


def batch(staged: DataFrame, batch_id: str) -> DataFrame:
    """Rows of one load; a staging table partitioned by load_batch_id is pruned to that partition."""
    return staged.filter(F.col("load_batch_id") == batch_id)


STAR_KEYS = ["date_key", "trust_key", "region_key", "treatment_function_key"]


def _star(facts: DataFrame, dims: dict[str, DataFrame], measures: list[str]) -> DataFrame:
    natural = S.CELL_KEY + (["source_file"] if "source_file" in facts.columns else [])
    resolved = _resolve(facts, dims["dim_trust"], dims["dim_treatment_function"], "left").withColumn(
        "date_key", calendar.date_key(F.col("period_date"))
    )
    return resolved.select(*STAR_KEYS, *measures, *natural)


WAITS = ["median_wait_weeks", "percentile_92_wait_weeks"]


def star_incomplete(facts: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return _star(facts, dims, ["total_waiting", *WAITS, *S.BAND_COLUMNS])


def union_pathways(admitted: DataFrame, non_admitted: DataFrame) -> DataFrame:
    """Both pathway tables as one, tagged, rows without a readable date dropped."""
    tagged = admitted.withColumn("pathway_type", F.lit(S.ADMITTED)).unionByName(
        non_admitted.withColumn("pathway_type", F.lit(S.NON_ADMITTED))
    )
    return tagged.withColumn("period_date", parse_period(F.col("period_date").cast("string"))).filter(
        F.col("period_date").isNotNull()
    )


def star_completed(facts: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return _star(facts, dims, ["total_completed", *WAITS, "pathway_type"])


def star_new_periods(facts: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return _star(facts, dims, ["new_rtt_periods"])


def star_wait_band(facts: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Non-zero bands as rows with keys and flags; only fully resolved rows stay."""
    dated = facts.filter("period_date IS NOT NULL").withColumn("date_key", calendar.date_key(F.col("period_date")))
    keyed = _resolve(dated, dims["dim_trust"], dims["dim_treatment_function"], "inner")
    rows = banded(keyed, STAR_KEYS + S.CELL_KEY).withColumnRenamed("patients_waiting", "waiting_count")
    return rows.join(_bands(dims["dim_wait_band"]), "band_label").select(
        *STAR_KEYS, "wait_band_key", "band_label", "is_breach", "is_long_waiter", "waiting_count", *S.CELL_KEY
    )
