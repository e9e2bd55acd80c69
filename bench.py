"""Times the headline queries, one first run and one warm run each, and prints one JSON line.

BENCH_SF_DIR  input directory (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names, or "all"
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from waitflow.queries import QUERIES
from waitflow.session import local

HEADLINES = [
    "silver_incomplete",
    "dedup_first",
    "ingest_incomplete",
    "ingest_preamble",
    "dim_trust_upsert",
    "fact_incomplete_banded",
    "fact_completed_pivoted",
    "star_incomplete",
    "star_wait_band",
    "mart_monthly_summary",
    "mart_monthly_dense",
    "mart_national_monthly",
    "q1_national_trend",
    "q2_core_insight",
    "q3_long_waiters",
    "q4_specialty_pressure",
    "q5_regional",
    "q6_trust_scorecard",
    "q7_recovery_regional",
    "jp1_waiting_by_fy_region_trust_tf",
    "jp3_referral_demand",
    "jp4_band_distribution",
    "jp5_suppression_signal",
    "slice_dice",
    "drilldown_rollup",
    "m_roll12_referrals",
    "m_fytd_treated",
    "dq_missing_keys",
    "dq_orphans",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINES
    spark = local(cpus, partitions=cpus, memory=os.environ.get("BENCH_MEMORY", "12g"))
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    cold = {name: run(name) for name in names}
    seconds = {name: run(name) for name in names}
    result = {
        "metric": "total wall time of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "first_run": cold,
        "sf": Path(directory).name.removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
