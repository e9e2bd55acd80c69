"""DuckDB SQL of the queries that write and read back: the same rows straight from the tables."""

from __future__ import annotations

from waitflow import schemas as S
from waitflow.plans import marts

_LATE = "DATE '2023-04-01'"
_YEAR = "(year(period_date) - CASE WHEN month(period_date) >= 4 THEN 0 ELSE 1 END)"
_SLUG = f"CAST({_YEAR} AS VARCHAR) || '-' || right(CAST({_YEAR} + 1 AS VARCHAR), 2)"
_FY = f"CAST({_YEAR} AS VARCHAR) || '/' || right(CAST({_YEAR} + 1 AS VARCHAR), 2)"
_DATE_KEY = "CAST(year({0}) * 100 + month({0}) AS INTEGER)"
_KEY = ", ".join(S.CELL_KEY)
_FILE = "'New-Periods-Provider-' || strftime(period_date, '%b%y')"
_BASE = "region_code, provider_org_code, provider_org_name, treatment_function_code, treatment_function_name"
_IDS = "(SELECT s_suppkey AS provider_id, 'S' || to_base(s_suppkey::BIGINT, 36, 5) AS provider_org_code FROM supplier)"
_LABELLED = "JOIN providers USING (provider_org_code) JOIN specialties USING (treatment_function_code)"
_COVID = "period_date BETWEEN DATE '2020-03-01' AND DATE '2022-03-01'"
_EARLY = "period_date <= DATE '2022-03-01'"

_CELLS = f"""
    SELECT provider_id, {_BASE}, CAST(new_rtt_periods AS BIGINT) AS n, CAST(period_date AS VARCHAR) AS month, {_FILE} AS file
    FROM new_periods {_LABELLED} JOIN {_IDS} USING (provider_org_code)"""
_FRONT = "concat_ws(',', region_code, provider_org_code, provider_org_name, treatment_function_code, treatment_function_name)"
_WHICH = "CASE WHEN provider_id % 7 = 0 THEN provider_id // 7 % 3 END"

_SOME = """
    some_trusts AS (SELECT * FROM trusts WHERE trust_key % 10 <> 0),
    some_functions AS (SELECT * FROM functions
                       WHERE treatment_function_key < (SELECT MAX(treatment_function_key) FROM functions))"""
_RESOLVED = """{0} f {1} JOIN some_trusts t ON f.provider_org_code = t.trust_code
         {1} JOIN some_functions k ON f.treatment_function_code = k.treatment_function_code"""


def _missing(name: str, table: str, how: str, band: str) -> str:
    counts = ", ".join(
        f"COUNT(*) FILTER ({c} IS NULL) AS missing_{k}"
        for k, c in (
            ("date_key", "f.period_date"), ("trust_key", "t.trust_key"), ("region_key", "t.region_key"),
            ("treatment_function_key", "k.treatment_function_key"),
        )
    )
    return f"""
        SELECT '{name}' AS table_name, COUNT(*) AS total_rows, {counts}, {band}::BIGINT AS missing_wait_band_key
        FROM {_RESOLVED.format(table, how)}"""


SQL: dict[str, str] = {
    "load_batches_reloaded": f"""
        SELECT {_KEY}, {', '.join(S.BAND_COLUMNS)}, total_waiting, 'incomplete_' || {_SLUG} AS load_batch_id,
               {_DATE_KEY.format('period_date')} AS date_key, 'monthly sheets' AS data_source, TRUE AS is_loaded
        FROM incomplete""",
    "load_touched_months": f"""
        WITH late AS (SELECT period_date, provider_org_code FROM new_periods WHERE period_date >= {_LATE}),
             touched AS (SELECT period_date FROM late
                         UNION SELECT CAST(period_date + INTERVAL 1 MONTH AS DATE) FROM late
                         WHERE regexp_matches(provider_org_code, '[0-9]$'))
        SELECT {_DATE_KEY.format('t.period_date')} AS date_key, COUNT(n.period_date) AS n_rows
        FROM touched t LEFT JOIN new_periods n ON n.period_date = t.period_date GROUP BY t.period_date""",
    "mart_refreshed": f"SELECT {_KEY}, {', '.join(marts.MEASURES)} FROM summary",
    "mart_refreshed_national": "SELECT * FROM national",
    "slice_stored_facts": f"""
        SELECT 'Q' || CAST(CASE WHEN month(period_date) >= 4 THEN (month(period_date) - 1) // 3 ELSE 4 END AS VARCHAR) || ' '
                   || right(CAST({_YEAR} AS VARCHAR), 2) || right(CAST({_YEAR} + 1 AS VARCHAR), 2) AS financial_quarter,
               CAST(SUM(total_waiting) AS BIGINT) AS total_waiting, CAST(SUM(band_52_plus) AS BIGINT) AS band_52_plus,
               COUNT(*) AS n_rows
        FROM incomplete WHERE {_COVID} GROUP BY 1""",
    "fact_appended": f"SELECT *, {_SLUG} AS financial_year FROM completed",
    "dq_missing_keys_at_load": f"WITH {_SOME}" + " UNION ALL ".join(
        [
            _missing("fact_rtt_incomplete_star", "incomplete", "LEFT", "NULL"),
            _missing("fact_rtt_completed_star", "completed", "LEFT", "NULL"),
            _missing("fact_rtt_new_periods_star", "new_periods", "LEFT", "NULL"),
            _missing("fact_rtt_wait_band_star", "banded", "INNER", "0"),
        ]
    ),
    "star_new_periods_unmatched": f"""
        WITH {_SOME}
        SELECT {_DATE_KEY.format('f.period_date')} AS date_key, t.trust_key, t.region_key, k.treatment_function_key,
               f.new_rtt_periods, f.period_date, f.provider_org_code, f.treatment_function_code
        FROM {_RESOLVED.format('new_periods', 'LEFT')}""",
    "star_wait_band_unmatched": f"""
        WITH {_SOME}
        SELECT {_DATE_KEY.format('f.period_date')} AS date_key, t.trust_key, t.region_key, k.treatment_function_key,
               f.wait_band_key, f.band_label, f.is_breach, f.is_long_waiter, f.patients_waiting AS waiting_count,
               f.period_date, f.provider_org_code, f.treatment_function_code
        FROM {_RESOLVED.format('banded', 'INNER')}""",
    "csv_fixed_schema": f"""
        SELECT region_code, provider_org_code, provider_org_name || ', "The"' || chr(10) || 'Trust' AS provider_org_name,
               treatment_function_code, treatment_function_name,
               {', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in S.BAND_COLUMNS)},
               CAST(total_waiting AS BIGINT) AS total_waiting, median_wait_weeks, percentile_92_wait_weeks,
               CAST(period_date AS VARCHAR) AS period_date,
               'Incomplete-Provider-' || strftime(period_date, '%b%y') || '.xlsx' AS source_file
        FROM incomplete {_LABELLED}""",
    "csv_all_text": f"""
        SELECT {_BASE}, CAST(new_rtt_periods AS BIGINT) AS new_rtt_periods, strftime(period_date, '%B %Y') AS period_date,
               {_FILE} || '.csv' AS source_file
        FROM new_periods {_LABELLED}""",
    "csv_rejects": f"""
        SELECT file, CASE {_WHICH} WHEN 0 THEN concat_ws(',', {_FRONT}, n, month)
                                   WHEN 1 THEN concat_ws(',', {_FRONT}, n, month, file || '.csv', 'more')
                                   ELSE concat_ws(',', {_FRONT}, '*', month, file || '.csv') END AS record,
               CASE {_WHICH} WHEN 0 THEN 'cells missing' WHEN 1 THEN 'cells over' ELSE 'unreadable new_rtt_periods' END AS reason
        FROM ({_CELLS}) WHERE provider_id % 7 = 0""",
    "csv_kept": f"""
        SELECT {_BASE}, n AS new_rtt_periods, month AS period_date, file || '.csv' AS source_file, file FROM ({_CELLS})""",
    "csv_combined": f"""
        SELECT {_BASE}, CASE WHEN provider_id % 3 = 0 THEN n + 1 ELSE n END AS new_rtt_periods, month AS period_date,
               CASE WHEN provider_id % 3 = 0 THEN '2-' ELSE '1-' END || file || '.csv' AS source_file
        FROM ({_CELLS})""",
    "ingest_incremental": f"""
        SELECT CAST(period_date AS VARCHAR) AS period_date, provider_org_code, treatment_function_code,
               CAST(new_rtt_periods AS BIGINT) AS new_rtt_periods, {_FILE} AS file,
               CASE WHEN {_EARLY} AND NOT {_COVID} THEN 1 ELSE 2 END AS run
        FROM new_periods""",
    "ingest_incremental_runs": f"""
        WITH months AS (SELECT DISTINCT period_date FROM new_periods)
        SELECT run, CASE run WHEN 1 THEN COUNT(*) FILTER ({_EARLY}) ELSE COUNT(*) END AS n_listed,
               CASE run WHEN 1 THEN COUNT(*) FILTER ({_EARLY}) WHEN 2 THEN COUNT(*) FILTER ({_COVID} OR NOT {_EARLY})
                        ELSE 0 END AS n_read
        FROM months, (VALUES (1), (2), (3)) AS r(run) GROUP BY run""",
    "dim_trust_first_seen": """
        SELECT trust_key, trust_code, trust_name || ' ' || first_year AS trust_name, region_key, is_active
        FROM trusts JOIN (SELECT provider_org_code AS trust_code, CAST(year(MIN(period_date)) AS VARCHAR) AS first_year
                          FROM raw_lines GROUP BY 1) USING (trust_code)""",
    "dim_trust_changes": """
        WITH known AS (SELECT 'S' || to_base(s_suppkey::BIGINT, 36, 5) AS trust_code, 1 AS region_key,
                              CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE 'old ' || s_name END AS trust_name
                       FROM supplier WHERE s_acctbal > 0)
        SELECT COALESCE(k.trust_code, t.trust_code) AS trust_code,
               CASE WHEN k.trust_code IS NULL THEN 'inserted' WHEN t.trust_code IS NULL THEN 'absent'
                    WHEN k.trust_name = t.trust_name AND k.region_key = t.region_key THEN 'unchanged'
                    ELSE 'changed' END AS change,
               k.trust_name AS old_trust_name, t.trust_name AS new_trust_name, k.region_key AS old_region_key,
               t.region_key AS new_region_key
        FROM known k FULL JOIN trusts t ON k.trust_code = t.trust_code""",
    "dim_trust_history": f"""
        WITH named AS (SELECT DISTINCT provider_org_code, period_date,
                              provider_org_name || ' v' || CAST(({_YEAR} - 2019) // 2 AS VARCHAR) AS trust_name FROM raw_lines),
             spans AS (SELECT provider_org_code, trust_name, MIN(period_date) AS valid_from FROM named GROUP BY ALL)
        SELECT *, LEAD(valid_from) OVER (PARTITION BY provider_org_code ORDER BY valid_from) AS valid_to FROM spans""",
    "fact_as_of_names": f"""
        SELECT provider_org_code, provider_org_name || ' v' || CAST(({_YEAR} - 2019) // 2 AS VARCHAR) AS trust_name,
               COUNT(DISTINCT period_date) AS n_months, COUNT(*) AS new_rtt_periods
        FROM raw_lines GROUP BY 1, 2""",
    "bucketed_month_totals": "SELECT * FROM month_totals",
    "profile_sketches": f"""
        SELECT {_FY} AS financial_year, COUNT(DISTINCT provider_org_code) AS n_trusts,
               COUNT(DISTINCT provider_org_code || ' ' || treatment_function_code) AS n_cells, TRUE AS trusts_within_bound,
               TRUE AS cells_within_bound
        FROM raw_lines GROUP BY 1""",
    "m_true_wait": """
        SELECT region_name, n_rows, median, p92, mean_of_median, mean_of_p92
        FROM (SELECT region_name, COUNT(*) AS n_rows, round(quantile_cont(wait_week, 0.5), 6) AS median,
                     round(quantile_cont(wait_week, 0.92), 6) AS p92
              FROM raw_lines WHERE l_linestatus = 'O' GROUP BY region_name)
             JOIN (SELECT region_name, round(AVG(median_wait_weeks), 6) AS mean_of_median,
                          round(AVG(percentile_92_wait_weeks), 6) AS mean_of_p92
                   FROM incomplete JOIN providers USING (provider_org_code) GROUP BY region_name) USING (region_name)""",
}
