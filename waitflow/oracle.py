"""DuckDB SQL for each registered query, on the same tables.

Every query starts from the same common table expressions; only those it names are put in front of it.
Facts are aggregated to the join key before they meet, so nothing is counted twice.
"""

from __future__ import annotations

import re

from waitflow import schemas as S
from waitflow import stored_oracle


def _fy(d: str) -> str:
    y = f"(year({d}) - CASE WHEN month({d}) >= 4 THEN 0 ELSE 1 END)"
    return f"CAST({y} AS VARCHAR) || '/' || right(CAST({y} + 1 AS VARCHAR), 2)"


def _fq(d: str) -> str:
    y = f"(year({d}) - CASE WHEN month({d}) >= 4 THEN 0 ELSE 1 END)"
    q = f"CASE WHEN month({d}) >= 4 THEN (month({d}) - 1) // 3 ELSE 4 END"
    return (
        f"'Q' || CAST({q} AS VARCHAR) || ' ' || right(CAST({y} AS VARCHAR), 2) || right(CAST({y} + 1 AS VARCHAR), 2)"
    )


def _covid(d: str) -> str:
    return f"({d} BETWEEN DATE '2020-03-01' AND DATE '2022-03-01')"


def _pct(a: str, b: str) -> str:
    return f"100.0::DOUBLE * ({a})::DOUBLE / NULLIF(({b})::DOUBLE, 0)"


def _ratio(a: str, b: str) -> str:
    return f"({a})::DOUBLE / NULLIF(({b})::DOUBLE, 0)"


def _big(a: str) -> str:
    return f"CAST(SUM({a}) AS BIGINT)"


def _patients(condition: str) -> str:
    return f"CAST(COALESCE(SUM(CASE WHEN {condition} THEN patients END), 0) AS BIGINT)"


_CODE = "'S' || to_base({0}::BIGINT, 36, 5)"
_BANDS = ",\n".join(f"{_patients(f'wait_week BETWEEN {b[2]} AND {b[3]}')} AS {b[0]}" for b in S.BANDS)
_BAND_SUMS = ", ".join(f"{_big(c)} AS {c}" for c in S.BAND_COLUMNS)
_BAND_LIST = ", ".join(S.BAND_COLUMNS)
_BREACH = " + ".join(S.BREACH_COLUMNS)


def _literal(v: object) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)


_MONTH = "CAST(date_trunc('month', {0}) + INTERVAL 291 MONTH AS DATE)"
_KEY = "period_date, provider_org_code, treatment_function_code"

CTES = {
    "raw_lines": f"""
        SELECT {_MONTH.format('o_orderdate')} AS period_date,
               CAST((((date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) % 371) + 371) % 371) // 7
                    AS INTEGER) AS wait_week,
               CAST(floor(l_quantity) AS INTEGER) AS patients,
               {_CODE.format('l_suppkey')} AS provider_org_code, s_name AS provider_org_name,
               'R' || r_regionkey::VARCHAR AS region_code, r_name AS region_name,
               p_brand AS treatment_function_code,
               'Specialty ' || split_part(p_brand, '#', 2) AS treatment_function_name,
               CASE CAST(split_part(p_brand, '#', 2) AS INTEGER) % 3
                    WHEN 0 THEN 'Surgical' WHEN 1 THEN 'Medical' ELSE 'Mental Health' END AS specialty_group,
               l_linestatus, l_returnflag, l_orderkey, l_linenumber
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey""",
    "providers": """
        SELECT provider_org_code, any_value(provider_org_name) AS provider_org_name,
               any_value(region_code) AS region_code, any_value(region_name) AS region_name
        FROM raw_lines GROUP BY 1""",
    "specialties": """
        SELECT DISTINCT p_brand AS treatment_function_code,
               'Specialty ' || split_part(p_brand, '#', 2) AS treatment_function_name,
               CASE CAST(split_part(p_brand, '#', 2) AS INTEGER) % 3
                    WHEN 0 THEN 'Surgical' WHEN 1 THEN 'Medical' ELSE 'Mental Health' END AS specialty_group
        FROM part""",
    "incomplete": f"""
        SELECT {_KEY}, {_BANDS}, CAST(SUM(patients) AS BIGINT) AS total_waiting,
               quantile_cont(wait_week, 0.5) AS median_wait_weeks,
               round(quantile_cont(wait_week, 0.92), 6) AS percentile_92_wait_weeks
        FROM raw_lines WHERE l_linestatus = 'O' GROUP BY {_KEY}""",
    "completed": f"""
        SELECT {_KEY}, CASE WHEN l_returnflag = 'R' THEN 'Admitted' ELSE 'Non-Admitted' END AS pathway_type,
               CAST(SUM(patients) AS BIGINT) AS total_completed,
               quantile_cont(wait_week, 0.5) AS median_wait_weeks,
               round(quantile_cont(wait_week, 0.92), 6) AS percentile_92_wait_weeks
        FROM raw_lines WHERE l_linestatus = 'F' GROUP BY {_KEY}, pathway_type""",
    "new_periods": f"SELECT {_KEY}, COUNT(*) AS new_rtt_periods FROM raw_lines GROUP BY {_KEY}",
    "bands": f"""
        SELECT * FROM (VALUES {_values([(i, *b[:2], *b[4:]) for i, b in enumerate(S.BANDS, 1)])})
             AS t(wait_band_key, band_column, band_label, lower_weeks, upper_weeks, is_breach, is_long_waiter)""",
    "banded": f"""
        SELECT {_KEY}, band_label, is_breach, is_long_waiter, wait_band_key, patients_waiting
        FROM (UNPIVOT (SELECT {_KEY}, {_BAND_LIST} FROM incomplete) ON {_BAND_LIST}
              INTO NAME band_column VALUE patients_waiting) JOIN bands USING (band_column)
        WHERE patients_waiting > 0""",
    "pivoted": f"""
        SELECT {_KEY},
               CAST(SUM(CASE WHEN pathway_type = 'Admitted' THEN total_completed ELSE 0 END) AS BIGINT)
                   AS completed_admitted,
               CAST(SUM(CASE WHEN pathway_type = 'Non-Admitted' THEN total_completed ELSE 0 END) AS BIGINT)
                   AS completed_non_admitted,
               {_big('total_completed')} AS total_completed,
               AVG(median_wait_weeks) AS median_wait_weeks, AVG(percentile_92_wait_weeks) AS percentile_92_wait_weeks,
               SUM(median_wait_weeks) AS median_sum, COUNT(median_wait_weeks) AS median_n
        FROM completed GROUP BY {_KEY}""",
    "summary": f"""
        SELECT i.period_date, i.provider_org_code, i.treatment_function_code, p.provider_org_name, p.region_code,
               p.region_name, t.treatment_function_name, t.specialty_group, {_fy('i.period_date')} AS financial_year,
               i.total_waiting, {_BREACH} AS waiting_over_18wks, band_52_plus AS waiting_over_52wks,
               COALESCE(completed_admitted, 0) AS completed_admitted,
               COALESCE(completed_non_admitted, 0) AS completed_non_admitted,
               COALESCE(total_completed, 0) AS total_completed, COALESCE(new_rtt_periods, 0) AS new_rtt_periods,
               i.median_wait_weeks AS avg_median_wait_weeks, i.percentile_92_wait_weeks AS avg_p92_wait_weeks,
               c.median_sum, c.median_n
        FROM incomplete i LEFT JOIN pivoted c USING ({_KEY}) LEFT JOIN new_periods n USING ({_KEY})
             JOIN providers p ON p.provider_org_code = i.provider_org_code
             JOIN specialties t ON t.treatment_function_code = i.treatment_function_code""",
    "national": f"""
        SELECT period_date, {_big('total_waiting')} AS total_waiting, {_big('waiting_over_18wks')} AS waiting_over_18wks,
               {_big('waiting_over_52wks')} AS waiting_over_52wks, {_big('total_completed')} AS total_completed,
               {_big('new_rtt_periods')} AS new_rtt_periods,
               {_big('new_rtt_periods')} - {_big('total_completed')} AS net_list_change,
               {_ratio('SUM(total_completed)', 'SUM(new_rtt_periods)')} AS treatment_per_referral_ratio,
               {_pct('SUM(waiting_over_18wks)', 'SUM(total_waiting)')} AS breach_rate_pct
        FROM summary GROUP BY period_date""",
    "region_months": f"""
        SELECT period_date, region_code, region_name, {_fy('period_date')} AS financial_year,
               {', '.join(f'{_big(m)} AS {m}' for m in (
                   'total_waiting', 'waiting_over_18wks', 'waiting_over_52wks', 'completed_admitted',
                   'completed_non_admitted', 'total_completed', 'new_rtt_periods'))}
        FROM summary GROUP BY period_date, region_code, region_name""",
    "region_years": f"""
        SELECT financial_year, region_name,
               {', '.join(f'{_big(m)} AS {m}' for m in (
                   'total_waiting', 'waiting_over_18wks', 'waiting_over_52wks', 'completed_admitted',
                   'completed_non_admitted', 'total_completed', 'new_rtt_periods'))}
        FROM region_months GROUP BY financial_year, region_name""",
    "month_totals": f"""
        SELECT period_date,
               CAST(SUM(CASE WHEN l_linestatus = 'O' THEN patients END) AS BIGINT) AS total_waiting,
               CAST(SUM(CASE WHEN l_linestatus = 'F' THEN patients END) AS BIGINT) AS total_completed,
               COUNT(*) AS new_rtt_periods
        FROM raw_lines GROUP BY period_date""",
    "calendar": """
        SELECT CAST(d AS DATE) AS full_date
        FROM (SELECT unnest(generate_series(DATE '2015-01-01', DATE '2025-12-01', INTERVAL 1 MONTH)) AS d)""",
    "series": f"""
        SELECT period_date, total_waiting AS patients_waiting, total_completed AS total_treated, new_rtt_periods,
               {_covid('period_date')} AS is_covid,
               COALESCE({_ratio('new_rtt_periods', 'total_completed')}, 1.0) AS rtt_ratio,
               new_rtt_periods - total_completed AS net_flow,
               round({_pct('new_rtt_periods', "AVG(CASE WHEN period_date BETWEEN DATE '2019-04-01' AND DATE '2020-02-01' THEN new_rtt_periods END) OVER ()")}, 6)
                   AS referral_index,
               round({_pct('total_completed', "AVG(CASE WHEN period_date BETWEEN DATE '2019-04-01' AND DATE '2020-02-01' THEN total_completed END) OVER ()")}, 6)
                   AS treatment_index
        FROM month_totals""",
    "blocks": """
        SELECT block, round(AVG(new_rtt_periods), 6) AS new_referrals_per_month,
               round(AVG(total_treated), 6) AS treatments_per_month, round(AVG(patients_waiting), 6) AS waiting_list,
               round(AVG(rtt_ratio), 6) AS rtt_ratio
        FROM (SELECT 'Pre-COVID (FY 2019/20)' AS block, * FROM series
              WHERE period_date BETWEEN DATE '2019-04-01' AND DATE '2020-02-01'
              UNION ALL SELECT 'COVID peak (Apr-Jun 2020)', * FROM series
              WHERE period_date BETWEEN DATE '2020-04-01' AND DATE '2020-06-01'
              UNION ALL (SELECT 'Latest (6-month avg)', * FROM series ORDER BY period_date DESC LIMIT 6))
        GROUP BY block""",
    "trusts": """
        SELECT CAST(row_number() OVER (ORDER BY p.provider_org_code) AS INTEGER) AS trust_key,
               p.provider_org_code AS trust_code, p.provider_org_name AS trust_name,
               CAST(COALESCE(r.region_key, 1) AS INTEGER) AS region_key, 1 AS is_active
        FROM providers p LEFT JOIN regions r USING (region_code)""",
    "regions": """
        SELECT CAST(row_number() OVER (ORDER BY r_regionkey::VARCHAR) AS INTEGER) AS region_key,
               'R' || r_regionkey::VARCHAR AS region_code, r_name AS region_name FROM region""",
    "functions": """
        SELECT CAST(row_number() OVER (ORDER BY treatment_function_code) AS INTEGER) AS treatment_function_key, *
        FROM specialties""",
    "distribution": f"""
        SELECT {_fy('period_date')} AS financial_year, region_name, treatment_function_name, band_label, is_breach,
               is_long_waiter, {_big('patients_waiting')} AS patients_waiting
        FROM banded JOIN providers USING (provider_org_code) JOIN specialties USING (treatment_function_code)
        GROUP BY ALL""",
    "weekly": f"""
        SELECT {_KEY}, wait_week, CAST(SUM(patients) AS BIGINT) AS cell
        FROM raw_lines WHERE l_linestatus = 'O' GROUP BY {_KEY}, wait_week""",
    "silver": f"""
        SELECT {_KEY}, {', '.join(
            f"CAST(COALESCE(SUM(CASE WHEN wait_week BETWEEN {b[2]} AND {b[3]} THEN cell END), 0) AS BIGINT) AS {b[0]}"
            for b in S.BANDS)},
               CAST(SUM(cell) AS BIGINT) AS total_waiting
        FROM weekly GROUP BY {_KEY}""",
    "labelled_silver": f"""
        SELECT s.*, p.region_code, p.provider_org_name, t.treatment_function_name
        FROM silver s JOIN providers p USING (provider_org_code) JOIN specialties t USING (treatment_function_code)""",
    "hrefs": r"""
        SELECT page_id, CAST(pos - 1 AS INTEGER) AS position, hs[pos] AS href
        FROM (SELECT page_id, hs, unnest(generate_series(1, len(hs))) AS pos
              FROM (SELECT page_id, regexp_extract_all(html, '<a\s[^>]*?href=["'']([^"'']*)["'']', 1) AS hs
                    FROM pages))""",
    "page_links": """
        SELECT page_id, position, list_last(string_split(href, '/')) AS filename,
               CASE WHEN starts_with(href, 'http') THEN href ELSE 'https://site.example' || href END AS full_url,
               CASE WHEN contains(lower(href), 'tion') THEN 'kind_tion' WHEN contains(lower(href), 'en') THEN 'kind_en'
                    WHEN contains(lower(href), 'e') THEN 'kind_e' WHEN contains(lower(href), 'a') THEN 'kind_a' END
                   AS file_type
        FROM hrefs WHERE right(lower(href), 1) IN ('n', 'e', 's', 'r')""",
    "grouped_links": """
        SELECT l.*, regexp_extract(p.url, '/([a-z]{2})/', 1) AS page_group, starts_with(p.url, 'https') AS secure
        FROM page_links l JOIN pages p USING (page_id) WHERE file_type IS NOT NULL""",
    "link_files": """
        SELECT page_group, file_type, filename, COUNT(*) AS n_links,
               filename IN (SELECT g.filename FROM grouped_links g WHERE g.secure AND g.page_group = f.page_group)
                   AS known
        FROM grouped_links f GROUP BY page_group, file_type, filename""",
}


def with_ctes(sql: str) -> str:
    """The query with the expressions it needs in front, in order of definition."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(sql)
    order: list[str] = []

    def place(name: str) -> None:
        if name in order:
            return
        for other in CTES:
            if other != name and other in needed and re.search(rf"\b{other}\b", CTES[name]):
                place(other)
        order.append(name)

    for name in CTES:
        if name in needed:
            place(name)
    parts = [f"{n} AS ({CTES[n].strip()})" for n in order]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + sql.strip()


def _star(columns: str, table: str, source: str | None = None) -> str:
    file = f", '{source}-' || strftime(f.period_date, '%b%y') || '.xlsx' AS source_file" if source else ""
    return f"""
        SELECT CAST(year(f.period_date) * 100 + month(f.period_date) AS INTEGER) AS date_key, t.trust_key, t.region_key,
               k.treatment_function_key, {columns}, f.period_date, f.provider_org_code,
               f.treatment_function_code{file}
        FROM {table} f LEFT JOIN trusts t ON f.provider_org_code = t.trust_code
             LEFT JOIN functions k ON f.treatment_function_code = k.treatment_function_code"""


_DATE_KEY = "CAST(year(period_date) * 100 + month(period_date) AS INTEGER)"
_LOADED = (
    "JOIN trusts ON provider_org_code = trust_code JOIN functions USING (treatment_function_code)"
)


def _dim_date(source: str) -> str:
    d = "full_date"
    return f"""
        SELECT CAST(year({d}) * 100 + month({d}) AS INTEGER) AS date_key, {d}, CAST(year({d}) AS INTEGER) AS year,
               CAST(quarter({d}) AS INTEGER) AS quarter, CAST(month({d}) AS INTEGER) AS month,
               monthname({d}) AS month_name, {_fy(d)} AS financial_year, {_fq(d)} AS financial_quarter,
               CAST({_covid(d)} AS INTEGER) AS is_covid_period
        FROM {source}"""


def _shift(c: str, months: int, table: str = "region_months") -> str:
    return (
        f"(SELECT b.{c} FROM {table} b WHERE b.region_name = a.region_name "
        f"AND b.period_date = a.period_date - INTERVAL {months} MONTH)"
    )


_LONG = _pct("waiting_over_52wks", "total_waiting")
_BREACH_PCT = _pct("waiting_over_18wks", "total_waiting")
_GROUPED = ", ".join(
    f"{_big(m)} AS {m}"
    for m in ("total_waiting", "waiting_over_18wks", "waiting_over_52wks", "total_completed", "new_rtt_periods")
)
_YEARS = [f"{y}/{(y + 1) % 100:02d}" for y in range(2019, 2026)]


def _matrix() -> str:
    cells = []
    for y in _YEARS:
        name = y.replace("/", "_")
        for label, a, b in (
            ("breach", "waiting_over_18wks", "total_waiting"),
            ("throughput", "total_completed", "new_rtt_periods"),
            ("long", "waiting_over_52wks", "total_waiting"),
        ):
            cells.append(f"MAX(CASE WHEN financial_year = '{y}' THEN {_pct(a, b)} END) AS {label}_{name}")
    return f"SELECT region_name, {', '.join(cells)} FROM region_years GROUP BY region_name"


def _headline(label: str, condition: str) -> str:
    means = ", ".join(
        f"round(SUM({c})::DOUBLE / COUNT(*), 6) AS {n}"
        for n, c in (
            ("avg_waiting", "total_waiting"),
            ("avg_referrals", "new_rtt_periods"),
            ("avg_long_waiters", "waiting_over_52wks"),
        )
    )
    return f"""
        SELECT '{label}' AS headline, COUNT(*) AS n_months, {means},
               {_ratio('SUM(new_rtt_periods)', 'SUM(total_completed)')} AS referral_to_treatment_ratio,
               {_pct('SUM(waiting_over_18wks)', 'SUM(total_waiting)')} AS breach_rate_pct
        FROM national WHERE {condition} HAVING COUNT(*) > 0"""


def _recovery(partition: str, base: str) -> str:
    return ", ".join(
        f"round({_pct(c, f'AVG(CASE WHEN {base} THEN {c} END) OVER ({partition})')}, 6) AS {n}"
        for n, c in (
            ("referral_recovery_index", "new_rtt_periods"),
            ("treatment_recovery_index", "total_completed"),
            ("waiting_list_index", "total_waiting"),
        )
    )


_BASE_MONTHS = "period_date BETWEEN DATE '2019-04-01' AND DATE '2020-03-01'"
_SILVER_BASE = "region_code, provider_org_code, provider_org_name, treatment_function_code, treatment_function_name"
_PERIOD_TEXT = "strftime(period_date, '%B %Y')"


def _file(kind: str) -> str:
    return f"'{kind}-' || strftime(period_date, '%b%y') || '.csv'"


def _missing(name: str, table: str, band: bool = False) -> str:
    last = "SUM(CASE WHEN wait_band_key IS NULL THEN 1 ELSE 0 END)::BIGINT" if band else "NULL::BIGINT"
    return f"""
        SELECT '{name}' AS table_name, COUNT(*) AS total_rows,
               COUNT(*) FILTER (period_date IS NULL) AS missing_date_key,
               COUNT(*) FILTER (trust_key IS NULL) AS missing_trust_key,
               COUNT(*) FILTER (region_key IS NULL) AS missing_region_key,
               COUNT(*) FILTER (treatment_function_key IS NULL) AS missing_treatment_function_key,
               {last} AS missing_wait_band_key
        FROM {table} LEFT JOIN trusts ON provider_org_code = trust_code
             LEFT JOIN functions USING (treatment_function_code)"""


def _orphans(name: str, facts: str, dim: str, fk: str, pk: str) -> str:
    return f"""
        SELECT '{name}' AS foreign_key, COUNT(DISTINCT f.{fk}) AS n_orphan_keys, COUNT(*) AS n_orphan_rows
        FROM {facts} f WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{pk} = f.{fk})"""


_SUMMARY_NAMES = [
    "period_date",
    "region_code",
    "provider_org_code",
    "provider_org_name",
    "treatment_function_code",
    "treatment_function_name",
    "total_waiting",
    "waiting_over_18wks",
    "waiting_over_52wks",
    "completed_admitted",
    "completed_non_admitted",
    "total_completed",
    "new_rtt_periods",
    "avg_median_wait_weeks",
    "avg_p92_wait_weeks",
]

_SQL: dict[str, str] = {
    "parse_period": f"""
        WITH t AS (SELECT {_MONTH.format('o_orderdate')} AS m, o_orderstatus AS s FROM orders)
        SELECT CASE s WHEN 'F' THEN strftime(m, '%B %Y') WHEN 'O' THEN strftime(m, '%Y-%m-%d') ELSE 'Unknown' END
                   AS period_text,
               CASE WHEN s IN ('F', 'O') THEN m END AS period_date, COUNT(*) AS n_rows
        FROM t GROUP BY 1, 2""",
    "coerce_numeric": """
        SELECT l_returnflag,
               CAST(SUM(CASE WHEN l_returnflag IN ('R', 'A') THEN CAST(trunc(l_quantity) AS BIGINT) ELSE 0 END) AS BIGINT)
                   AS total,
               COUNT(*) FILTER (l_returnflag IN ('R', 'A')) AS n_numbers
        FROM lineitem GROUP BY l_returnflag""",
    "clean_rows": "SELECT provider_org_code, COUNT(*) AS n_rows FROM new_periods GROUP BY 1",
    "band_collapse": f"""
        SELECT period_date, {', '.join(
            f"CAST(COALESCE(SUM(CASE WHEN wait_week BETWEEN {b[2]} AND {b[3]} THEN patients END), 0) AS BIGINT) AS {b[0]}"
            for b in S.BANDS)}
        FROM raw_lines WHERE l_linestatus = 'O' GROUP BY period_date""",
    "silver_incomplete": f"""
        SELECT {_SILVER_BASE}, {_BAND_LIST}, total_waiting, {_PERIOD_TEXT} AS period_date,
               {_file('Incomplete-Provider')} AS source_file FROM labelled_silver""",
    "silver_completed": f"""
        SELECT {_SILVER_BASE}, CAST(total_completed AS BIGINT) AS total_completed, median_wait_weeks,
               percentile_92_wait_weeks, pathway_type, {_PERIOD_TEXT} AS period_date,
               CASE WHEN pathway_type = 'Admitted' THEN {_file('Admitted-Provider')}
                    ELSE {_file('NonAdmitted-Provider')} END AS source_file
        FROM completed JOIN providers USING (provider_org_code) JOIN specialties USING (treatment_function_code)""",
    "silver_new_periods": f"""
        SELECT {_SILVER_BASE}, CAST(new_rtt_periods AS BIGINT) AS new_rtt_periods, {_PERIOD_TEXT} AS period_date,
               {_file('New-Periods-Provider')} AS source_file
        FROM new_periods JOIN providers USING (provider_org_code) JOIN specialties USING (treatment_function_code)""",
    "dedup_first": f"""
        SELECT {_KEY}, l_linenumber AS file_no, l_orderkey AS row_idx, patients, wait_week FROM raw_lines
        QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY l_linenumber, l_orderkey, patients, wait_week) = 1""",
    "ingest_incomplete": f"""
        SELECT region_code, provider_org_code, provider_org_name, treatment_function_code, treatment_function_name,
               {', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in S.BAND_COLUMNS)},
               CAST(total_waiting AS BIGINT) AS total_waiting, median_wait_weeks, percentile_92_wait_weeks,
               CAST(period_date AS VARCHAR) AS period_date,
               'Incomplete-Provider-' || strftime(period_date, '%b%y') || '.xlsx' AS source_file
        FROM incomplete JOIN providers USING (provider_org_code) JOIN specialties USING (treatment_function_code)""",
    "ingest_preamble": f"""
        SELECT {_SILVER_BASE}, {_BAND_LIST}, total_waiting, period_date,
               'Incomplete-Provider-' || provider_org_code || '-' || strftime(period_date, '%b%y') || '.csv'
                   AS source_file
        FROM labelled_silver""",
    "ingest_rejects": f"""
        SELECT 'Incomplete-Provider-' || provider_org_code || '-' || strftime(period_date, '%b%y') || '-copy.csv'
                   AS file_name,
               CASE year(period_date) % 4 WHEN 0 THEN 'no period' WHEN 2 THEN 'no rows' ELSE 'no header' END AS status
        FROM (SELECT DISTINCT period_date, provider_org_code FROM incomplete)
             JOIN (SELECT s_suppkey, {_CODE.format('s_suppkey')} AS provider_org_code FROM supplier) USING (provider_org_code)
        WHERE (s_suppkey + month(period_date)) % 12 = 0""",
    "load_batch_incomplete": f"""
        SELECT 'incomplete_2021/22' AS load_batch_id, period_date, COUNT(*) AS n_rows,
               {_big('total_waiting')} AS total_waiting
        FROM incomplete WHERE {_fy('period_date')} = '2021/22' GROUP BY period_date""",
    "links_classified": "SELECT * FROM page_links WHERE file_type IS NOT NULL",
    "manifest_counts": """
        SELECT page_group, file_type, CAST(SUM(n_links) AS BIGINT) AS n_links, COUNT(*) FILTER (NOT known) AS n_new,
               CAST(SUM(n_links) - COUNT(*) FILTER (NOT known) AS BIGINT) AS n_skipped
        FROM link_files GROUP BY page_group, file_type""",
    "manifest_new_files": "SELECT page_group, file_type, filename, n_links FROM link_files WHERE NOT known",
    "fy_slugs": """
        WITH y AS (SELECT CAST(year(period_date - INTERVAL 3 MONTH) AS INTEGER) AS start_year FROM raw_lines)
        SELECT start_year, start_year::VARCHAR || '-' || right((start_year + 1)::VARCHAR, 2) AS slug, COUNT(*) AS n_rows
        FROM y GROUP BY 1, 2""",
    "dim_date": _dim_date(
        "(SELECT CAST(unnest(generate_series(MIN(period_date), MAX(period_date), INTERVAL 1 MONTH)) AS DATE) "
        "AS full_date FROM raw_lines)"
    ),
    "dim_date_insert_ignore": f"""
        WITH known AS (SELECT DISTINCT {_MONTH.format('o_orderdate')} AS k FROM orders
                       WHERE o_orderpriority = '1-URGENT' AND {_MONTH.format('o_orderdate')} < DATE '2022-01-01'),
             found AS ({_dim_date(f"(SELECT DISTINCT {_MONTH.format('o_orderdate')} AS full_date FROM orders)")})
        SELECT * REPLACE (CASE WHEN full_date IN (SELECT k FROM known) THEN upper(month_name) ELSE month_name END
                          AS month_name) FROM found""",
    "dim_region": "SELECT * FROM regions",
    "dim_region_upsert": f"""
        SELECT CAST(k AS INTEGER) AS region_key, c AS region_code, n AS region_name, a AS nhs_region_abbrev
        FROM (VALUES {_values([(i, *r) for i, r in enumerate(S.REGIONS, 1)])}) AS t(k, c, n, a)
        UNION ALL SELECT region_key + {len(S.REGIONS)}, region_code, region_name, upper(substr(region_name, 1, 3))
        FROM regions""",
    "dim_wait_band": """
        SELECT wait_band_key, band_label, lower_weeks, upper_weeks, is_breach, is_long_waiter, patients_waiting
        FROM bands LEFT JOIN (SELECT band_label, CAST(SUM(patients_waiting) AS BIGINT) AS patients_waiting
                              FROM banded GROUP BY 1) USING (band_label)""",
    "dim_treatment_function": "SELECT * FROM functions",
    "dim_treatment_function_upsert": f"""
        SELECT CAST(k AS INTEGER) AS treatment_function_key, c AS treatment_function_code,
               n AS treatment_function_name, g AS specialty_group
        FROM (VALUES {_values([(i, *r) for i, r in enumerate(S.TREATMENT_FUNCTIONS, 1)])}) AS t(k, c, n, g)
        UNION ALL SELECT treatment_function_key + {len(S.TREATMENT_FUNCTIONS)}, treatment_function_code,
                         treatment_function_name, specialty_group FROM functions""",
    "dim_trust": "SELECT * FROM trusts",
    "dim_trust_upsert": f"""
        WITH existing AS (
            SELECT row_number() OVER (ORDER BY {_CODE.format('s_suppkey')}) AS k, {_CODE.format('s_suppkey')} AS c
            FROM supplier WHERE s_acctbal > 0),
        merged AS (
            SELECT COALESCE(e.c, t.trust_code) AS trust_code, e.k, t.* EXCLUDE (trust_code, trust_key)
            FROM existing e FULL JOIN trusts t ON e.c = t.trust_code)
        SELECT CAST(COALESCE(k, (SELECT MAX(k) FROM existing)
                             + row_number() OVER (PARTITION BY k IS NULL ORDER BY trust_code)) AS INTEGER) AS trust_key,
               trust_code, COALESCE(trust_name, 'old ' || trust_code) AS trust_name,
               COALESCE(region_key, 0) AS region_key, 1 AS is_active
        FROM merged""",
    "fact_incomplete_banded": f"""
        SELECT {_DATE_KEY} AS date_key, trust_key, treatment_function_key, wait_band_key, patients_waiting
        FROM banded {_LOADED}""",
    "fact_completed_pivoted": f"""
        SELECT {_DATE_KEY} AS date_key, trust_key, treatment_function_key, completed_admitted, completed_non_admitted,
               total_completed, median_wait_weeks, round(percentile_92_wait_weeks, 6) AS percentile_92_wait_weeks
        FROM pivoted {_LOADED}""",
    "fact_new_periods": f"""
        SELECT {_DATE_KEY} AS date_key, trust_key, treatment_function_key, new_rtt_periods FROM new_periods {_LOADED}""",
    "star_incomplete": _star(
        f"total_waiting, median_wait_weeks, percentile_92_wait_weeks, {_BAND_LIST}", "incomplete", "Incomplete-Provider"
    ),
    "star_completed": _star(
        "total_completed, median_wait_weeks, percentile_92_wait_weeks, pathway_type", "completed", "@"
    ).replace("'@-'", "CASE WHEN pathway_type = 'Admitted' THEN 'Admitted-Provider-' ELSE 'NonAdmitted-Provider-' END"),
    "star_new_periods": _star("new_rtt_periods", "new_periods", "New-Periods-Provider"),
    "star_wait_band": _star(
        "wait_band_key, band_label, is_breach, is_long_waiter, patients_waiting AS waiting_count", "banded"
    ),
    "mart_monthly_summary": f"SELECT {', '.join(_SUMMARY_NAMES)} FROM summary",
    "mart_from_facts": "SELECT * FROM national",
    "mart_monthly_dense": f"""
        WITH grid AS (
            SELECT full_date AS period_date, provider_org_code, treatment_function_code
            FROM (SELECT CAST(unnest(generate_series(MIN(period_date), MAX(period_date), INTERVAL 1 MONTH)) AS DATE)
                         AS full_date FROM raw_lines)
                 CROSS JOIN (SELECT provider_org_code FROM providers)
                 CROSS JOIN (SELECT treatment_function_code FROM specialties))
        SELECT {_KEY}, COALESCE(i.total_waiting, 0) AS total_waiting,
               COALESCE({_BREACH}, 0) AS waiting_over_18wks, COALESCE(band_52_plus, 0) AS waiting_over_52wks,
               COALESCE(completed_admitted, 0) AS completed_admitted,
               COALESCE(completed_non_admitted, 0) AS completed_non_admitted,
               COALESCE(total_completed, 0) AS total_completed, COALESCE(new_rtt_periods, 0) AS new_rtt_periods,
               p.median_wait_weeks AS avg_median_wait_weeks, round(p.percentile_92_wait_weeks, 6) AS avg_p92_wait_weeks
        FROM grid LEFT JOIN incomplete i USING ({_KEY}) LEFT JOIN pivoted p USING ({_KEY})
             LEFT JOIN new_periods n USING ({_KEY})""",
    "mart_national_monthly": f"""
        SELECT *, CAST(year(period_date) AS INTEGER) AS year, {_fy('period_date')} AS financial_year,
               {_fq('period_date')} AS financial_quarter, CAST({_covid('period_date')} AS INTEGER) AS is_covid_period
        FROM national""",
    "mart_national_all_keys": f"""
        SELECT *, CAST(year(period_date) AS INTEGER) AS year, {_fy('period_date')} AS financial_year,
               {_fq('period_date')} AS financial_quarter, CAST({_covid('period_date')} AS INTEGER) AS is_covid_period
        FROM month_totals""",
    "q1_national_trend": f"""
        SELECT period_date, {_fy('period_date')} AS financial_year,
               CAST({_covid('period_date')} AS INTEGER) AS is_covid_period, total_waiting, total_completed,
               new_rtt_periods, breach_rate_pct,
               round(AVG(total_waiting) OVER (ORDER BY period_date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 6)
                   AS rolling_12m_avg,
               total_waiting - LAG(total_waiting) OVER (ORDER BY period_date) AS mom_change,
               total_waiting - LAG(total_waiting, 12) OVER (ORDER BY period_date) AS yoy_change
        FROM national""",
    "q2_core_insight": f"""
        SELECT full_date, {_fy('full_date')} AS financial_year,
               CAST({_covid('full_date')} AS INTEGER) AS is_covid_period,
               COALESCE(new_rtt_periods, 0) AS new_referrals, COALESCE(total_completed, 0) AS total_treated,
               COALESCE(total_waiting, 0) AS total_waiting,
               COALESCE(new_rtt_periods, 0) - COALESCE(total_completed, 0) AS net_flow,
               {_ratio('COALESCE(new_rtt_periods, 0)', 'COALESCE(total_completed, 0)')} AS referral_to_treatment_ratio,
               {_pct('new_rtt_periods', "(SELECT new_rtt_periods FROM month_totals WHERE period_date = DATE '2020-01-01')")}
                   AS referral_index_vs_jan2020
        FROM calendar LEFT JOIN month_totals ON full_date = period_date""",
    "q2_index_vs_start": f"""
        SELECT period_date, new_rtt_periods AS new_referrals, total_completed AS total_treated, total_waiting,
               net_list_change, treatment_per_referral_ratio,
               {_pct('new_rtt_periods', 'FIRST_VALUE(new_rtt_periods) OVER (ORDER BY period_date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)')}
                   AS referral_index_vs_start
        FROM national""",
    "q3_long_waiters": f"""
        SELECT period_date, {_fy('period_date')} AS financial_year, total_waiting, waiting_over_18wks,
               waiting_over_52wks, {_LONG} AS long_waiter_pct, breach_rate_pct,
               waiting_over_52wks - LAG(waiting_over_52wks) OVER (ORDER BY period_date) AS long_waiters_mom_change
        FROM national""",
    "q4_specialty_pressure": f"""
        SELECT financial_year, treatment_function_name, specialty_group, {_big('total_waiting')} AS sum_waiting,
               round(SUM(total_waiting)::DOUBLE / COUNT(DISTINCT period_date), 6) AS avg_monthly_waiting,
               {_big('new_rtt_periods')} AS total_new_referrals, {_big('total_completed')} AS total_treated,
               {_big('new_rtt_periods')} - {_big('total_completed')} AS cumulative_demand_gap,
               {_pct('SUM(total_completed)', 'SUM(new_rtt_periods)')} AS throughput_pct,
               round(SUM(median_sum) / NULLIF(SUM(median_n), 0), 6) AS avg_median_wait_weeks,
               {_pct('SUM(waiting_over_52wks)', 'SUM(total_waiting)')} AS long_waiter_pct
        FROM summary GROUP BY 1, 2, 3 HAVING SUM(total_waiting) > 0""",
    "q4_specialty_alltime": f"""
        SELECT treatment_function_name, {_big('total_waiting')} AS total_waiting,
               {_big('new_rtt_periods')} AS total_referrals, {_big('total_completed')} AS total_treated,
               {_big('new_rtt_periods')} - {_big('total_completed')} AS cumulative_demand_gap,
               {_pct('SUM(total_completed)', 'SUM(new_rtt_periods)')} AS throughput_pct,
               {_pct('SUM(waiting_over_52wks)', 'SUM(total_waiting)')} AS long_waiter_pct
        FROM summary GROUP BY 1 HAVING SUM(total_waiting) > 0""",
    "q5_regional": f"""
        SELECT period_date, financial_year, region_code, region_name, total_waiting,
               new_rtt_periods AS new_referrals, total_completed AS total_treated,
               round({_ratio('new_rtt_periods', 'AVG(new_rtt_periods) OVER (PARTITION BY period_date)')}, 6)
                   AS referral_index_vs_national,
               {_BREACH_PCT} AS breach_rate_pct, {_LONG} AS long_waiter_pct
        FROM region_months""",
    "q6_trust_scorecard": f"""
        SELECT provider_org_code, provider_org_name, region_name, financial_year, {_big('total_waiting')} AS sum_waiting,
               round(SUM(total_waiting)::DOUBLE / COUNT(DISTINCT period_date), 6) AS avg_monthly_waiting,
               round(SUM(median_sum) / NULLIF(SUM(median_n), 0), 6) AS avg_median_wait_weeks,
               {_pct('SUM(waiting_over_18wks)', 'SUM(total_waiting)')} AS breach_rate_pct,
               {_pct('SUM(total_completed)', 'SUM(new_rtt_periods)')} AS throughput_pct,
               {_big('new_rtt_periods')} - {_big('total_completed')} AS referral_vs_treatment_gap,
               CAST(RANK() OVER (PARTITION BY region_name, financial_year
                    ORDER BY {_pct('SUM(waiting_over_18wks)', 'SUM(total_waiting)')} DESC) AS INTEGER)
                   AS breach_rank_in_region
        FROM summary GROUP BY 1, 2, 3, 4 HAVING SUM(total_waiting) > 0""",
    "q6_trust_alltime": f"""
        SELECT provider_org_code, provider_org_name, region_code, {_big('total_waiting')} AS total_waiting,
               round(AVG(avg_median_wait_weeks), 6) AS avg_median_wait_weeks,
               {_pct('SUM(waiting_over_18wks)', 'SUM(total_waiting)')} AS breach_rate_pct,
               {_pct('SUM(total_completed)', 'SUM(new_rtt_periods)')} AS throughput_pct,
               {_big('new_rtt_periods')} - {_big('total_completed')} AS referral_vs_treatment_gap,
               CAST(RANK() OVER (PARTITION BY region_code
                    ORDER BY {_pct('SUM(waiting_over_18wks)', 'SUM(total_waiting)')} DESC) AS INTEGER)
                   AS breach_rank_in_region
        FROM summary GROUP BY 1, 2, 3 HAVING SUM(total_waiting) > 0""",
    "q7_recovery_regional": f"""
        WITH totals AS (
            SELECT period_date, region_name,
                   CAST(SUM(CASE WHEN l_linestatus = 'O' THEN patients END) AS BIGINT) AS total_waiting,
                   CAST(SUM(CASE WHEN l_linestatus = 'F' THEN patients END) AS BIGINT) AS total_completed,
                   COUNT(*) AS new_rtt_periods
            FROM raw_lines GROUP BY 1, 2)
        SELECT period_date, {_fy('period_date')} AS financial_year, region_name,
               {_recovery('PARTITION BY region_name', _BASE_MONTHS)}
        FROM totals WHERE period_date >= DATE '2019-04-01'""",
    "q7_recovery_national": f"""
        SELECT period_date, total_waiting, new_rtt_periods, total_completed, {_recovery('', _BASE_MONTHS)}
        FROM national WHERE period_date >= DATE '2019-04-01'""",
    "suppression_flag": f"""
        WITH t AS (SELECT period_date, total_waiting,
                          {_ratio('new_rtt_periods', 'total_completed')} AS referral_to_treatment_ratio,
                          total_waiting - LAG(total_waiting) OVER (ORDER BY period_date) AS list_change FROM national)
        SELECT *, COALESCE(referral_to_treatment_ratio < 1 AND list_change < 0, FALSE) AS demand_suppressed FROM t""",
    "suppression_flag_all_keys": f"""
        WITH t AS (SELECT period_date, total_waiting,
                          {_ratio('new_rtt_periods', 'total_completed')} AS referral_to_treatment_ratio,
                          total_waiting - LAG(total_waiting) OVER (ORDER BY period_date) AS list_change FROM month_totals)
        SELECT *, COALESCE(referral_to_treatment_ratio < 1 AND list_change < 0, FALSE) AS demand_suppressed FROM t""",
    "ratio_trend": f"""
        WITH t AS (SELECT period_date, {_ratio('new_rtt_periods', 'total_completed')} AS referral_to_treatment_ratio
                   FROM national)
        SELECT *, CAST(sign(referral_to_treatment_ratio
                            - LAG(referral_to_treatment_ratio) OVER (ORDER BY period_date)) AS INTEGER) AS trend
        FROM t""",
    "headline_periods": " UNION ALL ".join(
        _headline(label, condition)
        for label, condition in (
            ("Pre-COVID", f"{_fy('period_date')} = '2019/20'"),
            ("COVID peak", "period_date BETWEEN DATE '2020-04-01' AND DATE '2020-06-01'"),
            ("Latest year", f"{_fy('period_date')} = (SELECT MAX({_fy('period_date')}) FROM national)"),
        )
    ),
    "scatter_trust": f"""
        SELECT provider_org_code,
               round({_pct('SUM(new_rtt_periods)::DOUBLE / COUNT(DISTINCT period_date)', "SUM(CASE WHEN period_date = DATE '2020-01-01' THEN new_rtt_periods END)")}, 6)
                   AS referral_index,
               {_pct('SUM(waiting_over_18wks)', 'SUM(total_waiting)')} AS breach_rate_pct
        FROM summary GROUP BY 1""",
    "jp1_waiting_by_fy_region_trust_tf": f"""
        SELECT {_fy('period_date')} AS financial_year, region_name, provider_org_name, treatment_function_name,
               {_big('total_waiting')} AS total_waiting, {_big('band_52_plus')} AS long_waiters_52_plus,
               round(AVG(percentile_92_wait_weeks), 5) AS avg_p92_wait
        FROM incomplete JOIN providers USING (provider_org_code) JOIN specialties USING (treatment_function_code)
        GROUP BY 1, 2, 3, 4""",
    "jp2_completed_by_pathway": f"""
        SELECT {_fy('period_date')} AS financial_year, region_name, treatment_function_name, pathway_type,
               {_big('total_completed')} AS total_completed, round(AVG(median_wait_weeks), 6) AS avg_median_wait
        FROM completed JOIN providers USING (provider_org_code) JOIN specialties USING (treatment_function_code)
        GROUP BY 1, 2, 3, 4""",
    "jp3_referral_demand": f"""
        SELECT {_fy('period_date')} AS financial_year, region_name, treatment_function_name,
               {_big('new_rtt_periods')} AS new_rtt_periods
        FROM new_periods JOIN providers USING (provider_org_code) JOIN specialties USING (treatment_function_code)
        GROUP BY 1, 2, 3""",
    "jp4_band_distribution": "SELECT * FROM distribution",
    "jp5_suppression_signal": f"""
        SELECT period_date, {_fy('period_date')} AS financial_year, monthname(period_date) AS month_name,
               CAST({_covid('period_date')} AS INTEGER) AS is_covid_period, total_waiting, total_completed,
               new_rtt_periods, {_ratio('total_completed', 'new_rtt_periods')} AS treatment_per_referral_ratio,
               total_waiting - LAG(total_waiting) OVER (ORDER BY period_date) AS mom_list_change
        FROM month_totals WHERE total_waiting IS NOT NULL""",
    "drilldown_validation": f"""
        SELECT period_date, region_name, provider_org_name, treatment_function_name,
               {_fy('period_date')} AS financial_year, monthname(period_date) AS month_name,
               {_big('total_waiting')} AS total_waiting
        FROM incomplete JOIN providers USING (provider_org_code) JOIN specialties USING (treatment_function_code)
        GROUP BY ALL ORDER BY 1, 2, 3, 4 LIMIT 50""",
    "breach_analysis": """
        SELECT * FROM distribution WHERE is_breach = 1
        ORDER BY financial_year, patients_waiting DESC, region_name, treatment_function_name, band_label LIMIT 50""",
    "band_breach_totals": f"""
        SELECT band_label, is_breach, {_big('patients_waiting')} AS patients_waiting FROM banded GROUP BY 1, 2""",
    "nb_national": "SELECT * FROM series",
    "nb_series_aligned": "SELECT * FROM month_totals",
    "nb_ratio_regime": """
        SELECT period_date, rtt_ratio, CASE WHEN rtt_ratio < 1 THEN 'more treated than referred'
               WHEN rtt_ratio > 1 THEN 'list growing' ELSE 'level' END AS regime FROM series""",
    "covid_bounds": """
        SELECT MIN(period_date) AS covid_start, MAX(period_date) AS covid_end FROM series WHERE is_covid""",
    "nb_summary": "SELECT * FROM blocks",
    "nb_summary_formatted": """
        SELECT block, format('{:,}', CAST(round_even(new_referrals_per_month, 0) AS BIGINT)) AS new_referrals_per_month,
               format('{:,}', CAST(round_even(treatments_per_month, 0) AS BIGINT)) AS treatments_per_month,
               format('{:,}', CAST(round_even(waiting_list, 0) AS BIGINT)) AS waiting_list,
               format('{:.3f}', rtt_ratio) AS rtt_ratio FROM blocks""",
    "latest_month_slice": f"""
        SELECT period_date, provider_org_code, treatment_function_name, total_waiting, band_52_plus AS waiting_over_52wks
        FROM incomplete JOIN specialties USING (treatment_function_code)
        WHERE period_date = (SELECT MAX(period_date) FROM incomplete)""",
    "nb_top_specialties": f"""
        SELECT treatment_function_name, {_big('band_52_plus')} AS waiting_over_52wks
        FROM incomplete JOIN specialties USING (treatment_function_code)
        WHERE period_date = (SELECT MAX(period_date) FROM incomplete)
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12""",
    "top10_specialties": f"""
        SELECT treatment_function_name, {_big('waiting_over_52wks')} AS waiting_over_52wks
        FROM summary GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "slice_dice": f"""
        SELECT {', '.join(_SUMMARY_NAMES[:6])}, total_waiting, new_rtt_periods, total_completed FROM summary
        WHERE financial_year IN ('2021/22', '2022/23', '2023/24') AND region_name = 'ASIA'
              AND specialty_group = 'Medical' AND NOT {_covid('period_date')}
              AND contains(lower(provider_org_name), 'supplier#0000000')""",
    "matrix_region_fy": _matrix(),
    "drilldown_rollup": f"""
        WITH t AS (SELECT *, {_fy('period_date')} AS financial_year, {_fq('period_date')} AS financial_quarter
                   FROM national)
        SELECT financial_year, financial_quarter, period_date,
               CAST(GROUPING_ID(financial_year, financial_quarter, period_date) AS INTEGER) AS level, {_GROUPED}
        FROM t GROUP BY ROLLUP (financial_year, financial_quarter, period_date)""",
    "peak_long_waiters": """
        SELECT period_date AS peak_month, waiting_over_52wks AS peak_value FROM national
        ORDER BY 2 DESC, 1 LIMIT 1""",
    "long_waiters_by_specialty": f"""
        SELECT period_date, treatment_function_name, {_big('waiting_over_52wks')} AS waiting_over_52wks
        FROM summary GROUP BY 1, 2""",
    "waterfall_long_waiters": f"""
        WITH t AS (SELECT period_date, treatment_function_name, {_big('waiting_over_52wks')} AS waiting_over_52wks
                   FROM summary GROUP BY 1, 2),
             c AS (SELECT *, waiting_over_52wks - LAG(waiting_over_52wks)
                             OVER (PARTITION BY treatment_function_name ORDER BY period_date) AS change FROM t)
        SELECT period_date, treatment_function_name, waiting_over_52wks,
               CASE WHEN change IS NOT NULL THEN greatest(change, 0) END AS added,
               CASE WHEN change IS NOT NULL THEN least(change, 0) END AS cleared
        FROM c""",
    "m_core": """
        SELECT financial_year, region_name, total_waiting, waiting_over_18wks AS waiting_over_18_weeks,
               waiting_over_52wks AS long_waiters_52_plus, total_completed AS total_treated,
               new_rtt_periods AS new_referrals FROM region_years""",
    "m_rates": f"""
        SELECT financial_year, region_name, COALESCE({_BREACH_PCT}, 0) AS breach_rate_pct,
               COALESCE({_LONG}, 0) AS long_waiter_rate_pct FROM region_years""",
    "m_mom": f"""
        SELECT period_date, region_name, total_waiting, total_waiting - {_shift('total_waiting', 1)} AS waiting_mom_change
        FROM region_months a""",
    "m_mom_blank_as_zero": f"""
        SELECT period_date, region_name, total_waiting,
               total_waiting - COALESCE({_shift('total_waiting', 1)}, 0) AS waiting_mom_change FROM region_months a""",
    "m_yoy": f"""
        WITH t AS (SELECT period_date, region_name, total_waiting, {_shift('total_waiting', 12)} AS before
                   FROM region_months a)
        SELECT period_date, region_name, total_waiting, total_waiting - before AS waiting_yoy_change,
               {_pct('total_waiting - before', 'before')} AS waiting_yoy_pct FROM t""",
    "m_ratio_flow": f"""
        SELECT financial_year, region_name, {_ratio('new_rtt_periods', 'total_completed')} AS referral_to_treatment_ratio,
               new_rtt_periods - total_completed AS net_flow,
               new_rtt_periods - total_completed AS referral_suppression_signal FROM region_years""",
    "m_index_jan2020": f"""
        SELECT a.period_date, a.region_name,
               {_pct('a.new_rtt_periods', 'b.new_rtt_periods')} AS referral_index_vs_jan2020,
               {_pct('a.total_completed', 'b.total_completed')} AS treatment_index_vs_jan2020
        FROM region_months a LEFT JOIN region_months b
             ON a.region_name = b.region_name AND b.period_date = DATE '2020-01-01'""",
    "m_throughput": f"""
        SELECT financial_year, region_name, COALESCE({_pct('total_completed', 'new_rtt_periods')}, 0)
                   AS throughput_rate_pct FROM region_years""",
    "m_lw_mom": f"""
        SELECT period_date, region_name, waiting_over_52wks,
               waiting_over_52wks - {_shift('waiting_over_52wks', 1)} AS long_waiter_mom_change FROM region_months a""",
    "m_lw_12m": f"""
        WITH t AS (SELECT period_date, region_name, waiting_over_52wks, {_shift('waiting_over_52wks', 12)} AS before
                   FROM region_months a)
        SELECT period_date, region_name, {_pct('waiting_over_52wks - before', 'before')} AS long_waiter_12m_reduction_pct
        FROM t""",
    "m_admitted_share": f"""
        SELECT financial_year, region_name, COALESCE({_pct('completed_admitted', 'total_completed')}, 0)
                   AS admitted_share_pct FROM region_years""",
    "m_avg_median_wait": """
        SELECT region_name, round(AVG(m), 6) AS avg_median_wait_weeks
        FROM (SELECT region_name, AVG(avg_median_wait_weeks) AS m FROM summary
              GROUP BY region_name, period_date, provider_org_name, treatment_function_name) GROUP BY 1""",
    "m_avg_p92": """
        SELECT region_name, round(AVG(avg_p92_wait_weeks), 5) AS avg_p92_wait_weeks FROM summary GROUP BY 1""",
    "m_regional_breach": f"""
        SELECT financial_year, region_name, COALESCE({_BREACH_PCT}, 0) AS regional_breach_rate_pct
        FROM region_years""",
    "m_vs_national_breach": f"""
        SELECT period_date, region_name, COALESCE({_BREACH_PCT}, 0)
               - COALESCE({_pct('SUM(waiting_over_18wks) OVER w', 'SUM(total_waiting) OVER w')}, 0)
                   AS vs_national_breach_rate
        FROM region_months WINDOW w AS (PARTITION BY period_date)""",
    "m_regional_index": f"""
        SELECT period_date, region_name,
               round({_ratio('new_rtt_periods', 'AVG(new_rtt_periods) OVER (PARTITION BY period_date)')}, 6)
                   AS regional_referral_index
        FROM region_months""",
    "m_roll3_waiting": """
        SELECT a.period_date, a.region_name, round(AVG(b.total_waiting), 6) AS waiting_3m_avg
        FROM region_months a JOIN region_months b ON a.region_name = b.region_name
             AND b.period_date BETWEEN a.period_date - INTERVAL 2 MONTH AND a.period_date GROUP BY 1, 2""",
    "m_roll12_referrals": """
        SELECT a.period_date, a.region_name, round(AVG(b.new_rtt_periods), 6) AS referrals_12m_avg
        FROM region_months a JOIN region_months b ON a.region_name = b.region_name
             AND b.period_date BETWEEN a.period_date - INTERVAL 11 MONTH AND a.period_date GROUP BY 1, 2""",
    "m_fytd_treated": """
        SELECT a.period_date, a.financial_year, a.region_name, CAST(SUM(b.total_completed) AS BIGINT) AS fytd_treated
        FROM region_months a JOIN region_months b ON a.region_name = b.region_name
             AND a.financial_year = b.financial_year AND b.period_date <= a.period_date GROUP BY 1, 2, 3""",
    "dq_missing_keys": " UNION ALL ".join(
        [
            _missing("fact_rtt_incomplete_star", "incomplete"),
            _missing("fact_rtt_completed_star", "completed"),
            _missing("fact_rtt_new_periods_star", "new_periods"),
            _missing("fact_rtt_wait_band_star", "banded", band=True),
        ]
    ),
    "dq_orphans": " UNION ALL ".join(
        [
            _orphans(
                "l_suppkey",
                "(SELECT CASE WHEN l_suppkey % 10 = 0 THEN -l_suppkey ELSE l_suppkey END AS l_suppkey FROM lineitem)",
                "supplier",
                "l_suppkey",
                "s_suppkey",
            ),
            _orphans("l_partkey", "lineitem", "part", "l_partkey", "p_partkey"),
            _orphans("l_orderkey", "lineitem", "orders", "l_orderkey", "o_orderkey"),
            _orphans("s_nationkey", "supplier", "nation", "s_nationkey", "n_nationkey"),
        ]
    ),
    "dq_negative": " UNION ALL ".join(
        f"SELECT '{m}' AS measure, COUNT(*) FILTER ({m} < 0) AS n_negative FROM {t}"
        for m, t in (
            ("total_waiting", "incomplete"),
            ("completed_admitted", "pivoted"),
            ("completed_non_admitted", "pivoted"),
            ("new_rtt_periods", "new_periods"),
        )
    ),
    "dq_duplicate_codes": " UNION ALL ".join(
        f"""SELECT '{n}' AS dimension, COUNT(*) AS n_codes, COUNT(*) FILTER (c > 1) AS n_duplicated
            FROM (SELECT COUNT(*) AS c FROM {t} GROUP BY {k})"""
        for n, t, k in (
            ("provider", "supplier", "s_suppkey"),
            ("region", "region", "r_regionkey"),
            ("specialty", "functions", "treatment_function_code"),
            ("specialty_source", "part", "p_brand"),
        )
    ),
    "dq_not_null": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER ({c} IS NULL) AS n_null FROM summary" for c in _SUMMARY_NAMES
    ),
    "dq_expected_counts": f"""
        WITH t AS (SELECT 'dim_date' AS table_name, COUNT(*) AS row_count FROM calendar
                   UNION ALL SELECT 'dim_trust', COUNT(*) FROM trusts UNION ALL SELECT 'dim_region', COUNT(*) FROM regions
                   UNION ALL SELECT 'dim_treatment_function', COUNT(*) FROM functions
                   UNION ALL SELECT 'dim_wait_band', COUNT(*) FROM bands)
        SELECT table_name, row_count, CAST(e AS BIGINT) AS expected_count, row_count - e AS difference
        FROM t JOIN (VALUES {_values(list(S.EXPECTED_COUNTS.items()))}) AS x(table_name, e) USING (table_name)""",
    "dq_band_total": f"""
        SELECT period_date, COUNT(*) AS n_rows,
               COUNT(*) FILTER (total_waiting <> {' + '.join(S.BAND_COLUMNS)}) AS n_different,
               CAST(SUM(total_waiting - ({' + '.join(S.BAND_COLUMNS)})) AS BIGINT) AS total_gap
        FROM silver GROUP BY period_date""",
    "table_row_counts": """
        SELECT 'fact_rtt_incomplete' AS table_name, COUNT(*) AS row_count FROM incomplete
        UNION ALL SELECT 'fact_rtt_completed', COUNT(*) FROM completed
        UNION ALL SELECT 'fact_rtt_new_periods', COUNT(*) FROM new_periods""",
    "period_coverage": """
        SELECT MIN(period_date) AS earliest_period, MAX(period_date) AS latest_period,
               COUNT(DISTINCT period_date) AS months_loaded FROM incomplete""",
    "profile_sources": " UNION ALL ".join(
        f"""SELECT '{n}' AS source, COUNT(*) AS n_rows, COUNT(DISTINCT period_date) AS n_months,
                   COUNT(DISTINCT provider_org_code) AS n_trusts, MIN(period_date) AS first_month,
                   MAX(period_date) AS last_month FROM {t}"""
        for n, t in (
            ("Incomplete", "incomplete"),
            ("Admitted", "(SELECT * FROM completed WHERE pathway_type = 'Admitted')"),
            ("Non-admitted", "(SELECT * FROM completed WHERE pathway_type = 'Non-Admitted')"),
            ("New periods", "new_periods"),
        )
    ),
}


def _complete(sql: str) -> str:
    """A query that brings its own expressions keeps them behind the shared ones."""
    own = sql.strip()
    if not own.startswith("WITH "):
        return with_ctes(own)
    shared = with_ctes(own)
    if shared == own:
        return own
    head = shared[: -len(own)].rstrip()
    return head + ",\n" + own[len("WITH ") :]


ORACLES = {name: _complete(sql) for name, sql in {**_SQL, **stored_oracle.SQL}.items()}
