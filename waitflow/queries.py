"""Registered queries: name -> (spark, directory) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waitflow import schemas as S
from waitflow import stored_queries
from waitflow.data import SITE, Data
from waitflow.functions import calendar, numeric, text
from waitflow.operators import clean, keys
from waitflow.plans import dims, explore, facts, kpis, marts, measures, notebook, patterns, quality, stars
from waitflow.sources import links, raw_sheets, sheets
from waitflow.sources.pathways import with_specialty

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Data], DataFrame]) -> Callable[[Data], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, directory: fn(Data(spark, directory))
    return fn


# --- cleaning and ingest -------------------------------------------------------------------------------


@query
def parse_period(d: Data) -> DataFrame:
    """Period texts of both spellings, and unreadable ones, by the month they parse to."""
    day = F.col("o_orderdate")
    month = F.add_months(F.trunc(F.to_date(day), "MM"), 291)
    status = F.col("o_orderstatus")
    spelled = (
        F.when(status == "F", F.date_format(month, "MMMM yyyy"))
        .when(status == "O", F.date_format(month, "yyyy-MM-dd"))
        .otherwise("Unknown")
    )
    texts = d.table("orders").select(spelled.alias("period_text"))
    parsed = texts.withColumn("period_date", text.parse_period(F.col("period_text")))
    return parsed.groupBy("period_text", "period_date").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def coerce_numeric(d: Data) -> DataFrame:
    """Count cells as published: decimals, whole numbers and suppression marks."""
    flag, count = F.col("l_returnflag"), F.col("l_quantity")
    cell = (
        F.when(flag == "R", count.cast("string"))
        .when(flag == "A", F.concat(F.lit(" "), count.cast("int").cast("string")))
        .otherwise("*")
    )
    cells = d.table("lineitem").select(flag.alias("l_returnflag"), cell.alias("cell"))
    return cells.groupBy("l_returnflag").agg(
        F.sum(numeric.to_count(F.col("cell"))).alias("total"),
        F.count(numeric.to_double(F.col("cell"))).alias("n_numbers"),
    )


def _labelled_weekly(d: Data) -> DataFrame:
    return d.label(raw_sheets.weekly_sums(d.rows()))


def _incomplete_sheet(d: Data) -> DataFrame:
    return raw_sheets.incomplete_sheet(_labelled_weekly(d))


@query
def clean_rows(d: Data) -> DataFrame:
    """New-period sheet rows per provider code after stray rows are dropped."""
    sheet = raw_sheets.new_periods_sheet(d.label(facts.new_periods(d.rows())))
    kept = clean.clean_rows(clean.rename_core(sheet))
    return kept.groupBy("provider_org_code").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def band_collapse(d: Data) -> DataFrame:
    """The 53 weekly columns of each month collapsed to twelve bands."""
    weekly = raw_sheets.weekly_sums(d.rows(specialty=False), ["period_date"])
    as_text = weekly.select("period_date", *[F.col(f"`{h}`").cast("string").alias(h) for h in raw_sheets.WEEK_HEADINGS])
    return as_text.select("period_date", *clean.band_columns(as_text.columns))


@query
def silver_incomplete(d: Data) -> DataFrame:
    return clean.silver_incomplete(_incomplete_sheet(d)).drop("median_wait_weeks", "percentile_92_wait_weeks")


@query
def silver_completed(d: Data) -> DataFrame:
    done = d.label(facts.completed(d.rows()))
    sheets_by_pathway = [
        clean.silver_completed(raw_sheets.completed_sheet(done.filter(F.col("pathway_type") == p), kind), p)
        for p, kind in ((S.ADMITTED, "Admitted-Provider"), (S.NON_ADMITTED, "NonAdmitted-Provider"))
    ]
    return quality.stack(sheets_by_pathway)


@query
def silver_new_periods(d: Data) -> DataFrame:
    return clean.silver_new_periods(raw_sheets.new_periods_sheet(d.label(facts.new_periods(d.rows()))))


@query
def dedup_first(d: Data) -> DataFrame:
    """First row per month, provider and specialty; the line number stands for the file."""
    ordered = d.rows().withColumnsRenamed({"l_linenumber": "file_no", "l_orderkey": "row_idx"})
    # The id stands for the code, which is spelled for the rows that are left.
    first = keys.keep_first(ordered, facts.GRAIN, ["file_no", "row_idx", "patients", "wait_week"])
    return d.coded(first).select(*S.CELL_KEY, "file_no", "row_idx", "patients", "wait_week")


@query
def ingest_incomplete(d: Data) -> DataFrame:
    """Processed rows written as CSV lines and read back with the fixed schema."""
    frame = d.sourced(d.label(facts.incomplete(d.rows())), "Incomplete-Provider").withColumn(
        "period_date", F.date_format("period_date", "yyyy-MM-dd")
    )
    lines = frame.select(F.to_csv(F.struct(*S.INCOMPLETE_CSV.fieldNames())).alias("line"))
    return lines.select(F.from_csv("line", F.lit(S.ddl(S.INCOMPLETE_CSV))).alias("r")).select("r.*")


def _sheet_texts(d: Data) -> DataFrame:
    return raw_sheets.sheet_texts(d.label(raw_sheets.week_maps(d.rows(), dealt_by=["period_date", "provider_id"])))


@query
def ingest_preamble(d: Data) -> DataFrame:
    """Sheet texts with preamble through to cleaned rows; unreadable files are set aside."""
    rows = sheets.sheet_rows(_sheet_texts(d), raw_sheets.INCOMPLETE_HEADINGS)
    good, _ = clean.split_rejects(rows)
    silver = clean.silver_incomplete(good)
    return silver.drop("median_wait_weeks", "percentile_92_wait_weeks")


@query
def ingest_rejects(d: Data) -> DataFrame:
    return sheets.file_status(_sheet_texts(d)).filter("status <> 'ok'")


@query
def load_batch_incomplete(d: Data) -> DataFrame:
    """One batch out of a staging frame tagged by financial year."""
    month = F.col("period_date")
    staged = facts.incomplete(d.rows()).withColumn(
        "load_batch_id", F.concat(F.lit("incomplete_"), calendar.financial_year(month))
    )
    loaded = stars.batch(staged, "incomplete_2021/22")
    return loaded.groupBy("load_batch_id", "period_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("total_waiting").alias("total_waiting")
    )


# The link classes used on the crawled pages.
PAGE_KINDS = [("tion", "kind_tion"), ("en", "kind_en"), ("e", "kind_e"), ("a", "kind_a")]
PAGE_EXTENSIONS = ["n", "e", "s", "r"]


def _page_links(d: Data, *carried: Column) -> DataFrame:
    return links.classified_links(d.table("pages"), SITE, PAGE_KINDS, PAGE_EXTENSIONS, carried)


@query
def links_classified(d: Data) -> DataFrame:
    return _page_links(d)


def _grouped_links(d: Data) -> DataFrame:
    """Links with the group of their page; files of the secure pages count as already there."""
    url = F.col("url")
    group, there = F.regexp_extract(url, "/([a-z]{2})/", 1), F.coalesce(url.startswith("https"), F.lit(False))
    return _page_links(d, group.alias("page_group"), there.alias("there"))


@query
def manifest_counts(d: Data) -> DataFrame:
    return links.count_new(links.linked_files(_grouped_links(d), "page_group", "there"), "page_group")


@query
def manifest_new_files(d: Data) -> DataFrame:
    return links.linked_files(_grouped_links(d), "page_group", "there").filter("known IS NULL").drop("known")


@query
def fy_slugs(d: Data) -> DataFrame:
    """Financial year slugs of the periods in the data."""
    start = F.year(F.add_months(F.col("period_date"), -3))
    rows = d.rows(specialty=False).groupBy(start.alias("start_year")).agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.select("start_year", calendar.fy_slug(F.col("start_year")).alias("slug"), "n_rows")


# --- dimensions ----------------------------------------------------------------------------------------


@query
def dim_date(d: Data) -> DataFrame:
    months = dims.months_between_extremes(d.rows(specialty=False))
    return dims.dim_date(months)


@query
def dim_date_insert_ignore(d: Data) -> DataFrame:
    """A calendar holding the months of one order status, topped up with every month of the data."""
    month = F.add_months(F.trunc(F.to_date("o_orderdate"), "MM"), 291).alias("full_date")
    early = d.table("orders").filter(F.col("o_orderpriority") == "1-URGENT").select(month).distinct()
    existing = dims.dim_date(early.filter(F.year("full_date") < 2022)).withColumn("month_name", F.upper("month_name"))
    incoming = dims.dim_date(d.table("orders").select(month).distinct())
    return keys.insert_ignore(existing, incoming, "date_key")


@query
def dim_region(d: Data) -> DataFrame:
    return d.dim_region()


@query
def dim_region_upsert(d: Data) -> DataFrame:
    """The seed regions with the regions of the data upserted."""
    incoming = d.regions().withColumn("nhs_region_abbrev", F.upper(F.substring("region_name", 1, 3)))
    return keys.upsert(dims.dim_region(d.spark), incoming, "region_code", "region_key", ["region_name"], bounded=True)


@query
def dim_wait_band(d: Data) -> DataFrame:
    """The bands with the patients found in each."""
    sums = d.rows(specialty=False).agg(*facts.band_sums("is_open"))
    found = facts.banded(sums, [])
    return dims.dim_wait_band(d.spark).join(found, "band_label", "left")


@query
def dim_treatment_function(d: Data) -> DataFrame:
    return d.dim_treatment_function()


@query
def dim_treatment_function_upsert(d: Data) -> DataFrame:
    """The seed specialties with the specialties of the data upserted."""
    return keys.upsert(
        dims.seed_treatment_functions(d.spark),
        d.specialties(),
        "treatment_function_code",
        "treatment_function_key",
        ["treatment_function_name"],
        bounded=True,
    )


@query
def dim_trust(d: Data) -> DataFrame:
    return d.dim_trust()


@query
def dim_trust_upsert(d: Data) -> DataFrame:
    """Providers in credit are known under an old name; everyone seen in the data is upserted."""
    supplier = d.table("supplier").withColumn("provider_id", F.col("s_suppkey"))
    codes = d.coded(supplier.filter("s_acctbal > 0").select("provider_id"))
    known = keys.with_surrogate_key(codes, "provider_org_code", "trust_key")
    existing = known.select(
        F.col("provider_org_code").alias("trust_code"),
        "trust_key",
        F.concat(F.lit("old "), F.col("provider_org_code")).alias("trust_name"),
        F.lit(0).alias("region_key"),
        F.lit(1).alias("is_active"),
    )
    incoming = d.dim_trust().drop("trust_key")
    return keys.upsert(existing, incoming, "trust_code", "trust_key", ["trust_name", "region_key"])


# --- facts and stars -----------------------------------------------------------------------------------


@query
def fact_incomplete_banded(d: Data) -> DataFrame:
    return stars.load_incomplete(d.incomplete(), d.dim_trust(), d.dim_treatment_function(), d.dim_wait_band())


@query
def fact_completed_pivoted(d: Data) -> DataFrame:
    return stars.load_completed(d.completed(), d.dim_trust(), d.dim_treatment_function())


@query
def fact_new_periods(d: Data) -> DataFrame:
    return stars.load_new_periods(d.new_periods(), d.dim_trust(), d.dim_treatment_function())


def _star_incomplete(d: Data) -> DataFrame:
    return stars.star_incomplete(d.sourced(d.incomplete(), "Incomplete-Provider"), d.dimensions())


def _star_completed(d: Data) -> DataFrame:
    done = d.completed()
    admitted, other = (
        d.sourced(done.filter(F.col("pathway_type") == p).drop("pathway_type"), kind)
        for p, kind in ((S.ADMITTED, "Admitted-Provider"), (S.NON_ADMITTED, "NonAdmitted-Provider"))
    )
    return stars.star_completed(stars.union_pathways(admitted, other), d.dimensions())


def _star_new_periods(d: Data) -> DataFrame:
    return stars.star_new_periods(d.sourced(d.new_periods(), "New-Periods-Provider"), d.dimensions())


def _star_wait_band(d: Data) -> DataFrame:
    return stars.star_wait_band(d.incomplete(), d.dimensions())


@query
def star_incomplete(d: Data) -> DataFrame:
    return _star_incomplete(d)


@query
def star_completed(d: Data) -> DataFrame:
    return _star_completed(d)


@query
def star_new_periods(d: Data) -> DataFrame:
    return _star_new_periods(d)


@query
def star_wait_band(d: Data) -> DataFrame:
    return _star_wait_band(d)


# --- marts ---------------------------------------------------------------------------------------------

SUMMARY_COLUMNS = [
    "period_date",
    "region_code",
    "provider_org_code",
    "provider_org_name",
    "treatment_function_code",
    "treatment_function_name",
    *marts.MEASURES,
    "avg_median_wait_weeks",
    "avg_p92_wait_weeks",
]


@query
def mart_monthly_summary(d: Data) -> DataFrame:
    return d.labelled_summary(waits=True).select(*SUMMARY_COLUMNS)


@query
def mart_from_facts(d: Data) -> DataFrame:
    """The national mart from three separate fact tables, stacked and aggregated once."""
    activity = facts.activity_from_facts(d.incomplete(), d.completed(), d.new_periods())
    return marts.national_monthly(marts.monthly_summary(activity))


@query
def mart_monthly_dense(d: Data) -> DataFrame:
    """Every month of the data for every provider and specialty, zero-filled."""
    bounds = d.rows(specialty=False)
    start, end = (bounds.agg(f("period_date").alias("m")).scalar() for f in (F.min, F.max))
    dense = marts.dense_monthly(d.activity(waits=True), d.provider_ids(), d.specialties(), start, end)
    return d.coded(dense).drop("provider_id")


@query
def mart_national_monthly(d: Data) -> DataFrame:
    return calendar.with_attributes(d.national(), ["year", "financial_year", "financial_quarter", "is_covid_period"])


@query
def mart_national_all_keys(d: Data) -> DataFrame:
    """National months over every key, also those without a waiting list."""
    return calendar.with_attributes(d.month_totals(), ["year", "financial_year", "financial_quarter", "is_covid_period"])


# --- the seven questions -------------------------------------------------------------------------------


@query
def q1_national_trend(d: Data) -> DataFrame:
    return kpis.national_trend(d.national())


@query
def q2_core_insight(d: Data) -> DataFrame:
    return kpis.core_insight(d.month_totals(), d.dim_date())


@query
def q2_index_vs_start(d: Data) -> DataFrame:
    return kpis.index_vs_start(d.national())


@query
def q3_long_waiters(d: Data) -> DataFrame:
    return kpis.long_waiters(d.national())


@query
def q4_specialty_pressure(d: Data) -> DataFrame:
    return kpis.specialty_pressure(d.specialty_summary(waits=True))


@query
def q4_specialty_alltime(d: Data) -> DataFrame:
    return kpis.specialty_alltime(d.specialty_summary())


@query
def q5_regional(d: Data) -> DataFrame:
    return kpis.regional(d.labelled_summary())


@query
def q6_trust_scorecard(d: Data) -> DataFrame:
    return kpis.trust_scorecard(d.labelled_summary(waits=True))


@query
def q6_trust_alltime(d: Data) -> DataFrame:
    return kpis.trust_alltime(d.labelled_summary(waits=True))


@query
def q7_recovery_regional(d: Data) -> DataFrame:
    activity = d.label(facts.activity(d.rows(specialty=False), ["period_date", "provider_id"]))
    return kpis.recovery_regional(marts.month_totals(activity, ["region_name"]))


@query
def q7_recovery_national(d: Data) -> DataFrame:
    return kpis.recovery_national(d.national())


@query
def suppression_flag(d: Data) -> DataFrame:
    return kpis.suppression_flag(d.national())


@query
def suppression_flag_all_keys(d: Data) -> DataFrame:
    return kpis.suppression_flag(d.month_totals())


@query
def ratio_trend(d: Data) -> DataFrame:
    return kpis.ratio_trend(d.national())


@query
def headline_periods(d: Data) -> DataFrame:
    return kpis.headline_periods(d.national())


@query
def scatter_trust(d: Data) -> DataFrame:
    return kpis.scatter_trust(d.coded(d.summary()))


# --- star join patterns --------------------------------------------------------------------------------


def _by_year_rows(d: Data) -> DataFrame:
    return calendar.with_attributes(d.rows(), ["financial_year"])


def _distribution(d: Data) -> DataFrame:
    waiting = _by_year_rows(d).filter("is_open")
    bands = waiting.groupBy(*patterns.KEY).agg(*facts.band_sums())
    return patterns.band_distribution(bands, d.label, d.dim_wait_band())


@query
def jp1_waiting_by_fy_region_trust_tf(d: Data) -> DataFrame:
    return patterns.waiting_by_trust(facts.incomplete(d.rows()), d.label)


@query
def jp2_completed_by_pathway(d: Data) -> DataFrame:
    return patterns.completed_by_pathway(facts.completed(d.rows()), d.label)


@query
def jp3_referral_demand(d: Data) -> DataFrame:
    return patterns.demand(facts.new_periods(_by_year_rows(d), patterns.KEY), d.label)


@query
def jp4_band_distribution(d: Data) -> DataFrame:
    return _distribution(d)


@query
def jp5_suppression_signal(d: Data) -> DataFrame:
    return patterns.suppression_signal(d.month_totals())


@query
def drilldown_validation(d: Data) -> DataFrame:
    return patterns.drilldown_validation(facts.incomplete(d.rows()), d.label)


@query
def breach_analysis(d: Data) -> DataFrame:
    return patterns.breach_analysis(_distribution(d))


@query
def band_breach_totals(d: Data) -> DataFrame:
    sums = d.rows(specialty=False).agg(*facts.band_sums("is_open"))
    bands = F.broadcast(d.dim_wait_band().select("band_label", "is_breach"))
    return patterns.band_breach_totals(facts.banded(sums, []).join(bands, "band_label"))


# --- exploratory analysis ------------------------------------------------------------------------------


def _series(d: Data) -> DataFrame:
    return notebook.national(d.month_totals())


@query
def nb_national(d: Data) -> DataFrame:
    return _series(d)


@query
def nb_series_aligned(d: Data) -> DataFrame:
    """The three month series built one by one and aligned by a full outer join."""
    waiting = d.rows(specialty=False).filter("is_open").groupBy("period_date").agg(F.sum("patients").alias("total_waiting"))
    treated = d.rows(specialty=False).filter("is_done").groupBy("period_date").agg(F.sum("patients").alias("total_completed"))
    starts = facts.new_periods(d.rows(specialty=False), ["period_date"])
    return marts.align_series(waiting, treated, starts)


@query
def nb_ratio_regime(d: Data) -> DataFrame:
    return notebook.ratio_regime(_series(d))


@query
def covid_bounds(d: Data) -> DataFrame:
    return notebook.covid_bounds(_series(d))


@query
def nb_summary(d: Data) -> DataFrame:
    return notebook.summary(_series(d))


@query
def nb_summary_formatted(d: Data) -> DataFrame:
    return notebook.summary_formatted(notebook.summary(_series(d)))


@query
def latest_month_slice(d: Data) -> DataFrame:
    measures = ["total_waiting", "waiting_over_52wks"]
    cells = facts.activity(d.rows().filter("is_open"), facts.GRAIN).select(*facts.GRAIN, *measures)
    latest = notebook.latest_cells(cells, ["provider_id", "treatment_function_code"])
    return d.label(latest).select("period_date", "provider_org_code", "treatment_function_name", *measures)


@query
def nb_top_specialties(d: Data) -> DataFrame:
    long = facts.activity(d.rows().filter("is_open"), ["period_date", "treatment_function_code"])
    named = with_specialty(long.select("period_date", "treatment_function_code", "waiting_over_52wks"))
    return notebook.top_specialties(notebook.latest_of(named), "waiting_over_52wks", 12)


@query
def top10_specialties(d: Data) -> DataFrame:
    return notebook.top_specialties(d.specialty_summary(), "waiting_over_52wks", 10)


# --- slicing and drill-down ----------------------------------------------------------------------------


@query
def slice_dice(d: Data) -> DataFrame:
    """All slicers together; the years also bound the months that are read."""
    years = ["2021/22", "2022/23", "2023/24"]
    start, end = explore.month_bounds(years)
    summary = marts.monthly_summary(facts.activity(d.rows(start=start, end=end), waits=False))
    sliced = explore.slice_by(
        d.label(summary),
        financial_years=years,
        region="ASIA",
        group="Medical",
        covid=False,
        trust_like="supplier#0000000",
    )
    return sliced.select(*SUMMARY_COLUMNS[:6], "total_waiting", "new_rtt_periods", "total_completed")


@query
def matrix_region_fy(d: Data) -> DataFrame:
    months = d.rows(specialty=False).filter("is_open").select("period_date")
    return explore.region_year_matrix(d.region_summary(), explore.financial_years(months))


@query
def drilldown_rollup(d: Data) -> DataFrame:
    return explore.drilldown(d.national())


@query
def peak_long_waiters(d: Data) -> DataFrame:
    return explore.peak_month(d.national())


@query
def long_waiters_by_specialty(d: Data) -> DataFrame:
    return explore.long_waiters_by_specialty(d.specialty_summary())


@query
def waterfall_long_waiters(d: Data) -> DataFrame:
    return explore.waterfall(d.specialty_summary())


# --- dashboard measures --------------------------------------------------------------------------------

REGION = ["region_name"]
MONTH_REGION = ["period_date", "region_name"]
YEAR_REGION = ["financial_year", "region_name"]


def _yearly(d: Data) -> DataFrame:
    return calendar.with_attributes(d.region_summary(), ["financial_year"])


@query
def m_core(d: Data) -> DataFrame:
    return measures.core(_yearly(d), YEAR_REGION)


@query
def m_rates(d: Data) -> DataFrame:
    return measures.rates(_yearly(d), YEAR_REGION)


@query
def m_mom(d: Data) -> DataFrame:
    return measures.waiting_mom(d.region_summary(), REGION)


@query
def m_mom_blank_as_zero(d: Data) -> DataFrame:
    return measures.waiting_mom(d.region_summary(), REGION, blank_as_zero=True)


@query
def m_yoy(d: Data) -> DataFrame:
    return measures.waiting_yoy(d.region_summary(), REGION)


@query
def m_ratio_flow(d: Data) -> DataFrame:
    return measures.ratio_flow(_yearly(d), YEAR_REGION)


@query
def m_index_jan2020(d: Data) -> DataFrame:
    return measures.index_jan2020(d.region_summary(), REGION)


@query
def m_throughput(d: Data) -> DataFrame:
    return measures.throughput(_yearly(d), YEAR_REGION)


@query
def m_lw_mom(d: Data) -> DataFrame:
    return measures.long_waiter_mom(d.region_summary(), REGION)


@query
def m_lw_12m(d: Data) -> DataFrame:
    return measures.long_waiter_12m(d.region_summary(), REGION)


@query
def m_admitted_share(d: Data) -> DataFrame:
    return measures.admitted_share(_yearly(d), YEAR_REGION)


@query
def m_avg_median_wait(d: Data) -> DataFrame:
    return measures.avg_median_wait(d.labelled_summary(waits=True), REGION)


@query
def m_avg_p92(d: Data) -> DataFrame:
    return measures.avg_p92_wait(d.labelled_summary(waits=True), REGION)


@query
def m_regional_breach(d: Data) -> DataFrame:
    return measures.regional_breach(_yearly(d), YEAR_REGION)


@query
def m_vs_national_breach(d: Data) -> DataFrame:
    return measures.vs_national_breach(d.region_summary(), MONTH_REGION)


@query
def m_regional_index(d: Data) -> DataFrame:
    return measures.regional_index(d.region_summary(), MONTH_REGION)


@query
def m_roll3_waiting(d: Data) -> DataFrame:
    return measures.rolling(d.region_summary(), REGION, "total_waiting", 3, "waiting_3m_avg")


@query
def m_roll12_referrals(d: Data) -> DataFrame:
    return measures.rolling(d.region_summary(), REGION, "new_rtt_periods", 12, "referrals_12m_avg")


@query
def m_fytd_treated(d: Data) -> DataFrame:
    return measures.fytd_treated(d.region_summary(), REGION)


# --- data quality --------------------------------------------------------------------------------------


@query
def dq_missing_keys(d: Data) -> DataFrame:
    return quality.missing_keys(
        {
            "fact_rtt_incomplete_star": _star_incomplete(d),
            "fact_rtt_completed_star": _star_completed(d),
            "fact_rtt_new_periods_star": _star_new_periods(d),
            "fact_rtt_wait_band_star": _star_wait_band(d),
        }
    )


@query
def dq_orphans(d: Data) -> DataFrame:
    """References of the lines and suppliers; every tenth supplier id on the lines is made one that nobody has."""
    lines = d.table("lineitem").withColumn("l_suppkey", F.expr("IF(l_suppkey % 10 = 0, -l_suppkey, l_suppkey)"))
    return quality.orphan_report(
        [
            ("l_suppkey", lines, d.table("supplier"), "l_suppkey", "s_suppkey"),
            ("l_partkey", lines, d.table("part"), "l_partkey", "p_partkey"),
            ("l_orderkey", lines, d.table("orders"), "l_orderkey", "o_orderkey"),
            ("s_nationkey", d.table("supplier"), d.table("nation"), "s_nationkey", "n_nationkey"),
        ]
    )


@query
def dq_negative(d: Data) -> DataFrame:
    columns = ["total_waiting", "completed_admitted", "completed_non_admitted", "new_rtt_periods"]
    return quality.negatives(d.activity(), columns)


@query
def dq_duplicate_codes(d: Data) -> DataFrame:
    return quality.duplicate_codes(
        {
            "provider": (d.table("supplier"), "s_suppkey"),
            "region": (d.table("region"), "r_regionkey"),
            "specialty": (d.dim_treatment_function(), "treatment_function_code"),
            "specialty_source": (d.table("part"), "p_brand"),
        }
    )


@query
def dq_not_null(d: Data) -> DataFrame:
    return quality.not_null(d.labelled_summary(waits=True), SUMMARY_COLUMNS)


@query
def dq_expected_counts(d: Data) -> DataFrame:
    return quality.expected_counts(quality.row_counts(d.dimensions()))


@query
def dq_band_total(d: Data) -> DataFrame:
    silver = clean.silver_incomplete(_incomplete_sheet(d))
    good, _ = clean.split_rejects(silver)
    return quality.band_totals(good)


@query
def table_row_counts(d: Data) -> DataFrame:
    rows = d.rows()
    return quality.row_counts(
        {
            "fact_rtt_incomplete": rows.filter("is_open").select(*facts.GRAIN).distinct(),
            "fact_rtt_completed": rows.filter("is_done").select(*facts.GRAIN, "is_admitted").distinct(),
            "fact_rtt_new_periods": rows.select(*facts.GRAIN).distinct(),
        }
    )


@query
def period_coverage(d: Data) -> DataFrame:
    return quality.coverage(d.rows(specialty=False).filter("is_open"))


@query
def profile_sources(d: Data) -> DataFrame:
    """Row, month and provider counts of the four sources from one pass over the rows."""
    grain = ["period_date", "provider_id", "treatment_function_code"]
    cells = facts.activity(d.rows(), grain)
    present = {
        "Incomplete": F.col("n_incomplete") > 0,
        "Admitted": F.col("completed_admitted") > 0,
        "Non-admitted": F.col("completed_non_admitted") > 0,
        "New periods": F.lit(True),
    }
    # Counted by month and provider before the sources become rows, of which a cell would give up to four.
    counts = [F.count(F.when(c, 1)) for c in present.values()]
    counted = cells.groupBy("period_date", "provider_id").agg(F.array(*counts).alias("counts"))
    by_source = F.transform(
        F.array(*[F.lit(n) for n in present]), lambda name, i: F.struct(name.alias("source"), F.get("counts", i).alias("n"))
    )
    per_key = counted.select("period_date", "provider_id", F.inline(by_source)).filter("n > 0")
    return explore.profile_counted(per_key)



# --- stored tables and files ---------------------------------------------------------------------------

for _stored in stored_queries.QUERIES:
    query(_stored)
