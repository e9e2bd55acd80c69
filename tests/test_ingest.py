import pytest
from pyspark.sql import functions as F

from waitflow import schemas as S
from waitflow.operators import clean
from waitflow.queries import QUERIES
from waitflow.sources import files, links, raw_sheets, sheets, tables

BASE = dict(zip(["Region Code", "Provider Code", "Provider Name", "Treatment Function Code", "Treatment Function"], ["Y56", "RJ1", "Alpha", "100", "Surgery"]))


def sheet_frame(spark, **cells):
    row = {**BASE, **cells}
    names = list(row)
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"`{n}` string" for n in names))


def preamble(period, header, *lines):
    top = ["Title"] + [",,"] * (S.PERIOD_ROW - 1) + [f",Period:,{period}"] + [",,"] * (S.HEADER_ROW - S.PERIOD_ROW - 1)
    return "\n".join([*top, header, *lines]) + "\n"


HEADER = 'Region Code,Provider Code,Provider Name,Treatment Function Code,Treatment Function,">0-1",52 plus,Total number of incomplete pathways'


def test_band_collapse_with_missing_columns_and_marks(spark):
    df = sheet_frame(spark, **{">0-1": "3", ">1-2": "*", ">4-5": "2.0", ">5-6": "", ">51-52": "7", "Total number of incomplete pathways": "12.0"})
    got = clean.silver_incomplete(df).first()
    assert (got["band_0_5_wks"], got["band_6_10_wks"], got["band_49_52_wks"], got["band_52_plus"]) == (5, 0, 7, 0)
    assert got["total_waiting"] == 12 and got["median_wait_weeks"] is None


def test_completed_total_is_found_by_substring(spark):
    df = sheet_frame(spark, **{"TOTAL NUMBER OF COMPLETED pathways (all)": "9", "Average (median) waiting time (in weeks)": "8.5"})
    got = clean.silver_completed(df, S.ADMITTED).first()
    assert (got["total_completed"], got["median_wait_weeks"], got["pathway_type"]) == (9, 8.5, "Admitted")
    assert clean.silver_completed(sheet_frame(spark), S.ADMITTED).first()["total_completed"] == 0


def test_clean_rows(spark):
    df = spark.createDataFrame([("RJ1",), ("Total",), ("rj1",), (None,), ("ABCDEFG",)], "provider_org_code string")
    assert [r[0] for r in clean.clean_rows(df).collect()] == ["RJ1"]


def test_combine_takes_the_first_file(spark):
    df = spark.createDataFrame(
        [("2019-04-01", "RJ1", "100", "b.csv", 14, 2), ("2019-04-01", "RJ1", "100", "a.csv", 15, 1), ("2019-04-01", "RJ1", "101", "b.csv", 15, 3)],
        "period_date string, provider_org_code string, treatment_function_code string, source_file string, row_idx int, total_waiting int",
    )
    assert sorted(r["total_waiting"] for r in clean.combine(df, ["source_file", "row_idx"]).collect()) == [1, 3]


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_sheets_from_files(spark, tmp_path):
    fy = tmp_path / "2019-20"
    shuffled = "Provider Code,Region Code,Provider Name,52 plus,Treatment Function Code,Treatment Function"
    write(fy, "Incomplete-Provider-Apr19.csv", preamble("April 2019", HEADER, 'Y56,RJ1,"Alpha, ""The""",100,Surgery,4,1,5', ",,,,,,,", "Y56,Total,All,100,Surgery,4,1,5"))
    write(fy, "Incomplete-Provider-May19.csv", preamble("May 2019", shuffled, "RJ1,Y56,Alpha,6,100,Surgery"))
    write(fy, "Incomplete-Provider-Jun19.csv", preamble("soon", HEADER, "Y56,RJ1,Alpha,100,Surgery,1,1,2"))
    write(fy, "Incomplete-Provider-Jul19.csv", "only one line")
    write(fy, "Incomplete-Provider-Aug19.csv", preamble("August 2019", HEADER))
    write(fy, "NonAdmitted-Provider-Apr19.csv", preamble("April 2019", HEADER, "Y56,RJ1,Alpha,100,Surgery,1,1,2"))
    texts = files.read_sheets(spark, str(tmp_path), "incomplete")
    assert texts.count() == 5
    assert files.read_sheets(spark, str(tmp_path), "completed_admitted").count() == 0
    status = {r["file_name"][20:25]: r["status"] for r in sheets.file_status(texts).collect()}
    assert status == {"Apr19": "ok", "May19": "ok", "Jun19": "no period", "Jul19": "no header", "Aug19": "no rows"}
    rows = sheets.sheet_rows(texts, list(BASE) + [">0-1", "52 plus", "Total number of incomplete pathways"])
    good, rejects = clean.split_rejects(clean.silver_incomplete(rows))
    assert [r["source_file"] for r in rejects.collect()] == ["Incomplete-Provider-Jun19.csv"]
    got = {str(r["period_date"]): r for r in good.collect()}
    assert set(got) == {"2019-04-01", "2019-05-01"}
    assert got["2019-04-01"]["provider_org_name"] == 'Alpha, "The"'
    assert (got["2019-04-01"]["band_0_5_wks"], got["2019-04-01"]["total_waiting"]) == (4, 5)
    assert (got["2019-05-01"]["band_52_plus"], got["2019-05-01"]["region_code"]) == (6, "Y56")


@pytest.mark.parametrize("quote", ["", '"'])
def test_every_heading_of_a_full_header_is_found(spark, quote):
    names = raw_sheets.INCOMPLETE_HEADINGS
    header = ",".join(f"{quote}{n}{quote}" for n in reversed(names))
    line = ",".join(f"{quote}{len(names) - 1 - i}{quote}" for i in range(len(names)))
    texts = spark.createDataFrame([("f.csv", preamble("April 2019", header, line))], "file_name string, content string")
    row = sheets.sheet_rows(texts, names).first()
    assert [row[n] for n in names] == [str(i) for i in range(len(names))]


def test_processed_csv_round_trip(spark, tmp_path):
    schema = S.NEW_PERIODS_CSV
    df = spark.createDataFrame([("Y56", "RJ1", "A, B", "100", "x", 3, "2019-04-01", "f.csv")], schema)
    path = str(tmp_path / "new")
    files.write_processed(df, path)
    assert files.read_processed(spark, path, schema).collect() == df.collect()
    assert files.read_processed(spark, path, schema, as_text=True).first()["new_rtt_periods"] == "3"


def test_staging_is_replaced_and_pruned_by_batch(spark, tmp_path):
    path = str(tmp_path / "stage")
    tables.stage(spark.range(3), path, "first")
    tables.stage(spark.range(2), path, "second")
    back = spark.read.parquet(path)
    assert back.count() == 2 and {r["load_batch_id"] for r in back.collect()} == {"second"}
    tables.append_table(back.withColumn("fy", F.lit("2019/20")), str(tmp_path / "facts"), ["fy"])
    tables.append_table(back.withColumn("fy", F.lit("2020/21")), str(tmp_path / "facts"), ["fy"])
    plan = spark.read.parquet(str(tmp_path / "facts")).filter("fy = '2019/20'")
    assert plan.count() == 2
    assert "PartitionFilters: [isnotnull(fy" in plan._jdf.queryExecution().executedPlan().toString()


def test_links(spark):
    html = """<a href="/files/Incomplete-Provider-Apr19.XLSX">x</a> <a class='b' href='https://h.example/NonAdmitted-Provider.xls'>y</a>
      <a href="/x/Admitted-Provider.pdf">z</a> <a href="/x/commissioner.xls">c</a> <a href="/new-periods-provider-incomplete-provider.xls">two</a>"""
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = links.classified_links(pages, "https://site.example").orderBy("position").collect()
    assert [(r["filename"], r["file_type"]) for r in got] == [
        ("Incomplete-Provider-Apr19.XLSX", "incomplete"),
        ("NonAdmitted-Provider.xls", "completed_non_admitted"),
        ("new-periods-provider-incomplete-provider.xls", "incomplete"),
    ]
    assert got[0]["full_url"] == "https://site.example/files/Incomplete-Provider-Apr19.XLSX"
    assert got[1]["full_url"].startswith("https://h.example/")


def test_manifest(spark):
    found = spark.createDataFrame([("g", "t", "a"), ("g", "t", "a"), ("g", "t", "b")], "grp string, file_type string, filename string")
    known = spark.createDataFrame([("g", "b")], "grp string, filename string")
    row = links.manifest(found, known, "grp").first()
    assert (row["n_links"], row["n_new"], row["n_skipped"]) == (3, 1, 2)
    assert [r["filename"] for r in links.new_files(found, known, "grp").collect()] == ["a"]


def test_a_filter_over_the_status_splits_a_sheet_once(spark):
    rows = [(f"{i}.csv", preamble(period, HEADER, "Y56,RJ1,Alpha,100,Surgery,1,1,2")) for i, period in enumerate(("April 2019", "soon"))]
    bad = sheets.file_status(spark.createDataFrame(rows, "file_name string, content string").repartition(2)).filter("status <> 'ok'")
    assert [tuple(r) for r in bad.collect()] == [("1.csv", "no period")]
    plan = bad._jdf.queryExecution().optimizedPlan().toString()
    # Both branches of the one expression read the text.
    assert plan.count("regexp_replace(content") == 3


def test_week_maps_equal_weekly_columns(spark):
    schema = "g int, wait_week int, patients long, is_open boolean"
    rows = [(1, 0, 2, True), (1, 0, 3, True), (1, 52, None, True), (1, None, 7, True), (2, 9, None, True), (2, 9, 4, False)]
    df = spark.createDataFrame(rows, schema)
    wide = {r.g: r for r in raw_sheets.weekly_sums(df, ["g"]).collect()}
    maps = {r.g: r for r in raw_sheets.week_maps(df, ["g"]).collect()}
    assert maps[1].weeks == {0: 5, 52: None} and maps[2].weeks == {9: None}
    for g, row in maps.items():
        assert [row.weeks.get(i) for i in range(53)] == [wide[g][h] for h in raw_sheets.WEEK_HEADINGS]
        assert row[raw_sheets.INCOMPLETE_TOTAL] == wide[g][raw_sheets.INCOMPLETE_TOTAL]


def test_bands_add_cells_as_before_and_read_each_in_one_expression(spark):
    columns = [*S.WEEK_COLUMNS, S.OPEN_WEEK_COLUMN]
    values = {c: "" for c in columns} | {columns[0]: "1.5", columns[1]: " 2 ", columns[2]: "*", columns[3]: None, columns[52]: "7"}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"`{c}` string" for c in columns))
    row = df.select(*clean.band_columns(df.columns)).first()
    assert (row["band_0_5_wks"], row["band_52_plus"], sum(row)) == (3, 7, 10)
    # One number is read by each band, not by each cell.
    plan = df.select(*clean.band_columns(df.columns))._jdf.queryExecution().analyzed().toString()
    assert plan.count("RLIKE") == len(S.BANDS)
    assert clean.band_columns([]) and spark.range(1).select(*clean.band_columns([])).first()["band_52_plus"] == 0


def test_week_cells_are_the_53_cells_in_order(spark):
    maps = [{0: 5, 52: None}, {}, {9: 2, 3: 1, 60: 7, -1: 8}, {52: 4}, None]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(maps)], "i int, weeks map<int, long>")
    got = dict(tuple(r) for r in df.select("i", raw_sheets._week_cells("weeks")).collect())
    for i, m in enumerate(maps):
        values = [(m or {}).get(w) for w in range(53)]
        assert got[i] == ",".join("" if v is None else str(v) for v in values)


def test_sheets_are_gathered_by_one_shuffle_after_the_weeks_are_summed(spark):
    plan = QUERIES["ingest_preamble"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(period_date") == 2


def test_broken_bodies_and_quoted_line_feeds_keep_their_row_numbers(spark):
    lines = ["Y56,RJ1,Alpha,100,Surgery,1,1,2", ",,,", 'Y56,RJ2,"Be\nta",100,Surgery,1,*,2']
    texts = [preamble("April 2019", HEADER, *lines), preamble("April 2019", HEADER.replace('"', ""), lines[0]).replace("\n", "\r\n"), "one line", None]
    df = spark.createDataFrame([(f"{i}.csv", t) for i, t in enumerate(texts)], "file_name string, content string")
    rows = sheets.sheet_rows(df, list(BASE) + [">0-1"]).collect()
    got = sorted((r["source_file"], r["row_idx"], r["Provider Name"], r[">0-1"], r["period_date"]) for r in rows)
    at, month = S.HEADER_ROW, "2019-04-01"
    assert got == [("0.csv", at + 1, "Alpha", "1", month), ("0.csv", at + 3, "Be\nta", "1", month), ("1.csv", at + 1, "Alpha", "1", month)]
