"""Stored tables: batches that are loaded again, refreshed marts, CSV scans with rejects, incremental ingest."""

import datetime
import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SMALL
from waitflow import stored_queries
from waitflow.data import Data
from waitflow.functions.numeric import steady
from waitflow.operators import clean, keys
from waitflow.plans import dims, facts, loads, marts, sketches, waits
from waitflow.queries import QUERIES
from waitflow.sources import buckets, files, increments, pathways, sheets, tables, workspace

ROWS = "period_date date, provider_org_code string, treatment_function_code string, new_rtt_periods long"


def month(year, number):
    return datetime.date(year, number, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def store(spark, tmp_path):
    return loads.Facts(spark, str(tmp_path / "facts"))


def load(store, spark, rows, batches=None):
    frame = spark.createDataFrame(rows, ROWS + ", batch string")
    store.stage("new_periods", frame.drop("batch") if batches is None else frame, F.col("batch") if "batch" in frame.columns else "x")
    staged = store.staged("new_periods", frame)
    return store.load("new_periods", staged, batches or sorted({r[4] for r in rows}))


def held(store, spark):
    rows = store.read("new_periods", spark.createDataFrame([], ROWS + ", batch string"))
    return sorted((r.load_batch_id, r.date_key, r.provider_org_code, r.new_rtt_periods) for r in rows.collect())


APRIL, MAY, JUNE = month(2020, 4), month(2020, 5), month(2020, 6)


def test_loading_a_batch_again_replaces_that_batch_alone(spark, store):
    first = [(APRIL, "A00", "100", 1, "a"), (MAY, "A00", "100", 2, "a"), (MAY, "B00", "100", 3, "b")]
    assert load(store, spark, first, ["a", "b"]) == [202004, 202005]
    kept = {f: os.path.getmtime(f) for f in _files(store, "load_batch_id=b")}
    again = [(MAY, "A00", "100", 20, "a"), (JUNE, "A00", "100", 30, "a")]
    assert load(store, spark, again, ["a"]) == [202004, 202005, 202006]
    want = [("a", 202005, "A00", 20), ("a", 202006, "A00", 30), ("b", 202005, "B00", 3)]
    assert held(store, spark) == want
    assert load(store, spark, again, ["a"]) == [202005, 202006]
    assert held(store, spark) == want
    assert {f: os.path.getmtime(f) for f in _files(store, "load_batch_id=b")} == kept


def _files(store, part):
    root = store.path("new_periods")
    return [os.path.join(d, f) for d, _, names in os.walk(root) if d.endswith(part) for f in names if f.endswith(".parquet")]


def test_a_batch_without_rows_is_emptied(spark, store):
    load(store, spark, [(APRIL, "A00", "100", 1, "a"), (MAY, "B00", "100", 3, "b")], ["a", "b"])
    assert load(store, spark, [], ["a"]) == [202004]
    assert held(store, spark) == [("b", 202005, "B00", 3)]


def test_a_load_that_broke_off_is_repeated(spark, store, monkeypatch):
    load(store, spark, [(APRIL, "A00", "100", 1, "a"), (MAY, "A00", "100", 1, "a")], ["a"])
    final = [(MAY, "A00", "100", 5, "a")]
    store.settle(store.pending())
    with monkeypatch.context() as m:
        m.setattr(workspace, "remove", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            load(store, spark, final, ["a"])
    assert set(sum(store.pending().values(), [])) == {202004, 202005}
    load(store, spark, final, ["a"])
    assert held(store, spark) == [("a", 202005, "A00", 5)]


def test_touched_months_are_kept_until_the_marts_are_refreshed(spark, store, monkeypatch):
    empty = [(APRIL, "A00", "100", 1, "a"), (MAY, "A00", "100", 1, "a")]
    load(store, spark, empty, ["a"])
    load(store, spark, [(MAY, "A00", "100", 2, "a")], ["a"])
    load(store, spark, [(JUNE, "B00", "100", 2, "b")], ["b"])
    refreshed = []
    built = loads.Marts(store, {})

    def breaks(months):
        raise OSError("lost")

    monkeypatch.setattr(built, "refresh", breaks)
    with pytest.raises(OSError):
        built.refresh_pending()
    monkeypatch.setattr(built, "refresh", refreshed.append)
    assert built.refresh_pending() == [202004, 202005, 202006] and refreshed == [[202004, 202005, 202006]]
    assert built.refresh_pending() == [] and len(refreshed) == 1


def test_partition_values_must_be_plain(spark, store):
    load(store, spark, [(APRIL, "A00", "100", 1, "2020/21")], ["2020/21"])
    with pytest.raises(ValueError):
        load(store, spark, [(APRIL, "A00", "100", 1, "2020/21")], ["2020/21"])


def test_staged_rows_carry_their_lineage(spark, store):
    load(store, spark, [(APRIL, "A00", "100", 1, "a")], ["a"])
    row = store.read("new_periods", spark.createDataFrame([], ROWS + ", batch string")).first()
    assert row.data_source == tables.DATA_SOURCE and row.load_timestamp is not None


def test_months_prune_stored_facts(spark, store):
    load(store, spark, [(APRIL, "A00", "100", 1, "a"), (MAY, "A00", "100", 2, "a")], ["a"])
    rows = store.read("new_periods", spark.createDataFrame([], ROWS + ", batch string"), [202005])
    assert rows.count() == 1 and re.search(r"PartitionFilters: \[[^]]*date_key", plan_of(rows))


def test_refresh_touches_the_given_months_only(spark, tmp_path):
    d = Data(spark, SMALL)
    stored = loads.Facts(spark, str(tmp_path / "facts"))
    rows = {k: d.coded(f(d.rows())).drop("provider_id") for k, f in zip(loads.KINDS, (facts.incomplete, facts.completed, facts.new_periods))}
    for kind, frame in rows.items():
        stored.stage(kind, frame, "all")
        stored.load(kind, stored.staged(kind, frame), ["all"])
    built = loads.Marts(stored, rows)
    months = [r.date_key for r in d.dim_date().select("date_key").collect()]
    built.refresh(months)
    root = built.path("monthly")
    before = {f: os.path.getmtime(f) for f in _all_files(root)}
    built.refresh([202105, 202106])
    after = {f: os.path.getmtime(f) for f in _all_files(root)}
    changed = {f.split("date_key=")[1][:6] for f in set(after) ^ set(before)}
    assert changed == {"202105", "202106"}
    built.open_views("v_test")
    got = spark.table("v_test_national_monthly").select("period_date", *marts.NATIONAL, "breach_rate_pct")
    want = d.national().select(*got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    # A refresh of months without facts empties them.
    tables.drop_partition(spark, stored.path("incomplete"), "date_key", 202105)
    for kind in ("completed", "new_periods"):
        tables.drop_partition(spark, stored.path(kind), "date_key", 202105)
    built.refresh([202105])
    assert spark.read.parquet(root).filter("date_key = 202105").isEmpty()


def _all_files(root):
    return [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")]


COUNTS = T.StructType().add("code", "string").add("name", "string").add("n", "long")


def test_csv_scan_keeps_what_does_not_fit(spark, tmp_path):
    folder = tmp_path / "in" / "2020"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text('code,name,n\nA,one,1\nB,two\nC,three,3,4\nD,four,*\n"E, F","quo""ted",5\nG,,\n\n')
    (folder / "b.csv").write_text("code,name,n\n")
    (folder / "note.txt").write_text("not,a,sheet\n")
    scanned = files.scan_csv(spark, str(tmp_path / "in"), COUNTS)
    good = files.fitting(scanned)
    assert sorted((r.code, r.name, r.n) for r in good.collect()) == [("A", "one", 1), ("E, F", 'quo"ted', 5), ("G", None, None)]
    assert {r.file_path.rsplit("/", 1)[1] for r in good.collect()} == {"a.csv"}
    bad = files.rejected(scanned, COUNTS)
    assert sorted((r.record, r.reason) for r in bad.collect()) == [
        ("B,two", "cells missing"), ("C,three,3,4", "cells over"), ("D,four,*", "unreadable n")
    ]
    # Records are judged by all columns, also where a query reads one.
    assert files.fitting(scanned).select("code").count() == 3
    assert scanned.groupBy().agg(F.count(files.RECORD)).first()[0] == 3


def test_csv_scan_over_line_feeds_in_cells(spark, tmp_path):
    df = spark.createDataFrame([("A", 'first\nsecond, "third"', 1), ("B", "plain", 2)], COUNTS)
    files.write_processed(df, str(tmp_path / "c"))
    scanned = files.scan_csv(spark, str(tmp_path / "c"), COUNTS, multi_line=True)
    assert sorted(map(tuple, files.fitting(scanned).drop("file_path").collect())) == sorted(map(tuple, df.collect()))
    assert files.rejected(scanned, COUNTS).isEmpty()


def test_lines_of_a_file_stay_together_and_in_order(spark, tmp_path):
    lines = spark.range(3000).select(
        F.concat(F.lit("f"), (F.col("id") % 3).cast("string")).alias("file"), F.col("id").alias("position"), F.col("id").cast("string").alias("line")
    )
    files.write_lines(lines.repartition(7), str(tmp_path / "t"))
    for n in range(3):
        (found,) = [f for f in _text_files(tmp_path / "t" / f"file=f{n}")]
        assert open(found).read().split() == [str(i) for i in range(n, 3000, 3)]


def _text_files(root):
    return [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.startswith("part-")]


def test_combine_takes_the_first_publication(spark):
    frame = spark.createDataFrame(
        [("2020-04-01", "A00", "100", "1-x", 1), ("2020-04-01", "A00", "100", "2-x", 9), ("2020-04-01", "B00", "100", "2-x", 7)],
        "period_date string, provider_org_code string, treatment_function_code string, source_file string, n int",
    )
    assert sorted(r.n for r in clean.combine(frame, ["source_file"]).collect()) == [1, 7]


def _ingest(spark, tmp_path):
    reader = lambda paths: files.fitting(files.scan_csv(spark, paths, COUNTS))
    return increments.Ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), reader, "*.csv")


def _put(tmp_path, name, *rows):
    path = tmp_path / "in" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("code,name,n\n" + "".join(f"{c},x,{n}\n" for c, n in rows))
    return path


def _codes(ingest):
    return sorted((r.code, r.n) for r in ingest.rows("code string, name string, n long").collect())


def test_ingest_reads_new_and_changed_files_only(spark, tmp_path):
    ingest = _ingest(spark, tmp_path)
    _put(tmp_path, "2020/a.csv", ("A", 1))
    changing = _put(tmp_path, "2020/b c.csv", ("B", 2))
    assert ingest.run() == 2 and _codes(ingest) == [("A", 1), ("B", 2)]
    assert ingest.run() == 0 and _codes(ingest) == [("A", 1), ("B", 2)]
    _put(tmp_path, "2020/b c.csv", ("B", 20), ("C", 3))
    gone = _put(tmp_path, "2021/d.csv", ("D", 4))
    assert ingest.run() == 2 and _codes(ingest) == [("A", 1), ("B", 20), ("C", 3), ("D", 4)]
    # The same length, another time.
    stamp = changing.stat().st_mtime
    _put(tmp_path, "2020/b c.csv", ("B", 21), ("C", 3))
    os.utime(changing, (stamp + 100, stamp + 100))
    gone.unlink()
    assert ingest.run() == 1 and _codes(ingest) == [("A", 1), ("B", 21), ("C", 3)]
    runs = {r.run: (r.n_listed, r.n_read) for r in ingest.runs().collect()}
    assert runs == {1: (2, 2), 2: (2, 0), 3: (3, 2), 4: (2, 1)}


def test_a_run_that_broke_off_shows_nothing_and_is_repeated(spark, tmp_path, monkeypatch):
    ingest = _ingest(spark, tmp_path)
    _put(tmp_path, "a.csv", ("A", 1))
    ingest.run()
    _put(tmp_path, "b.csv", ("B", 2))
    whole = tables.append_table

    def breaks(df, path, partition_by=None):
        if path.endswith("snapshots"):
            raise OSError("lost")
        whole(df, path, partition_by)

    with monkeypatch.context() as m:
        m.setattr(tables, "append_table", breaks)
        with pytest.raises(OSError):
            ingest.run()
    assert _codes(ingest) == [("A", 1)] and ingest.last_run() == 1
    _put(tmp_path, "c.csv", ("C", 3))
    assert ingest.run() == 2 and _codes(ingest) == [("A", 1), ("B", 2), ("C", 3)]


def test_month_bounds_reach_the_scan(spark):
    d = Data(spark, SMALL)
    bounded = d.rows(start="2021-04-01", end="2022-03-01")
    plan = plan_of(bounded)
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00), LessThan(o_orderdate" in plan
    assert re.search(r"o_orderdate#\d+ < 1998-01-01 00:00:00", plan)
    cut = d.rows().filter("period_date BETWEEN DATE '2021-04-01' AND DATE '2022-03-01'")
    assert bounded.exceptAll(cut).isEmpty() and cut.exceptAll(bounded).isEmpty()
    assert pathways.order_bounds(None, None) == []


def test_wait_histograms_merge_to_exact_quantiles(spark):
    d = Data(spark, SMALL)
    rows = d.rows().filter("is_open")
    for by in (["provider_id"], ["period_date"], ["provider_id", "treatment_function_code"]):
        merged = waits.with_quantiles(waits.merge(waits.histograms(rows, facts.GRAIN), by))
        want = rows.groupBy(*by).agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.round(F.percentile("wait_week", F.lit(0.5)), 6).alias("median"),
            F.round(F.percentile("wait_week", F.lit(0.92)), 6).alias("p92"),
        )
        got = merged.select(*want.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_latest_month_is_found_in_one_scan(spark):
    from waitflow.queries import QUERIES

    df = QUERIES["latest_month_slice"](spark, SMALL)
    df.collect()
    assert "ReusedExchange [provider_id" in plan_of(df)


def test_counts_are_taken_while_a_table_is_written(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, None), (2, "b"), (3, None)], "part int, v string")
    metrics = {"total_rows": F.count(F.lit(1)), "missing_v": F.count(F.when(F.col("v").isNull(), True))}
    assert tables.write_observed(df, path, metrics, ["part"]) == {"total_rows": 3, "missing_v": 2}
    assert spark.read.parquet(path).count() == 3


def test_bucketed_orders_join_without_a_shuffle(spark):
    d = Data(spark, SMALL)
    lines, orders = buckets.store_orders(d.table("lineitem"), d.table("orders"), 4)
    hinted = lines.hint("merge").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    plan = plan_of(hinted)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert hinted.count() == d.table("lineitem").count()
    plain = d.table("lineitem").hint("merge").join(d.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    assert "Exchange" in plan_of(plain)
    assert [buckets.bucket_count(n) for n in (0, 32_000_000, 32_000_001)] == [8, 8, 16]


def test_sketches_unite_within_their_bound(spark):
    cells = spark.range(200_000).select(
        (F.col("id") % 12).alias("month"), (F.col("id") % 50_021).alias("provider"), F.lit(None).cast("string").alias("none")
    )
    stored = sketches.monthly(cells, ["month"], {"providers": ["provider"], "both": ["provider", "none"]})
    got = sketches.united(stored, [], ["providers", "both"]).first()
    assert abs(got.providers - 50_021) <= 4 * sketches.STANDARD_ERROR * 50_021
    assert abs(got.both - 50_021) <= 4 * sketches.STANDARD_ERROR * 50_021
    few = sketches.united(sketches.monthly(cells.filter("provider < 40"), ["month"], {"p": ["provider"]}), [], ["p"])
    assert few.first().p == 40


def test_change_set_names_every_code_once(spark):
    old = spark.createDataFrame([("A", "x", 1), ("B", "x", 1), ("C", "x", None), ("D", "x", 1)], "code string, name string, region int")
    new = spark.createDataFrame([("A", "x", 1), ("B", "y", 1), ("C", "x", None), ("E", "z", 2), ("E", "zz", 2), (None, "q", 1)], "code string, name string, region int")
    got = {r.code: (r.change, r.old_name, r.new_name) for r in keys.change_set(old, new, "code", ["name", "region"]).collect()}
    assert got == {
        "A": ("unchanged", "x", "x"), "B": ("changed", "x", "y"), "C": ("unchanged", "x", "x"), "D": ("absent", "x", None),
        "E": ("inserted", None, "z"),
    }


def test_history_and_as_of(spark):
    rows = [("A", month(2020, 1), "a"), ("A", month(2020, 2), "a"), ("A", month(2020, 4), "b"), ("A", month(2020, 5), "a"),
            ("B", month(2020, 3), None), ("B", month(2020, 4), "n"), ("B", month(2020, 4), "z"), (None, month(2020, 1), "q")]
    snapshots = spark.createDataFrame(rows, "code string, month date, name string")
    spans = keys.history(snapshots, "code", "month", ["name"])
    got = sorted(((r.code, r.valid_from, r.valid_to, r.name) for r in spans.collect()))
    assert got == [
        ("A", month(2020, 1), month(2020, 4), "a"), ("A", month(2020, 4), month(2020, 5), "b"), ("A", month(2020, 5), None, "a"),
        ("B", month(2020, 3), month(2020, 4), None), ("B", month(2020, 4), None, "n"),
    ]
    asked = [("A", month(2019, 12)), ("A", month(2020, 3)), ("A", month(2021, 1)), ("B", month(2020, 4)), ("C", month(2020, 4))]
    facts_ = spark.createDataFrame(asked, "code string, month date")
    found = {(r.code, r.month): r.name for r in keys.as_of(facts_, spans, "code", "month").collect()}
    assert found == dict(zip(asked, [None, "a", "a", "n", None]))


def test_upsert_joins_once(spark):
    old = spark.createDataFrame([("AAAA1", 1, "x"), ("AAAB1", 2, "x")], "code string, k int, name string")
    new = spark.createDataFrame([("AAAB1", "y"), ("AAAB2", "n"), ("AAAA2", "n"), ("AAAA3", "n")], "code string, name string")
    got = {r.code: (r.k, r.name) for r in keys.upsert(old, new, "code", "k", ["name"]).collect()}
    assert got == {"AAAA1": (1, "x"), "AAAB1": (2, "y"), "AAAA2": (3, "n"), "AAAA3": (4, "n"), "AAAB2": (5, "n")}
    assert keys.upsert(old, new.limit(0), "code", "k", ["name"]).count() == 2
    assert [r.k for r in keys.upsert(old.limit(0), new, "code", "k", ["name"]).orderBy("k").collect()] == [1, 2, 3, 4]


def test_calendar_covers_the_seed_and_the_data(spark):
    late = spark.createDataFrame([(month(2026, 3),), (month(2014, 12),)], "period_date date")
    got = [r.full_date for r in dims.calendar_with(late).orderBy("full_date").collect()]
    assert (got[0], got[-1], len(got)) == (month(2014, 12), month(2026, 3), 136)
    assert dims.calendar_with(late.limit(0)).count() == 132


def test_cells_with_line_feeds_stay_whole(spark):
    content = 'a,"two\nlines",c\r\n"say ""hi""\n",x\nlast'
    lines = sheets._with_lines(spark.createDataFrame([(content,)], "content string")).first().lines
    assert [x for x in lines if x] == ['a,"two\nlines",c', '"say ""hi""\n",x', "last"]
    open_quote = sheets._with_lines(spark.createDataFrame([('a,"b\nc,d\n',)], "content string")).first().lines
    assert "".join(open_quote).replace("\n", "") == 'a,"bc,d'


def test_a_filter_on_the_calendar_prunes_stored_facts(spark):
    plan = plan_of(stored_queries._covid_facts(Data(spark, SMALL)))
    assert "dynamicpruning" in plan


def test_refresh_joins_the_tables_once(spark, monkeypatch):
    """All loads of a refresh read one stored copy of the joined rows."""
    joined = []
    monkeypatch.setattr(Data, "rows", lambda self, *a, _own=Data.rows, **k: joined.append(1) or _own(self, *a, **k))
    stored_queries.mart_refreshed(Data(spark, SMALL))
    assert len(joined) == 1


def test_merging_histograms_adds_occupied_weeks_only(spark):
    cells = waits.histograms(Data(spark, SMALL).rows().filter("is_open"), facts.GRAIN)
    assert "hist[52]" not in plan_of(waits.merge(cells, ["provider_id"]))


def test_histograms_count_rows_without_a_wait(spark):
    rows = spark.createDataFrame([(1, 3), (1, 3), (1, None), (2, None)], "g int, wait_week int")
    merged = waits.merge(waits.histograms(rows, ["g"]), ["g"])
    got = {r.g: r for r in waits.with_quantiles(merged).collect()}
    assert (got[1].n_rows, got[1].hist[3], sum(got[1].hist), got[1].median) == (3, 2, 2, 3.0)
    assert (got[2].n_rows, sum(got[2].hist), got[2].median) == (1, 0, 53.0)


def test_a_file_has_its_header_once(spark, tmp_path):
    lines = spark.range(50).selectExpr("concat('f', id % 2) AS file", "cast(id AS int) AS position", "cast(id AS string) AS line")
    files.write_lines(lines.repartition(5), str(tmp_path / "h"), "head")
    for n in range(2):
        (found,) = _text_files(tmp_path / "h" / f"file=f{n}")
        assert open(found).read().split() == ["head", *[str(i) for i in range(n, 50, 2)]]


def test_profile_counts_before_sources_become_rows(spark):
    plan = QUERIES["profile_sources"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    generated = next(line for line in plan.split("\n") if "Generate inline" in line)
    assert plan.index(generated) < plan.index("Aggregate [period_date")


def test_steady_equals_round(spark):
    values = spark.createDataFrame([(x,) for x in (0.1 + 0.2, 2.5, 7.0, 1 / 3, 12.0000005, -1.25, 0.015625, 1e300, float("nan"), None)], "x double")
    assert values.filter(~steady(F.col("x")).eqNullSafe(F.round("x", 6))).isEmpty()


def test_checked_stars_join_the_tables_once(spark, monkeypatch):
    joined = []
    monkeypatch.setattr(Data, "rows", lambda self, *a, _own=Data.rows, **k: joined.append(1) or _own(self, *a, **k))
    stored_queries.dq_missing_keys_at_load(Data(spark, SMALL))
    assert len(joined) == 1


def test_ingested_rows_are_not_shuffled(spark, tmp_path, monkeypatch):
    gathered = []
    own = tables.write_table
    monkeypatch.setattr(tables, "write_table", lambda df, path, *a, **k: gathered.append(path.rsplit("/", 1)[1]) or own(df, path, *a, **k))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part-1.csv").write_text("a\n1\n2\n")
    schema = T.StructType.fromDDL("a int")
    read = lambda paths: files.fitting(files.scan_csv(spark, paths, schema, pattern="*"))
    ingest = increments.Ingest(spark, str(tmp_path / "in"), str(tmp_path / "store"), read, pattern="part-*")
    assert ingest.run() == 1 and sorted(r.a for r in ingest.rows("a int").collect()) == [1, 2]
    assert "rows" not in gathered


def test_staged_batch_is_dealt_by_month(spark, tmp_path, monkeypatch):
    """The months of a batch are sorted and written by several tasks, not by one for each batch."""
    hints = []
    own = type(spark.range(1)).hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda self, name, *c: hints.append((name, len(c))) or own(self, name, *c))
    rows = spark.range(24).selectExpr("add_months(DATE'2021-04-01', cast(id AS int)) AS period_date", "id AS n")
    stored = loads.Facts(spark, str(tmp_path))
    stored.stage("incomplete", rows, loads.batch_name("incomplete", F.col("period_date")))
    assert hints == [("rebalance", 2)]
    assert stored.staged("incomplete", rows, ["incomplete_2022-23"]).count() == 12
