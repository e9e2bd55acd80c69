import pytest
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waitflow import schemas as S
from waitflow.operators import keys
from waitflow.plans import dims


def test_standard_calendar(spark):
    rows = dims.standard_dim_date(spark).orderBy("date_key").collect()
    assert len(rows) == 132
    assert rows[0]["full_date"] == dt.date(2015, 1, 1) and rows[-1]["date_key"] == 202512
    assert sum(r["is_covid_period"] for r in rows) == 25


def test_seed_dimensions(spark):
    assert [r["region_code"] for r in dims.dim_region(spark).orderBy("region_key").collect()] == [r[0] for r in S.REGIONS]
    bands = dims.dim_wait_band(spark).orderBy("wait_band_key").collect()
    assert [b["band_label"] for b in bands][:2] == ["0-5 weeks", "6-10 weeks"]
    assert [b["is_breach"] for b in bands] == [0] * 4 + [1] * 8
    assert bands[-1]["upper_weeks"] is None and bands[-1]["is_long_waiter"] == 1
    assert dims.seed_treatment_functions(spark).count() == 21


def test_band_weeks_cover_every_week_once():
    weeks = [w for b in S.BANDS for w in range(b[2], b[3] + 1)]
    assert weeks == list(range(53))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.text("AB01", min_size=1, max_size=8), min_size=1, max_size=40))
def test_surrogate_keys_follow_code_order(spark, codes):
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    rows = keys.with_surrogate_key(df, "code", "k").orderBy("k").collect()
    assert [(r["code"], r["k"]) for r in rows] == [(c, i) for i, c in enumerate(sorted(codes), 1)]


def test_keep_first_is_by_order_not_by_arrival(spark):
    df = spark.createDataFrame([("k", "b.csv", 1, "late"), ("k", "a.csv", 9, "second"), ("k", "a.csv", 2, "first")], "k string, f string, i int, v string")
    assert [r["v"] for r in keys.keep_first(df, ["k"], ["f", "i"]).collect()] == ["first"]


def test_keep_first_drops_copies_before_the_shuffle(spark):
    df = keys.keep_first(spark.range(100).withColumn("k", F.col("id") % 2), ["k"], ["id"])
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


def test_dim_trust_resolves_region_and_defaults(spark):
    providers = spark.createDataFrame(
        [("RB2", " Beta ", "Y58"), ("RA1", "Alpha", "Y61"), ("RA1", "Alpha", "Y61"), ("RC3", "Gamma", "Z99"), (None, "x", "Y58")],
        "provider_org_code string, provider_org_name string, region_code string",
    )
    found = dims.dim_trust(providers, dims.dim_region(spark)).orderBy("trust_key").collect()
    assert [(r["trust_key"], r["trust_code"], r["trust_name"], r["region_key"]) for r in found] == [
        (1, "RA1", "Alpha", 5),
        (2, "RB2", "Beta", 2),
        (3, "RC3", "Gamma", 1),
    ]


def test_upsert_keeps_keys_updates_names_and_numbers_new_codes(spark):
    existing = spark.createDataFrame([("A", 5, "a", "x"), ("B", 2, "b", "y")], "code string, key int, name string, kind string")
    incoming = spark.createDataFrame([("B", "bb", "q"), ("D", "d", "r"), ("C", "c", None)], "code string, name string, kind string")
    rows = keys.upsert(existing, incoming, "code", "key", ["name"]).orderBy("code").collect()
    assert [(r["code"], r["key"], r["name"], r["kind"]) for r in rows] == [
        ("A", 5, "a", "x"),
        ("B", 2, "bb", "y"),
        ("C", 6, "c", None),
        ("D", 7, "d", "r"),
    ]


def test_insert_ignore_keeps_existing_rows(spark):
    old = spark.createDataFrame([(1, "old")], "k int, v string")
    new = spark.createDataFrame([(1, "new"), (2, "two")], "k int, v string")
    assert {(r["k"], r["v"]) for r in keys.insert_ignore(old, new, "k").collect()} == {(1, "old"), (2, "two")}


def test_orphans_count_rows_per_key(spark):
    facts = spark.createDataFrame([(1,), (9,), (9,)], "fk int")
    assert [tuple(r) for r in keys.orphans(facts, spark.createDataFrame([(1,)], "id int"), "fk", "id").collect()] == [(9, 2)]


def test_upserts_keep_keys_unique(spark):
    existing = spark.createDataFrame([(1, "a", "old")], "key int, code string, name string")
    incoming = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "p"), ("b", "q"), (None, "n")], "code string, name string")
    rows = keys.upsert(existing, incoming, "code", "key", ["name"]).orderBy("code").collect()
    assert [tuple(r) for r in rows] == [(1, "a", "x"), (2, "b", "p")]
    added = keys.insert_ignore(existing, incoming.selectExpr("7 AS key", "code", "name"), "code").orderBy("code", "name")
    assert [tuple(r) for r in added.collect()] == [(1, "a", "old"), (7, "b", "p")]


def test_provider_codes_fit_the_whitelist(spark):
    from waitflow.functions.text import is_code
    from waitflow.sources.pathways import provider_code

    ids = spark.createDataFrame([(0,), (99_999,), (100_000,), (1_234_567,), (60_466_175,)], "id long")
    codes = ids.select(provider_code(F.col("id")).alias("c"))
    assert codes.filter(is_code(F.col("c"))).distinct().count() == 5
    with pytest.raises(Exception, match="no six-character code"):
        spark.createDataFrame([(60_466_176,)], "id long").select(provider_code(F.col("id"))).collect()
