"""Token files, shards, mixing, nearest neighbours, URL rules and the pipeline."""

import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.helpers import brute_components, docs, with_clashes
from waitflow.llm import forest, langid, mixture, queries, shards, tokenfile, urlrules

ODD = [(3, None), (1, ""), (2, "naïve  text\twith\u00a0odd\u2003space <|endoftext|> 𝄞 İ ß"), (2, "again"), (5, "x" * 70_000), (None, "no id")]


def same_as_sql(spark, con, name):
    got = queries.QUERIES[name](spark, SMALL).toPandas()
    want = con.execute(queries.ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns) and len(got) == len(want)
    order = lambda df: df[columns].astype(object).where(df[columns].notna(), None).map(str).sort_values(columns).values.tolist()
    assert order(got) == order(want)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, con, name):
    same_as_sql(spark, con, name)


def encoder():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenfile.TOKENIZER)


def test_token_files_round_trip(spark, tmp_path):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    path = str(tmp_path / "tokens")
    tokenfile.write_tokens(with_clashes(table).drop("n_tokens"), path)
    tok, start = encoder(), 0
    got = {r.doc_id: r for r in tokenfile.checksums(spark, path).collect()}
    lists = {r.doc_id: r.tokens for r in tokenfile.read_tokens(spark, path).collect()}
    for doc_id, text in sorted(tuple(r) for r in table.collect()):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        r = got[doc_id]
        assert lists[doc_id] == ids
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    some = sorted(got)[5:7]
    assert {r.doc_id for r in tokenfile.read_tokens(spark, path, some).collect()} == set(some)


def test_token_file_layout(spark, tmp_path):
    path = str(tmp_path / "tokens")
    tokenfile.write_tokens(spark.read.parquet(f"{SMALL}/documents.parquet"), path)
    files = sorted(p for p in (tmp_path / "tokens").iterdir() if p.suffix == ".parquet")
    meta = pq.ParquetFile(files[0]).metadata
    columns = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(meta.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert any("DICTIONARY" in e for e in columns["tokens.list.element"].encodings)
    assert all(c.has_column_index and c.has_offset_index for c in columns.values() if c.path_in_schema == "doc_id")
    plan = tokenfile.read_metadata(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "tokens:array" not in plan and "n_tokens:bigint" in plan


def test_token_files_odd_rows(spark, tmp_path):
    path = str(tmp_path / "tokens")
    tokenfile.write_tokens(docs(spark, ODD), path)
    tok = encoder()
    got = tokenfile.checksums(spark, path).collect()
    assert len(got) == len(ODD) and min(got, key=lambda r: r.start).doc_id is None
    want = sorted((i is not None, i or 0, len(tok.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in ODD)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens) for r in got) == want
    tokenfile.write_tokens(docs(spark, ODD).limit(0), str(tmp_path / "none"))
    assert tokenfile.checksums(spark, str(tmp_path / "none")).count() == 0


def test_pieces_of_odd_texts_are_encoded_as_the_library_does(monkeypatch):
    rng, tok = random.Random(3), encoder()
    letters = "aB c'.,<|>9_-\n\t\r\x0b\x0c\xa0é\u0301ßİÅK…²٣漢!&%$*\"@#(){}’\u200b"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["x <|endoftext|> A", "<|ENDOFTEXT|>'LL", "a<|startoftext|>b'S don't I'VE 'tis .'s 's's", "", "   ", "d.d'd d'.d 5's s'5 a1b2.c3"]
    texts += ["y" * 5000 + "!" * 300, "漢字" * 800]
    for memory in (tokenfile.MEMO_BYTES, 0):
        monkeypatch.setattr(tokenfile, "MEMO_BYTES", memory)
        for low in range(0, len(texts), 500):
            part = texts[low : low + 500]
            ids, counts = tokenfile.encode_texts(pa.array([t.encode() for t in part], pa.binary())[1:])
            ends = np.concatenate([[0], np.cumsum(counts)])
            for text, a, b in zip(part[1:], ends, ends[1:]):
                assert ids[a:b].tolist() == tok.encode(text, add_special_tokens=False).ids, text


def test_words_are_encoded_as_in_the_text():
    tok = encoder()
    samples = ["It's a test, isn't it?! 3.14 ... don't", "a\u0301 é \u212b \u1e9b\u0323 ΟΔΟΣ Σ", "tab\tand\r\nbreak\x0b\x0c\x1c\x1dx\x85y", "<|endoftext|><|startoftext|> <|endoftext|>x", "  "]
    for text in samples:
        assert np.frombuffer(tokenfile.encode_text(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids


def test_a_lot_of_pieces_is_read_as_one_text_and_each_encoded_by_itself():
    tok = encoder()
    known = tokenfile._Pieces(tokenfile.TOKENIZER)
    plain = ["alpha", "<|endoftext", "|>", "e\u0301", "\u0301x", "don't", "'s", "12", "x" * 100, "<", "\U0001f600"]
    for lot in (plain, [*plain, "<|startoftext|>"], [*plain, "a<|endoftext|>b"], ["<|endoftext|>"], ["one"], []):
        ids, sizes = known._fresh([w.encode() for w in lot])
        each = [tok.encode(w, add_special_tokens=False).ids for w in lot]
        assert sizes.tolist() == [len(x) for x in each] and ids.tolist() == [i for x in each for i in x]
    pieces = [w.encode() for w in plain]
    for memory in (tokenfile.MEMO_BYTES, 600, 0):  # remembered, let go now and then, or at once
        for again in (pieces[:5], pieces, pieces[::-1]):
            ids, starts = known.encode(again, memory)
            want = [tok.encode(w.decode(), add_special_tokens=False).ids for w in again]
            assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == want
            assert all(len(w) <= tokenfile.MEMO_WORD for w in known.places) and len(known.ids) == known.starts[-1]


def check_shards(rows, got, n=8):
    want = sorted((i is not None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == want
    line = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.doc_id or -1 for r in line] == sorted(r.doc_id or -1 for r in got)
    for k in range(n):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))
    total, largest = sum(r.size for r in got), max(r.size for r in got)
    assert all(abs(sum(r.size for r in got if r.shard == k) - total / n) <= largest for k in range(n))


def test_shards(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in table.collect()]
    check_shards(rows, shards.cut_by_bytes(table).collect())
    check_shards(ODD, shards.cut_by_bytes(with_clashes(docs(spark, ODD))).collect())
    assert shards.cut_by_bytes(docs(spark, ODD).limit(0)).count() == 0
    plan = shards.cut_by_bytes(table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_mix_limits_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixture, "BLOCK", 10)
    rows = [(i, "w " * (1 + i % 7), "en", "big") for i in range(300)] + [(1000 + i, "v u", "en", "small") for i in range(20)]
    rows += [(2000, None, "en", None), (2001, "only words of no source", "en", None)]
    plan = mixture.mix_plan(with_clashes(docs(spark, rows)), 2.0).toPandas()
    assert len(plan) == len(rows) and plan.copies.min() >= 1
    used = (plan.n_tokens * plan.copies).groupby(plan.source.fillna("-")).sum()
    own = plan.n_tokens.groupby(plan.source.fillna("-")).sum()
    assert (used <= own * 2.0 + 1e-6).all() and used["big"] == own["big"]
    assert plan.block[plan.source == "big"].nunique() > 5


def test_mix_entropy_target(spark):
    rows = [(i, "w " * 50, "en", f"s{min(i, 3)}") for i in range(40)]
    plan = mixture.mix_plan(docs(spark, rows), None, target_entropy=1.2).toPandas()
    w = plan.groupby("source").weight.first()
    assert -(w * np.log(w)).sum() == pytest.approx(1.2, abs=1e-3)
    with pytest.raises(ValueError):
        mixture.mix_plan(docs(spark, rows), None)


def test_mix_copies_and_odd_rows(spark):
    odd = docs(spark, ODD)
    assert mixture.mix_plan(odd).count() == len(ODD)
    assert mixture.mix_plan(odd.limit(0)).count() == 0
    silent = docs(spark, [(1, None), (2, "")])
    assert [r.copies for r in mixture.mix_plan(silent).collect()] == [1, 1]
    plan = spark.createDataFrame([(1, 2), (2, 1)], "doc_id long, copies int")
    mixed = mixture.mix(docs(spark, [(1, "a"), (2, "b")]), plan)
    assert sorted(r.text for r in mixed.collect()) == ["a", "a", "b"] and mixed.columns == odd.columns


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute_nearest(rows, step=50, top=5):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = {}
    for k in (ids % step == 0).nonzero()[0]:
        s = np.round(unit @ unit[k], 12)
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[k]][:top]
        found[int(ids[k])] = [(int(ids[j]), s[j]) for j in order]
    return found


def test_nearest_with_equal_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), rng.normal(size=16).astype(np.float32).tolist(), 0) for i in range(700)]
    rows += [(int(i), rows[3][1], 0) for i in range(700, 1000)]
    want = brute_nearest(rows)
    got = {}
    for r in forest.search(vectors(spark, rows)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got.keys() == want.keys()
    for q, near in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in near] or [s for _, s in got[q]] == pytest.approx([s for _, s in near])
        if q >= 700:
            assert [i for i, _ in got[q]] == [i for i in (3, 700, 701, 702, 703, 704) if i != q][:5]


def test_nearest_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want = brute_nearest(rows)
    got = forest.search(table).toPandas().groupby("query_id").vec_id.agg(set)
    assert sum(len(got[q] & {i for i, _ in near}) for q, near in want.items()) >= 0.9 * 5 * len(want)


def recall(spark, x, query_step):
    """Share of the true 5 nearest that are found, for the rows whose place is divisible by query_step."""
    import pyarrow as pa

    table = pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(x), pa.list_(pa.float64()))})
    got = forest.search(spark.createDataFrame(table), query_step).toPandas().groupby("query_id").vec_id.agg(set)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    share = []
    for q in range(0, len(x), query_step):
        s = unit @ unit[q]
        s[q] = -2
        share.append(len(got[q] & set(np.argsort(-s)[:5].tolist())) / 5)
    return np.array(share)


def test_nearest_in_a_cluster_of_near_copies(spark):
    """The cluster is larger than two blocks and a third of all rows."""
    rng = np.random.default_rng(4)
    x = rng.uniform(-1, 1, (99_000, 64))
    x[::3] = x[0] + rng.normal(0, 1e-5, (33_000, 64))
    share = recall(spark, x, 1_000)
    assert share[::3].mean() >= 0.9  # rows divisible by 3 are the cluster


def test_nearest_recall_on_a_large_table(spark):
    x = np.random.default_rng(9).uniform(-1, 1, (100_000, 64))
    assert recall(spark, x, 1_000).mean() >= 0.9


def test_nearest_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0), (1, None, 0), (2, [0.0, 0.0], 0), (3, [nan, 1.0], 0), (4, [inf, 1.0], 0), (5, [1.0, None], 0)]
    rows += [(6, [1.0, 1.0], 0), (6, [1.0, 1.0], 0), (7, [1.0, 2.0, 3.0], 0), (None, [1.0, 1.0], 0), (50, None, 0), (100, [], 0)]
    got = forest.search(vectors(spark, rows).withColumn("rep", F.lit("x"))).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 6)] and got[0].score == pytest.approx(2**-0.5)
    assert forest.search(vectors(spark, rows).limit(0)).count() == 0


def test_url_rules(spark):
    urls = [
        None, "", "no scheme", "http://net", "http://NET/", "http://a.net/x", "http://anet/", "http://example.net/en/1", "http://b.Example.NET/en",
        "https://example.com/de/", "https://www.example.com/DE/", "http://org/fr/?q#f", "http://x.org/fr", "http://h?x://y/z", "x://a.b#c/d",
        "http://ads-track.site.test/p", "http://my-ads-track.test/", "http://t/click?a&ad=1", "http://t/banner/x.gif", "http://t/a-casino-b", "http://t/pop-under",
    ]
    rows = [(i, u, "<html>") for i, u in enumerate(urls)] + [(None, "http://net/", None), (4, "http://NET/", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = urlrules.judge(pages.withColumns({"host": F.lit("x"), "token": F.lit("y"), "rule_no": F.lit(1)})).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    for i, u in enumerate(urls):
        after = u.split("://", 1)[1] if u and "://" in u else None
        host = "" if after is None else re.split("[/?#]", after, maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = "" if after is None else re.split("[?#]", after[len(host) :], maxsplit=1)[0]
        fits = [(w, h + p) for w, h, p in urlrules.HOST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, key=lambda f: len(f[1]), default=(None, None))
        low = (u or "").lower()
        hits = [p for p in urlrules.PATTERNS if re.search(urlrules.regex_of(p), low)]
        assert (by_id[i].host, by_id[i].path, by_id[i].rule) == (host, path, best[1])
        assert by_id[i].pattern == (hits[0] if hits else None)
        assert by_id[i].verdict == (best[0] or ("block" if hits else "allow"))
    assert urlrules.judge(pages.limit(0)).count() == 0


def test_patterns_without_a_token(spark):
    pages = spark.createDataFrame([(1, "http://a.test/xyz"), (2, "http://a.test/abc")], "page_id long, url string")
    assert urlrules.tokens_of("*xy*") == [] and urlrules.tokens_of("||ads-track.") == ["ads", "track"]
    got = {r.page_id: r.verdict for r in urlrules.judge(pages, [], ["*xy*"]).collect()}
    assert got == {1: "block", 2: "allow"}


def test_pipeline_against_brute_force(spark):
    got = corpus_pipeline.run(spark, SMALL)
    docs_in = spark.read.parquet(f"{SMALL}/documents.parquet").toPandas()
    items = [t for t in spark.read.parquet(f"{SMALL}/benchmark.parquet").toPandas().text]
    alive = docs_in[docs_in.text.map(lambda t: bool(t) and any(map(str.isalpha, t)))]
    component = brute_components(list(zip(alive.doc_id, alive.text)))
    alive = alive[alive.doc_id.map(lambda i: component[i] == i)]
    alive = alive[~alive.text.map(lambda t: any(x in t for x in items))]
    rows = got.toPandas()
    tok = encoder()
    counts = {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in zip(alive.doc_id, alive.text)}
    assert set(rows.doc_id) <= set(counts) and len(set(counts) - set(rows.doc_id)) <= 0.01 * len(counts)
    assert all(counts[i] == n for i, n in zip(rows.doc_id, rows.n_tokens))
    line = rows.sort_values("start")
    assert line.start.tolist() == np.concatenate([[0], np.cumsum(line.n_tokens)[:-1]]).tolist() and line.doc_id.is_monotonic_increasing
    assert rows.groupby("doc_id").size().max() <= 2


def test_stages_keep_columns_and_stand_odd_rows(spark, tmp_path):
    frame = docs(spark, [*ODD, (2, "again"), (9, "12 34"), (10, "enough letters for a language", "en", None)])
    table = frame
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, table, SMALL).write.parquet(str(tmp_path / str(k)))
        table = spark.read.parquet(str(tmp_path / str(k)))
        assert table.columns == frame.columns, name
    assert {r.doc_id for r in table.collect()} == {2, 5, 10, None}
    empty = frame.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0, name


def test_rejected_language_is_dropped(spark):
    kept = corpus_pipeline.language(spark, docs(spark, [(1, "12 !"), (2, "ein Wort")]), SMALL)
    assert [r.doc_id for r in kept.collect()] == [2] and langid.UNKNOWN == "und"


def test_pipeline_keeps_rows_that_only_share_an_id(spark):
    text = lambda k: " ".join(f"t{k}w{i}" for i in range(40))
    rows = [(None, text(1)), (None, text(2)), (None, text(2)), (7, text(3)), (7, text(4)), (8, text(5)), (8, text(5)), (9, text(5))]
    got = sorted((r.doc_id or 0, r.text) for r in corpus_pipeline.near_duplicates(spark, docs(spark, rows), SMALL).collect())
    assert got == sorted([(0, text(1)), (0, text(2)), (0, text(2)), (7, text(3)), (7, text(4)), (8, text(5))])
