"""Fill-in-the-middle, source divergence and toxicity against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.conftest import SMALL
from tests.llm.helpers import LOWER, docs, with_clashes
from waitflow.llm import divergence, fim, toxicity
from waitflow.llm.probing import Places
from waitflow.llm.transducer import Builder, Transducer, term_spans

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")

ODD = [
    (1, None), (2, ""), (3, "a"), (4, "é"), (5, "naïve 𝄞𝄞𝄞 text"), (6, "holds <P> a marker"), (7, "ends in <S"),
    (8, "<S"), (9, "漢字" * 40_000), (10, "x" * 200_000), (10, "x" * 200_000), (11, "é" + "a" * 65_535 + "ß"), (None, "no id here"),
    *[(i, f"ü{i} <M <S <P text 𝄞" * (i % 7)) for i in range(20, 120)],
]


def plain_fim(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_fim_equals_plain_version(spark):
    table = with_clashes(docs(spark, ODD))
    order = lambda rows: sorted(rows, key=repr)
    want = [plain_fim(*r) for r in ODD]
    assert order(tuple(r) for r in fim.transform(table).collect()) == order(want)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    digests = [(*w[:5], sha(w[5]), sha(t or "")) for w, (_, t) in zip(want, ODD)]
    assert order(tuple(r) for r in fim.digest(table).collect()) == order(digests)
    assert fim.digest(docs(spark, [])).collect() == []


def test_fim_forms_come_back():
    assert {plain_fim(i, "some text")[2] for i in range(200)} == {"plain", "psm", "spm"}
    for i in range(300):
        _, _, form, _, _, out = plain_fim(i, "<S>M> <" if i % 2 else "S>M>P><")
        assert fim.restore(out.encode(), form).decode() == ("<S>M> <" if i % 2 else "S>M>P><")


@pytest.mark.parametrize("kind", [fim.RunContainer, fim.ArrayContainer, fim.BitmapContainer])
def test_containers_select(kind):
    rng = np.random.default_rng(3)
    members = {
        fim.RunContainer: np.r_[5:3000, 3001:60_000],
        fim.ArrayContainer: np.sort(rng.choice(fim.CHUNK, 900, replace=False)),
        fim.BitmapContainer: np.sort(rng.choice(fim.CHUNK, 20_000, replace=False)),
    }[kind]
    made = fim.container(members)
    assert type(made) is kind
    for k in [0, 1, len(members) // 2, len(members) - 1, *rng.integers(0, len(members), 300)]:
        assert made.select(int(k)) == members[k]


def test_boundaries_of_long_texts():
    for text in ("a" * 65_536, "é" * 32_768, "漢" * 50_000 + "z", "aé" * 100_000, ""):
        data = text.encode()
        found = fim.BoundarySet(np.frombuffer(data, np.uint8))
        assert len(found) == len(text) + 1
        for k in {0, 1, len(text) // 3, len(text) // 2, len(text)} & set(range(len(text) + 1)):
            assert found.select(k) == len(text[:k].encode())


def test_places():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 60, 5000))
    asked = np.concatenate([keys[::-1], np.random.default_rng(2).integers(0, 1 << 60, 5000)])
    want = {int(k): i for i, k in enumerate(keys)}
    assert Places(keys).find(asked).tolist() == [want.get(int(k), -1) for k in asked]
    assert Places(keys[:0]).find(asked[:3]).tolist() == [-1, -1, -1]


def _minimal_states(terms):
    """Number of different right languages of the prefixes."""
    ends = defaultdict(set)
    for t in terms:
        for i in range(len(t) + 1):
            ends[t[:i]].add(t[i:])
    return len({frozenset(v) for v in ends.values()})


def test_transducer_is_minimal_and_gives_ordinals():
    rng = random.Random(4)
    terms = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))).encode() for _ in range(400)})
    builder = Builder()
    builder.add_root("x", terms)
    assert len(builder.finals) == _minimal_states(terms)
    read = Transducer(builder.dump())
    text = "".join(rng.choice("abcéAB 1.") for _ in range(20_000)) + "".join(t.decode() + "-" for t in terms)
    data = np.frombuffer(text.encode(), np.uint8)
    starts, lengths = term_spans(data, np.array([0]))
    found = read.ordinals(data, starts, lengths, np.full(len(starts), read.roots["x"]))
    places = {t: i for i, t in enumerate(terms)}
    words = [w.translate(LOWER).encode() for w in TERM.findall(text)]
    assert found.tolist() == [places.get(w, -1) for w in words]


def plain_audit(rows, min_docs, top):
    rows = [(t or "", lang or "", source or "") for _, t, lang, source in rows]
    words = [(lang, source, [w.translate(LOWER) for w in TERM.findall(t)]) for t, lang, source in rows]
    held = defaultdict(Counter)
    for lang, _, ws in words:
        held[lang].update(set(ws))
    kept = {lang: sorted((w for w, n in c.items() if n >= min_docs), key=lambda w: w.encode()) for lang, c in held.items()}
    counts = defaultdict(Counter)
    for lang, source, ws in words:
        known = set(kept[lang])
        counts[lang, source].update(w for w in ws if w in known)
    out = []

    def shares(c, terms):
        whole = sum(c.values()) + 5 * len(terms)
        return {w: 1 + 1_000_000_000 * (c[w] + 5) // whole for w in terms}

    for lang, source in counts:
        terms = kept[lang]
        p = shares(counts[lang, source], terms)
        others = []
        for other_lang, other in counts:
            if other_lang == lang and other != source:
                q = shares(counts[lang, other], terms)
                others.append((other, sum(abs(p[w] - q[w]) for w in terms)))
        whole = sum((c for (x, _), c in counts.items() if x == lang), Counter())
        q = shares(whole, terms)
        over = [(w, p[w] - q[w]) for w in terms if counts[lang, source][w] and p[w] > q[w]]
        for part, found in (("pair", others), ("term", over)):
            found.sort(key=lambda f: (-f[1], f[0].encode()))
            out += [(lang, source, part, w, v, i) for i, (w, v) in enumerate(found, 1) if part == "pair" or i <= top]
    return sorted(out)


def _audit_rows():
    rng = random.Random(9)
    rows = [(1, None, "en", "a"), (2, "", None, None), (3, "?? 12 _", "fr", "b"), (4, "lonely words", "xx", "only"), (None, "Alpha ALPHA", "en", "")]
    vocabulary = ["alpha", "Beta", "straße", "Éa", "éa", "東京", "z" * 3000, "gam", "delta"]
    for i in range(400):
        text = " ".join(rng.choices(vocabulary, weights=range(1, 10), k=rng.randint(0, 12)))
        rows.append((i, text, rng.choice(["en", "de", ""]), rng.choice(["s1", "s2", "s3", "é"])))
    return rows + [(7, "tie1 tie2 tie3", "en", "s1")] * 40


@pytest.mark.parametrize("limits", [{}, {"PART_TERMS": 2, "PASS_BYTES": 1, "MEMO": 3, "BLOCK": 2, "SLICE": 64}])
def test_divergence_equals_plain_version(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(divergence, name, value)
    if limits:
        monkeypatch.setattr(divergence.transducers, "__defaults__", (limits["PART_TERMS"],))
        monkeypatch.setattr(divergence.recount, "__defaults__", (limits["PASS_BYTES"],))
    rows = _audit_rows()
    table = with_clashes(docs(spark, rows).repartition(3))
    got = sorted(tuple(r) for r in divergence.audit(table, min_docs=20, top=3).collect())
    assert got == plain_audit(rows, 20, 3)


def test_divergence_without_kept_terms(spark):
    rows = [(1, "a b", "en", "x"), (2, "c", "en", "y"), (3, None, "de", "x")]
    got = sorted(tuple(r) for r in divergence.audit(docs(spark, rows)).collect())
    assert got == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)] == plain_audit(rows, 30, 50)
    assert divergence.audit(docs(spark, [])).collect() == []


def test_shares_are_exact():
    whole = np.array([3, 7, 10**15 + 3, 9 * 10**15], np.int64)
    for count in (np.array([0, 6, 10**14 + 1, 10**15], np.int64), whole):
        assert divergence._shares(count, whole).tolist() == [1 + 10**9 * int(c) // int(w) for c, w in zip(count, whole)]


def plain_ratio(counts, group):
    """log ratio of one group by the textbook formula; counts: group (tuple of letters) -> (ordinary, toxic)."""
    d, order = toxicity.DISCOUNT, toxicity.ORDER

    def shared(g):
        if not g:
            return 1 / (1 << toxicity.BITS)
        grown = {h[-len(g) - 1 :] for h in counts} if len(g) < order else None
        after = Counter(h[1:] for h in grown)
        same = {h: n for h, n in after.items() if h[:-1] == g[:-1]}
        lower = shared(g[1:])
        if not same:
            return lower
        whole = sum(same.values())
        return max(same.get(g, 0) - d, 0) / whole + d * len(same) / whole * lower

    logs = []
    for c in (0, 1):
        same = {h: n[c] for h, n in counts.items() if h[:-1] == group[:-1] and n[c]}
        p = shared(group[1:])
        if same:
            whole = sum(same.values())
            p = max(same.get(group, 0) - d, 0) / whole + d * len(same) / whole * p
        logs.append(math.log(p))
    return logs[1] - logs[0]


def _unpacked(g):
    return tuple((g >> toxicity.BITS * i) & ((1 << toxicity.BITS) - 1) for i in reversed(range(toxicity.ORDER)))


def _toy_model():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcd é!") for _ in range(60)) for _ in range(12)]
    parts = [np.unique(np.concatenate([toxicity.groups(toxicity.letters([t])[0]) for t in texts[c::2]]), return_counts=True) for c in (0, 1)]
    keys = np.union1d(parts[0][0], parts[1][0])
    counts = np.zeros((len(keys), 2), np.int64)
    for c, (k, n) in enumerate(parts):
        counts[np.searchsorted(keys, k), c] = n
    return keys, counts, texts


def test_toxicity_ratios_equal_plain_kneser_ney():
    keys, counts, _ = _toy_model()
    model = toxicity.Model(keys, counts)
    plain = {_unpacked(int(k)): tuple(int(x) for x in n) for k, n in zip(keys, counts)}
    unseen = toxicity.groups(toxicity.letters(["dabéc abba zzz cab"])[0])
    for g in [*keys[::17].tolist(), *unseen.tolist()]:
        assert model.ratio(np.array([g]))[0] == pytest.approx(plain_ratio(plain, _unpacked(g)), abs=2e-6)


def test_toxicity_evidence_of_whole_texts(monkeypatch):
    keys, counts, texts = _toy_model()
    model = toxicity.Model(keys, counts)
    texts += ["", "!!!", "a", "  ab", "ab" * 300 + "!!  ??", "ΑΣ Σ\x00ß" * 50]
    whole = model.evidence(texts)
    for text, (mean, best, size) in zip(texts, whole):
        symbols = re.sub(r"[^\W\d_]", "x", text.replace("\x00", " ").casefold())
        symbols = re.sub("[^x]+", " ", symbols).lstrip()
        assert size == len(symbols)
        codes, _ = toxicity.letters([text])
        r = model.ratio(toxicity.groups(codes))[toxicity.WINDOW - toxicity.ORDER + 1 :]
        padded = np.concatenate([np.zeros(8), r, np.zeros(8)])
        assert mean == (r.sum() / size if size else 0)
        assert best == (max(padded[i : i + 8].sum() / 8 for i in range(len(r) + 8)) if size else 0)
    assert (np.concatenate([model.evidence([t]) for t in texts]) == whole).all()
    monkeypatch.setattr(toxicity, "SLICE", 5)
    assert (model.evidence(texts) == whole).all()


def _invented(n, seed, toxic_of):
    rng = random.Random(seed)
    syllables = ["ta", "re", "mi", "lon", "der", "su", "ki", "pa"]
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(20, 80))]
        toxic = int(i % 8 == 0)
        for _ in range(3 * toxic):
            words[rng.randrange(len(words))] = "zorx" + rng.choice(syllables) + rng.choice(syllables)  # seen in part only
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic_of(toxic)))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_toxicity_finds_rare_forms_in_held_out_texts(spark):
    rows, labels = _invented(1200, 5, lambda t: t)
    rows += [(None, "zorx zorxmi"), (5000, None), (5001, ""), (5002, "12 !"), (5003, "ta re " * 60_000 + "zorxkipa zorxmi zorxta"), (3, rows[3][1])]
    got = toxicity.score(with_clashes(docs(spark, rows)), spark.createDataFrame(labels + [(1, 0, None), (2, 1, 0)], LABELS)).collect()
    assert len(got) == len(rows)
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 150 and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.99
    by_id = {r.doc_id: r for r in got}
    assert by_id[5003].predicted == 1 and by_id[None].predicted == 1 and not by_id[None].held_out
    assert by_id[5000].score == by_id[5001].score == by_id[5002].score < 0.5
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_toxicity_does_not_hang_on_the_layout_or_on_held_out_labels(spark):
    rows, labels = _invented(400, 6, lambda t: t)
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % toxicity.FOLDS == toxicity.HELD_OUT}
    turned = [(i, q, 1 - t if i in held else t) for i, q, t in labels]
    one = toxicity.score(docs(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    two = toxicity.score(docs(spark, rows[::-1]).repartition(7), spark.createDataFrame(turned, LABELS)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


@pytest.mark.parametrize(("toxic", "value"), [(None, 0.0), (0, 0.0), (1, 1.0)])
def test_toxicity_without_a_class(spark, toxic, value):
    rows = [(i, "some words here") for i in range(20)]
    labels = [] if toxic is None else [(i, 0, toxic) for i in range(20)]
    got = toxicity.score(docs(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert {r.score for r in got} == {value} and len(got) == 20
    assert toxicity.score(docs(spark, []), spark.createDataFrame(labels, LABELS)).collect() == []


def test_toxicity_model_and_sample_keep_to_their_bounds(spark):
    rows, labels = _invented(1200, 7, lambda t: t)
    table, marks = docs(spark, rows), spark.createDataFrame(labels, LABELS)
    some = toxicity.training_sample(table, marks, sample=100)
    sizes = {r.toxic: r["count"] for r in some.groupBy("toxic").count().collect()}
    assert 50 < sizes[0] < 160 and 50 < sizes[1] <= 150
    model = toxicity.learn(toxicity.training_sample(table, marks), most=200)
    assert 0 < len(model.keys) <= 200


def test_toxicity_on_the_given_table(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = toxicity.score(table, spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert set(got.columns) >= {"doc_id", "held_out", "score", "predicted"}
    assert got.count() == table.count()

