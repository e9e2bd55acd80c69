"""PII, near duplicates, language model, language ID and decontamination against plain versions."""

import hashlib
import math
import random
import re
import zlib

import pandas as pd
import pytest

from tests.conftest import SMALL
from tests.llm.helpers import brute_components, docs, shingles, with_clashes, words
from waitflow.llm import decontam, langid, mixlm, neardup, pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one two"),
    (4, "one two"),
    (5, "short text here"),
    (None, "nobody owns this text at all"),
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def plain(table):
    return table.toPandas()


def base_spans(text):
    found = [("email", 0, m) for m in EMAIL.finditer(text)]
    found += [("ip", 1, m) for m in IP.finditer(text) if all(int(p) < 256 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            found.append(("card", 2, m))
    found += [("phone", 3, m) for m in PHONE.finditer(text) if 9 <= len(re.findall("[0-9]", m[0])) <= 15]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, _, m in sorted(found, key=lambda f: (f[2].start(), f[1])))


PII_TEXTS = [
    "a@b.c@d.e and x..y%+-@q-.z.w, @no.name, no@name",
    "1.2.3.4.5.6.7.8 300.1.1.1 1.2.3 0001.02.003.255 1.1.1.1.",
    "4111 1111 1111 1111 4111-1111-1111-1112 5500-0000 0000 0004 41111111111111110000000 1  4111111111111111",
    "+1 (555) 010-9999, +4412, ++44 20 7946 0958-, +12345678901234567",
    "é€ 𝄞 mail me at ünï.a@b.co tel +49 (30) 1234567.",
    "1" * 3000 + "." * 50 + "9" * 40 + "@" + "a.b" * 30,
    "IBAN GB82 WEST 1234 5698 7654 32 and GB82WEST12345698765433",
    "ssn 078-05-1120, 078-05-1120 alone; token = \"908038b7daaf91e730d2f64001c52934d43d9336\"",
]


def test_pii_base_spans(spark):
    rng = random.Random(5)
    mixed = ["".join(rng.choice("0123456789.@+- ()ab%") for _ in range(80)) for _ in range(400)]
    rows = list(enumerate(PII_TEXTS + mixed))
    got = {r.doc_id: r for r in pii.digest(docs(spark, rows)).collect()}
    for i, text in rows:
        assert got[i].base_sha256 == hashlib.sha256(base_spans(text).encode()).hexdigest(), text
        kept = ",".join(s for s in got[i].spans.split(",") if s.split(":")[0] in pii.BASE_KINDS)
        assert kept == base_spans(text)


def test_pii_context_and_checksums():
    kinds = lambda t: [s.kind for s in pii.find_spans(t)]
    assert kinds(PII_TEXTS[6]) == ["iban"]
    assert kinds("ssn 078-05-1120") == ["ssn"] and kinds("part 078-05-1120") == []
    assert kinds(PII_TEXTS[7])[-1] == "secret" and kinds("908038b7daaf91e730d2f64001c52934d43d9336") == []


@pytest.mark.parametrize(
    "after", [" BIC WESTGB22", " 2024-05-01", " A payment", " GB82 WEST 1234 5698 7654 32", " paid", "", ". PAID", " 12 AB"]
)
def test_pii_iban_before_other_tokens(after):
    for iban in ("GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765432"):
        for before in ("", "AB12 CDEF 1234 ", "REF 77 "):
            text = f"{before}{iban}{after}"
            found = [text[s.start : s.end] for s in pii.find_spans(text) if s.kind == "iban"]
            assert found == [iban] + [after[1:]] * ("GB82" in after), text


def test_pii_odd_rows(spark):
    got = pii.digest(with_clashes(docs(spark, ODD))).collect()
    assert len(got) == len(ODD) and all(r.spans == "" and r.n_email == 0 for r in got)
    assert pii.digest(docs(spark, ODD).limit(0)).count() == 0
    found = pii.spans(docs(spark, [(7, "write to a@b.co")])).first()
    assert (found.doc_id, found.kind, found.text) == (7, "email", "a@b.co")


def edited(rng, base, share):
    out = base[:]
    for _ in range(int(len(base) * share)):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


def planted(rng):
    """Texts around the threshold, copies, chains and short ones."""
    rows, n = [], 0
    for group in range(12):
        base = [f"g{group}w{rng.randrange(500)}" for _ in range(rng.choice([3, 8, 30, 200, 900]))]
        for _ in range(rng.randrange(1, 12)):
            rows.append((n, edited(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.03]))))
            n += 1
    shared = [f"s{i}" for i in range(40)]
    for _ in range(20):
        rows.append((n, " ".join(shared + [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60))])))
        n += 1
    chain = [f"c{i}" for i in range(300)]
    for k in range(15):
        rows.append((n, " ".join(f"x{i}" if i < 6 * k else w for i, w in enumerate(chain))))
        n += 1
    rng.shuffle(rows)
    return rows


def test_near_duplicates_equal_all_pairs(spark):
    rows = planted(random.Random(11))
    want = brute_components(rows)
    got = neardup.near_duplicates(with_clashes(docs(spark, rows))).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        assert (r.component_id, r.n_shingles) == (want[r.doc_id], len(shingles(texts[r.doc_id])))
        assert r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_whole_table(table, plain):
    want = brute_components(list(zip(plain.doc_id, plain.text)))
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(table).collect()} == want


def test_near_duplicates_small_blocks(spark, monkeypatch):
    """A bucket cut into many blocks gives the same links."""
    monkeypatch.setattr(neardup, "BLOCK", 3)
    rows = planted(random.Random(3))
    got = neardup.near_duplicates(docs(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows)


def test_near_duplicates_odd_rows(spark):
    got = neardup.near_duplicates(docs(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].n_shingles == by_id[2].n_shingles == by_id[3].n_shingles == 0
    assert by_id[1].component_id == 1 and by_id[2].component_id == 2 and by_id[4].n_shingles == 1
    assert by_id[None].component_id is None and by_id[None].kept
    assert neardup.near_duplicates(docs(spark, ODD).limit(0)).count() == 0


def test_sequential_test_bounds():
    """A pair at the threshold passes every step but for the stated chance."""
    for n, needed in neardup.least_matches():
        missed = sum(math.comb(n, m) * 0.85**m * 0.15 ** (n - m) for m in range(needed))
        assert missed < 1e-5 and needed > n / 3


def test_mixing_base_score(table, plain):
    got = {r.doc_id: r for r in mixlm.score(table).collect()}
    training, rows = {}, {}
    for i, text in zip(plain.doc_id, plain.text):
        rows[i] = [*words(text), None]
        if zlib.crc32(str(i).encode()) % 7 != 2:
            for w in rows[i]:
                training[w] = training.get(w, 0) + 1
    n, v = sum(training.values()), len(training)
    assert len(got) == len(plain)
    for i, tokens in rows.items():
        r = got[i]
        want = sum(math.log10((training.get(w, 0) + 1) / (n + v + 1)) for w in tokens)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(w in training for w in tokens), n)
        assert r.base_score == pytest.approx(want, rel=1e-9) and r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert r.score < 0 and math.isfinite(r.score)


def test_mixing_beats_the_base_on_held_out_text(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixlm.score(table).filter("held_out").toPandas()
    assert rows.score.sum() > rows.base_score.sum() * 1.1 and rows.bits_per_byte.median() < 3


def test_mixed_bits_are_a_distribution(spark):
    """Over one byte, the probabilities of all continuations add up to one."""
    import numpy as np

    tables = np.zeros((mixlm.ORDERS, 2, mixlm.SLOTS), np.int64)
    mixlm.count_bits(tables, [b"the", b"then", b"that"], np.array([64, 32, 16]))
    model = mixlm.fresh(tables)
    mixlm.learn_online(model, [b"the", b"then", b"that"], np.array([64, 32, 16]))
    flat = [bytes([b]) for b in range(256)]
    logs = []
    for w in flat:  # the first byte alone: take away the closing blank's share
        total = mixlm.bits_log10(model, [w])[0]
        blank = np.log10(1.0)
        two = [mixlm.bits_log10(model, [w])[0] - blank]
        logs.append(total if two else total)
    assert 0 < sum(10**x for x in logs) <= 1.0 + 1e-9


def test_mixing_odd_rows(spark):
    got = {r.doc_id: r for r in mixlm.score(with_clashes(docs(spark, ODD))).collect()}
    assert got[1].n_tokens == got[2].n_tokens == got[3].n_tokens == 1 and got[4].n_tokens == 3
    assert mixlm.score(docs(spark, ODD).limit(0)).count() == 0
    only_held = [(i, "some words") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    assert all(r.n_known == 0 and r.score < 0 for r in mixlm.score(docs(spark, only_held)).collect())
    long = [(1, "word " * 200_000), (2, "x" * 100_000)]
    assert {r.doc_id: r.n_tokens for r in mixlm.score(docs(spark, long)).collect()} == {1: 200_001, 2: 2}


def test_mixing_cost_grows_with_an_unseen_word(spark):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    rows = [(1000 + i, "some plain words to learn from") for i in range(40)]
    rows += [(i, "x" * n) for i, n in zip(held, (1_000, 10_000, 100_000))]
    got = {r.doc_id: r.score for r in mixlm.score(docs(spark, rows)).collect()}
    assert got[held[1]] / got[held[0]] == pytest.approx(10, rel=0.1)
    assert got[held[2]] / got[held[1]] == pytest.approx(10, rel=0.1)


def test_mixing_scores_text_as_a_sequence(spark):
    """Words with a training count pass through the mixed bits: their order counts, the deal of rows does not."""
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    rows = [(1000 + i, "the small garden opened alpha river second") for i in range(40)]
    rows += [(held[0], "the small garden opened alpha river second"), (held[1], "second opened the river garden alpha small")]
    table = docs(spark, rows)
    got = {r.doc_id: r for r in mixlm.score(table.repartition(1)).collect()}
    assert all(got[i].n_known == 8 for i in held)
    assert got[held[0]].score > got[held[1]].score + 1
    again = {r.doc_id: r.score for r in mixlm.score(table.repartition(7)).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_mixing_edges_and_rests_are_the_whole_word():
    import numpy as np

    found = [b"the", b"then", b"thematic", b"", b"a", "größe".encode(), b"x" * 300]
    heads, tails = mixlm.letters(found)
    assert heads.tolist()[0] == int.from_bytes(b"th") and tails.tolist()[2] == int.from_bytes(b"tic")
    tables = np.zeros((mixlm.ORDERS, 2, mixlm.SLOTS), np.int64)
    mixlm.count_bits(tables, found, np.arange(1, 8))
    model = mixlm.fresh(tables)
    mixlm.learn_online(model, found, np.arange(1, 8))
    first = mixlm.edges_of(heads, tails, np.arange(len(found)), np.arange(len(found)))
    both = mixlm.edges_log10(model, first) + mixlm.rests_log10(model, found)
    assert both == pytest.approx(mixlm.bits_log10(model, found), rel=1e-12)
    # The probabilities of all first bytes after one word add up to one.
    flat = mixlm.flatten_edges(np.array([int.from_bytes(b"eta\0\0" + bytes([b]) + b" ") for b in range(256)], np.uint64))
    at = flat.zone == 0
    ones = mixlm.Flat(flat.data[at], flat.word[at], flat.zone[at], flat.contexts[:, at])
    assert (10 ** mixlm._log10(model, ones, 256, None)).sum() == pytest.approx(1, abs=1e-9)


def test_language_accuracy(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(table).join(table.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.99 and got.score.between(0, 1).all()


def test_forward_sums_all_segmentations():
    import numpy as np

    vocabulary = {"▁": 0, "a": 1, "b": 2, "ab": 3, "▁a": 4}
    table = np.zeros((len(vocabulary) + 1005, 1))
    table[:5, 0] = [0.1, 0.2, 0.3, 0.15, 0.25]

    def brute(word):
        if not word:
            return 1.0
        return sum(table[p, 0] * brute(word[len(s) :]) for s, p in vocabulary.items() if word.startswith(s))

    samples = ["a", "ab", "abab", "bbb", "aab" * 40]
    got = langid.forward(samples, table, vocabulary, 2)
    for w, x in zip(samples[:4], got[:4, 0]):
        assert math.exp(x) == pytest.approx(brute("▁" + w))
    assert math.isfinite(got[4, 0])
    assert langid.forward(["ab" * 5000], table, vocabulary, 2)[0, 0] < -5000


def test_language_odd_rows(spark):
    rows = [*ODD, (8, "12 34 !!"), (9, "le chat et la souris", "fr"), (10, "der Hund und die Katze", None)]
    got = {r.doc_id: r for r in langid.identify(with_clashes(docs(spark, rows))).collect()}
    assert {i for i, r in got.items() if r.lang_pred == "und"} == {1, 2, 3, 8}
    assert langid.identify(docs(spark, ODD).limit(0)).count() == 0
    unlabelled = docs(spark, [(1, "text", None)])
    assert langid.identify(unlabelled).first().lang_pred == "und"


ITEM = (
    "If Maria buys 12 apples for 3 dollars each and Peter buys 12 more for 5 dollars each how much money do they "
    "spend together on the market day when it rains"
)


def leaks_of(spark, texts, items):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = docs(spark, list(enumerate(texts)))
    return {(r.doc_id, r.item_id): r.share for r in decontam.leaks(rows, bench).collect()}


def test_decontamination_finds_other_values(spark):
    same = f"Some words before. {ITEM}. And some words after it."
    moved = same.replace("12", "47").replace("Maria", "Olga").replace("3 dollars", "8 dollars").replace("dollars", "euros")
    edited_once = ITEM.replace("12 apples", "13 apples")  # 12 stood twice, the other one stays
    clean = "This text has nothing to do with apples or markets but is long enough to hold several windows of words."
    got = leaks_of(spark, [same, moved, edited_once, clean], [ITEM])
    assert got.keys() == {(0, 0), (1, 0), (2, 0)}
    assert got[(0, 0)] == got[(1, 0)] == 1.0 and got[(2, 0)] < 1.0


def test_decontamination_checks_slots(spark):
    item = "pay 5 then 5 and 5 or 5 plus 5 for 5 now"
    same_value, other_values = item.replace("5", "9"), "pay 1 then 2 and 3 or 4 plus 6 for 7 now"
    assert leaks_of(spark, [same_value, other_values], [item]).keys() == {(0, 0)}


def test_decontamination_finds_verbatim_items(spark, table, plain):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = bench.toPandas().text
    want = {i for i, t in zip(plain.doc_id, plain.text) if any(x in t for x in items)}
    got = {r.doc_id for r in decontam.decontaminate(table, bench).filter("contaminated").collect()}
    assert want <= got and len(got - want) <= 0.01 * len(plain)


def brute_leaks(texts, items, cover=0.5):
    """Window by window over all pairs, with the same template rules."""
    found = {}
    for d, text in enumerate(texts):
        dc, dv, _ = decontam.template(text)
        for i, item in enumerate(items):
            ic, iv, slot = decontam.template(item)
            width = min(decontam.WIDTH, len(ic))
            lines = {}
            for p in range(len(ic) - width + 1):
                if (~slot[p : p + width]).sum() < min(decontam.PLAIN, width):
                    continue
                for q in range(len(dc) - width + 1):
                    if (ic[p : p + width] == dc[q : q + width]).all():
                        pairs = {(iv[p + k], dv[q + k]) for k in range(width) if slot[p + k]}
                        lines.setdefault(q - p, []).append((p, pairs))
            words_in = set()
            for line in lines.values():
                stands_for = {}
                for _, pairs in line:
                    for a, b in pairs:
                        stands_for.setdefault(a, set()).add(b)
                for p, pairs in line:
                    if all(len(stands_for[a]) == 1 for a, _ in pairs):
                        words_in.update(range(p, p + width))
            if words_in and len(words_in) / len(ic) >= cover:
                found[(d, i)] = len(words_in) / len(ic)
    return found


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(2)
    pool = ["the", "cat", "Anna", "Bob", "7", "12", "km", "walks", "to", "town.", "and", "sees", "3", "kg", "of", "rice"]
    items = [" ".join(rng.choice(pool) for _ in range(rng.choice([2, 5, 9, 20]))) for _ in range(25)] + ["", None]
    texts = [" ".join(rng.choice(pool) for _ in range(60)) for _ in range(20)]
    texts += [f"x y z {it} q r s" for it in items[:20]] + [None, ""]
    got = leaks_of(spark, texts, items)
    want = brute_leaks([t or "" for t in texts], [i or "" for i in items])
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)


def test_decontamination_finds_words_without_a_template(spark):
    dense = "On 12 May 2019 Anna Bob 7 km 3"  # 10 words
    tail = [f"word{i}" for i in range(59)]
    items = ["What is 12 plus 7?", "What is 17 km?", "1914 1918 1939 1945", dense, "Berlin", " ".join(tail)]
    texts = [f"so then. {x} and on" for x in items[:5]]
    texts += [" ".join(["before", *tail[20:49], "after"]), "What is 13 plus 8? What is 18 km? 1914 1918 1939 1946"]
    texts += [" ".join(["before", *tail[20:32], "after"])]  # one word short of a run
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = docs(spark, list(enumerate(texts)))
    got = {(r.doc_id, r.item_id): r.share for r in decontam.hits(rows, bench).collect()}
    assert got.keys() == {(i, i) for i in range(6)} and got[(5, 5)] == pytest.approx(29 / 59)
    assert all(got[(i, i)] == 1.0 for i in range(5))
    assert {r.doc_id for r in decontam.decontaminate(rows, bench).filter("contaminated").collect()} == set(range(6))


def test_decontamination_odd_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    odd = with_clashes(docs(spark, ODD))
    assert decontam.decontaminate(odd, none).filter("contaminated").count() == 0
    bench = spark.createDataFrame([(1, "one two"), (2, None), (3, "")], "item_id long, text string")
    got = decontam.decontaminate(odd, bench).collect()
    assert len(got) == len(ODD) and [r.contaminated for r in got if r.doc_id == 4] == [True, True]
    assert decontam.decontaminate(docs(spark, ODD).limit(0), bench).count() == 0
