"""Small frames and plain versions of the operators to compare with."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, rows):
    """Documents from (doc_id, text), (doc_id, text, lang) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def with_clashes(df):
    """The same rows with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    for name in ("rep", "bucket", "shard", "n_tokens", "_key", "component_id", "window", "word", "_copies", "slot", "part", "held_out"):
        df = df.withColumn(name, F.lit("x"))
    return df


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text):
    w = words(text)
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows, percent=85):
    """doc_id -> smallest reachable doc_id, over all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    holders = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(k)
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, s) in enumerate(sets):
        common = Counter(j for x in s for j in holders[x] if j < k)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                a, b = find(i), find(sets[j][0])
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in parent}
