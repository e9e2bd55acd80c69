"""URL filter: exact host/path rules, then pattern rules found through their rarest literal token.

A pattern is literal text with three signs: `||` in front anchors it at the start of the host or of one of
its labels, `*` stands for any text and `^` for a separator or the end. A token of a pattern is a run of a-z0-9
that is whole in every URL the pattern fits, i.e. has no `*` and no open end beside it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Fixed values: (verdict, host, path) of the exact rules.
HOST_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

# Production patterns; a rule number is a position in this list and the lowest one that fits is reported.
PATTERNS = [
    "||ads-track.",
    "||free-bets.",
    "||ads.",
    "||adserver.",
    "||casino.",
    "||doubleclick.",
    "/banner/*.gif^",
    "/adframe/",
    "/click?*&ad=",
    "-casino-",
    "^pop-under^",
    "/sponsored-links/",
]

_END = r"[^a-z0-9_.%-]"


def tokens_of(pattern: str) -> list[str]:
    """Literal tokens that every fitting URL holds whole."""
    anchored = pattern.startswith("||")
    body = pattern.removeprefix("||")
    found = []
    for m in re.finditer("[a-z0-9]+", body):
        before = "." if m.start() == 0 and anchored else body[m.start() - 1 : m.start()]
        after = body[m.end() : m.end() + 1]
        if before not in ("", "*") and after not in ("", "*"):
            found.append(m[0])
    return list(dict.fromkeys(found))


def regex_of(pattern: str) -> str:
    """The pattern as a regular expression that Java and RE2 read alike; it is run on the lower-cased URL."""
    body = pattern.removeprefix("||")
    text = "".join({"*": ".*", "^": f"(?:{_END}|$)"}.get(c) or re.escape(c) for c in body)
    return ("^[a-z0-9+.-]*://(?:[^/?#]*[.])?" if pattern.startswith("||") else "") + text


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; NULL where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def pattern_hits(urls: DataFrame, patterns: list[str]) -> DataFrame:
    """(url, rule_no) for every distinct URL that a pattern fits.

    The number of URLs holding each token is counted over the whole table, every pattern is filed under its
    rarest token, and a URL's tokens fetch the patterns whose expression is then run. Patterns without a whole
    token are run on every URL. The table of patterns is a parameter and small; the join picks its own side.
    """
    spark = urls.sparkSession
    words = F.array_distinct(F.regexp_extract_all("_low", F.lit("[a-z0-9]+"), F.lit(0)))
    low = urls.select("url", lower_ascii(F.col("url")).alias("_low"))
    tokens = low.select("url", "_low", F.explode(words).alias("token"))
    schema = T.StructType(
        [T.StructField("rule_no", T.IntegerType()), T.StructField("token", T.StringType()), T.StructField("regex", T.StringType())]
    )
    filed = [(i, t, regex_of(p)) for i, p in enumerate(patterns) for t in tokens_of(p)]
    known = spark.createDataFrame(filed, schema)
    counts = tokens.join(known.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    rarest = Window.partitionBy("rule_no").orderBy(F.coalesce("count", F.lit(0)), "token")
    index = (
        known.join(counts, "token", "left")
        .withColumn("_nth", F.row_number().over(rarest))
        .filter("_nth = 1")
        .select("token", "rule_no", "regex")
    )
    hits = tokens.join(index, "token").filter(F.expr("_low RLIKE regex")).select("url", "rule_no")
    for i, p in enumerate(patterns):
        if not tokens_of(p):
            hits = hits.unionByName(low.filter(F.col("_low").rlike(regex_of(p))).select("url", F.lit(i).alias("rule_no")))
    return hits


def judge(
    pages: DataFrame, rules: list[tuple[str, str, str]] = HOST_RULES, patterns: list[str] = PATTERNS
) -> DataFrame:
    """page_id, host, path, rule, verdict, pattern for every row.

    A NULL url, or one without `://`, has an empty host and path and is allowed unless a pattern fits; an empty
    table gives an empty result; repeated rows are all kept; columns other than page_id and url are not read.
    """
    own = pages.select("page_id", "url")
    first = (
        pattern_hits(own.filter("url IS NOT NULL").select("url").distinct(), patterns)
        .groupBy("url")
        .agg(F.min("rule_no").alias("rule_no"))
    )
    names = F.array(*[F.lit(p) for p in patterns]) if patterns else F.array().cast("array<string>")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = own.join(first, "url", "left").withColumns({"host": host, "path": path})
    rule, verdict = host_rule(F.col("host"), F.col("path"), rules)
    by_pattern = F.when(F.col("rule_no").isNotNull(), "block").otherwise("allow")
    return judged.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, by_pattern).alias("verdict"),
        F.get(names, F.col("rule_no")).alias("pattern"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def judge_sql(rules: list[tuple[str, str, str]] = HOST_RULES, patterns: list[str] = PATTERNS) -> str:
    """DuckDB SQL for the rows of judge(); the patterns are simply tried one after the other."""
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in longest]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, longest)) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN '{w}'" for f, (w, _, _) in zip(fits, longest)) + " END"
    pattern = "CASE " + " ".join(f"WHEN regexp_matches(low, {_quoted(regex_of(p))}) THEN {_quoted(p)}" for p in patterns) + " END"
    return f"""
    WITH parts AS (
        SELECT page_id, translate(url, '{UPPER}', '{LOWER}') AS low,
            translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
            coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages),
    found AS (SELECT page_id, host, path, {rule} AS rule, {verdict} AS by_rule, {pattern} AS pattern FROM parts)
    SELECT page_id, host, path, rule, pattern,
        coalesce(by_rule, CASE WHEN pattern IS NULL THEN 'allow' ELSE 'block' END) AS verdict
    FROM found"""
