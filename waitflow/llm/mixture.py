"""Mixing sources by temperature: shares to a power, bisected to a target, realised as block permutations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitflow.llm.store import stored

REPETITION_LIMIT = 1.25
SEED = "mix-1"
BLOCK = 4096  # documents of a block on average
STEPS, ROUNDS = 32, 6  # the exponent is found to 32 ** -6
WORD = "[^\x20\x09-\x0d]+"


def _key(source: Column) -> Column:
    """Source as a join key; NULL is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("-"))


def bisect_exponent(sources: DataFrame, repetition_limit: float | None, target_entropy: float | None) -> float:
    """Smallest exponent in [0, 1] whose weights keep to the limit, or to an entropy of at most the target (nats).

    sources: key, tokens (above 0). Weights are tokens ** exponent, normalised. An exponent of 1 keeps the natural
    shares, 0 makes all sources equal; repetition and entropy both fall as it grows. Each round tests a grid of STEPS
    exponents in one aggregate, so that any number of sources stays distributed. If no exponent meets an entropy
    target, the natural shares are taken.
    """
    smallest, largest, total = sources.agg(F.min("tokens"), F.max("tokens"), F.sum("tokens")).first()
    if smallest is None:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [low + (high - low) * i / STEPS for i in range(STEPS)]
        if repetition_limit is not None:
            fits = [(smallest / largest) ** (a - 1) <= repetition_limit for a in grid]
        else:
            share = F.col("tokens") / F.lit(float(total))
            row = sources.agg(
                *[F.sum(F.pow(share, F.lit(a))).alias(f"z{i}") for i, a in enumerate(grid)],
                *[F.sum(F.pow(share, F.lit(a)) * F.log(share) * a).alias(f"e{i}") for i, a in enumerate(grid)],
            ).first()
            # Entropy of the weights: log z minus the mean of log share ** a.
            fits = [math.log(row[f"z{i}"]) - row[f"e{i}"] / row[f"z{i}"] <= target_entropy for i in range(STEPS)]
        width = (high - low) / STEPS
        k = fits.index(True) if True in fits else STEPS
        if k == 0:
            return low
        low, high = low + (k - 1) * width, low + k * width
    return high


def mix_plan(
    docs: DataFrame,
    repetition_limit: float | None = REPETITION_LIMIT,
    target_entropy: float | None = None,
    budget: int | None = None,
    seed: str = SEED,
) -> DataFrame:
    """doc_id, source, n_tokens, exponent, weight, copies, block and place for every row.

    Tokens are words. Without a budget (in tokens) every source gets one whole epoch at least, so nothing is left out
    and no source is repeated more often than the limit. A source's budget is spent in whole epochs and then in one
    partial epoch over its permutation: documents fall into blocks by hash, blocks follow each other, documents of a
    block are ordered by hash. Token sums run over blocks first and then inside blocks, so a source with a third of
    all rows is no single task.

    A NULL source is a source of its own; rows without words (NULL or empty text) cost nothing and get one copy;
    repeated rows are separate rows of the permutation; an empty table gives no rows.
    """
    if (repetition_limit is None) == (target_entropy is None):
        raise ValueError("give either a repetition limit or a target entropy")
    n_tokens = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    slim = stored(docs.select("doc_id", "source", n_tokens.alias("n_tokens"), key.alias("_key"), _key(F.col("source")).alias("_source")), "mix")
    sources = stored(
        slim.groupBy("_source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs")), "sources"
    )
    exponent = bisect_exponent(sources.filter("tokens > 0"), repetition_limit, target_entropy)
    everything = Window.partitionBy()  # one row per source
    weighed = sources.withColumn("_power", F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(exponent))).otherwise(0.0))
    weighed = weighed.withColumn("weight", F.try_divide("_power", F.sum("_power").over(everything)))
    whole = F.max(F.try_divide("tokens", "weight")).over(everything) if budget is None else F.lit(float(budget))
    shares = weighed.withColumn("_budget", F.round(F.col("weight") * whole).cast("long")).select(
        "_source",
        "tokens",
        F.round("weight", 9).alias("weight"),
        F.when(F.col("tokens") > 0, F.expr("_budget DIV tokens")).otherwise(1).alias("epochs"),
        F.when(F.col("tokens") > 0, F.expr("_budget % tokens")).otherwise(0).alias("rest"),
        F.expr(f"(n_docs + {BLOCK - 1}) DIV {BLOCK}").alias("n_blocks"),
    )
    number = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    dealt = slim.join(shares, "_source").withColumn("block", F.pmod(number, F.col("n_blocks")).cast("int"))
    blocks = dealt.groupBy("_source", "block").agg(F.sum("n_tokens").alias("_block_tokens"))
    before = Window.partitionBy("_source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("_source", "block", F.coalesce(F.sum("_block_tokens").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_source", "block").orderBy("_key", F.asc_nulls_first("doc_id"), "n_tokens")
    placed = dealt.join(starts, ["_source", "block"]).withColumns(
        {
            "_upto": F.col("_before") + F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
            "place": F.row_number().over(inside).cast("int"),
        }
    )
    again = F.when((F.col("n_tokens") > 0) & (F.col("_upto") <= F.col("rest")), 1).otherwise(0)
    copies = F.when(F.col("n_tokens") > 0, F.col("epochs") + again).otherwise(1)
    return placed.select(
        "doc_id", "source", "n_tokens", F.lit(exponent).alias("exponent"), "weight", copies.cast("int").alias("copies"), "block", "place"
    )


def mix_plan_sql(repetition_limit: float = REPETITION_LIMIT, seed: str = SEED) -> str:
    """DuckDB SQL for the rows of mix_plan() under a repetition limit."""
    rounds = f"""
    search(n, low, high) AS (
        SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
        UNION ALL
        SELECT n + 1, CASE WHEN k = 0 THEN low ELSE low + (k - 1) * ((high - low) / {STEPS}) END,
            CASE WHEN k = 0 THEN low ELSE low + k * ((high - low) / {STEPS}) END
        FROM (SELECT n, low, high, coalesce((SELECT min(i) FROM range({STEPS}) r(i), ends
                WHERE pow(smallest / largest, low + (high - low) * i / {STEPS} - 1) <= {repetition_limit}), {STEPS}) AS k
              FROM search WHERE n < {ROUNDS}) s)"""
    return f"""
    WITH RECURSIVE slim AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens,
            md5('{seed}' || coalesce(doc_id::VARCHAR, '')) AS k, coalesce('=' || source, '-') AS s
        FROM documents),
    sources AS (SELECT s, sum(n_tokens)::BIGINT AS tokens, count(*) AS n_docs FROM slim GROUP BY s),
    ends AS (SELECT min(tokens)::DOUBLE AS smallest, max(tokens)::DOUBLE AS largest FROM sources WHERE tokens > 0),
    {rounds},
    chosen AS (SELECT high AS exponent FROM search WHERE n = {ROUNDS}),
    powers AS (SELECT s, tokens, n_docs, CASE WHEN tokens > 0 THEN pow(tokens::DOUBLE, exponent) ELSE 0.0 END AS p, exponent
        FROM sources, chosen),
    weighed AS (SELECT *, p / nullif(sum(p) OVER (), 0) AS weight FROM powers),
    budgets AS (SELECT *, round(weight * max(tokens / nullif(weight, 0)) OVER ())::BIGINT AS budget FROM weighed),
    shares AS (SELECT s, exponent, round(weight, 9) AS weight, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS epochs,
        CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest, (n_docs + {BLOCK - 1}) // {BLOCK} AS n_blocks FROM budgets),
    dealt AS (SELECT *, (('0x' || k[1:8])::BIGINT % n_blocks)::INTEGER AS block FROM slim JOIN shares USING (s)),
    placed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY s ORDER BY block, k, doc_id, n_tokens ROWS UNBOUNDED PRECEDING) AS upto,
        row_number() OVER (PARTITION BY s, block ORDER BY k, doc_id, n_tokens)::INTEGER AS place FROM dealt)
    SELECT doc_id, source, n_tokens, exponent, weight, block, place,
        (CASE WHEN n_tokens > 0 THEN epochs + (upto <= rest)::INTEGER ELSE 1 END)::INTEGER AS copies
    FROM placed"""


def mix(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """The documents themselves, each as often as the plan says; rows that share a doc_id share their copies."""
    times = plan.groupBy("doc_id").agg(F.max("copies").alias("_copies"))
    left, right = docs.alias("d"), times.withColumnRenamed("doc_id", "_id").alias("t")
    joined = left.join(right, F.col("d.doc_id").eqNullSafe(F.col("t._id")))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).filter("_copies > 0").select(
        *[F.col(f"d.`{c}`") for c in docs.columns]
    )
