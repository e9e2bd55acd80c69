"""Approximate nearest neighbours with a hash-prefix forest.

Every tree hashes a vector to a long string of sign bits and keeps the strings sorted. A query descends to the
points sharing its longest prefix in each tree and then ascends in all trees at once, one bit at a time, until
the points reached are enough; those are ranked by their exact cosine.

Points are dealt to blocks by a hash of their id, every block keeps its share of all trees, and every query visits
every block. So the points under a prefix are those under it in all blocks, however many they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waitflow.llm.neardup import _groups
from waitflow.llm.store import stored

TREES = 32
BITS = 62
CANDIDATES = 14_000  # reached over all trees at least, a point counting once per tree
SHARE = 0.4  # of all points, where that is more: a fixed number loses neighbours as the table grows
BLOCK = 16_384  # points of a block that one task holds, on average
LEAST_BLOCKS = 8
QUERIES = 4_096  # queries that meet a block at a time, on average
TOP = 5
QUERY_STEP = 50
SEED = 7


def planes(tree: int, dim: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([SEED, tree, dim])).standard_normal((dim, BITS))


def usable(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is there, finite and not zero."""
    x = F.col(column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return df.filter(x.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(x, lambda v: v != 0))


HITS = "rep long, counts array<long>, hits array<struct<level: int, id: long, score: double>>"
_HITS = pa.schema(
    [
        ("rep", pa.int64()),
        ("counts", pa.list_(pa.int64())),
        ("hits", pa.list_(pa.struct([("level", pa.int32()), ("id", pa.int64()), ("score", pa.float64())]))),
    ]
)


class _Block:
    """The sorted prefix trees over the points of one block."""

    def __init__(self, rep: np.ndarray, x: np.ndarray, trees: int):
        self.rep, self.unit = rep, _unit(x)
        self.planes = [planes(tree, x.shape[1]) for tree in range(trees)]
        self.trees = []
        for p in self.planes:
            keys = _keys(x, p)
            order = np.argsort(keys, kind="stable")
            self.trees.append((keys[order], order))

    def offers(self, rep: np.ndarray, x: np.ndarray, enough: int, top: int) -> Iterator[dict]:
        """What the block offers to queries: points per prefix length over all trees, and the best ones of each length.

        A point counts at its longest prefix in any tree. One that `top` points of the same or longer prefixes beat is
        left out, as these are taken whenever it is.
        """
        shifts = BITS - np.arange(BITS + 1, dtype=np.int64)
        rising = np.arange(BITS + 1, dtype=np.int8)
        for first in range(0, len(rep), 64):
            part = x[first : first + 64]
            scores = _unit(part) @ self.unit.T
            starts = np.empty((len(self.trees), len(part), BITS + 1), np.int64)
            ends = np.empty_like(starts)
            for t, (keys, _) in enumerate(self.trees):
                low = (_keys(part, self.planes[t])[:, None] >> shifts) << shifts
                starts[t] = np.searchsorted(keys, low)
                ends[t] = np.searchsorted(keys, low + (np.int64(1) << shifts) - 1, "right")
            counts = (ends - starts).sum(axis=0)
            for q, row in enumerate(scores):
                stop = max(int((counts[q] >= enough).sum()) - 1, 0)  # this block alone is enough there
                levels = np.concatenate([rising[stop:], rising[stop:-1][::-1]])
                level = np.full(len(row), -1, np.int8)
                for t, (_, order) in enumerate(self.trees):
                    a, b = starts[t, q, stop:], ends[t, q, stop:]
                    if b[0] > a[0]:
                        sizes = np.concatenate([np.diff(a), b[-1:] - a[-1:], -np.diff(b)[::-1]])
                        own = order[a[0] : b[0]]
                        level[own] = np.maximum(level[own], np.repeat(levels, sizes))
                reached = (level >= 0).nonzero()[0]
                reached = reached[np.argsort(-level[reached], kind="stable")]
                cuts = np.concatenate([[0], np.diff(level[reached]).nonzero()[0] + 1, [len(reached)]])
                best, hits = np.empty(0, np.int64), []
                for u, v in zip(cuts, cuts[1:]):
                    both = np.concatenate([best, reached[u:v]])
                    at = np.argpartition(-row[both], top - 1)[:top] if len(both) > top else np.arange(len(both))
                    hits += [{"level": int(level[i]), "id": int(self.rep[i]), "score": float(row[i])} for i in both[at[at >= len(best)]]]
                    best = both[at]
                yield {"rep": int(rep[first + q]), "counts": counts[q].tolist(), "hits": hits}


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _keys(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return ((x @ p) > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def search(
    table: DataFrame,
    query_step: int = QUERY_STEP,
    top: int = TOP,
    trees: int = TREES,
    candidates: int = CANDIDATES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of every row whose vec_id is divisible by query_step.

    Equal vectors are one point that carries its top + 1 smallest ids, which is all that ties to the smaller id can
    ask for; queries with equal vectors are searched once. Blocks of about BLOCK points are dealt by hash, so neither
    a common vector nor a common prefix gathers in one task. A block holds its points; queries pass by it in parts.

    NULL, zero and non-finite vectors take no part, as do NULL ids; vectors are compared with those of their own
    length; repeated rows count once; if a vec_id has several vectors, their neighbours are pooled. An empty table
    gives no rows.
    """
    rows = usable(table.select("vec_id", "embedding").filter("vec_id IS NOT NULL"))
    ranked = rows.withColumn("_nth", F.dense_rank().over(Window.partitionBy("embedding").orderBy("vec_id")))
    few = ranked.filter(F.col("_nth") <= top + 1).groupBy("embedding").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    asked = rows.filter(F.col("vec_id") % query_step == 0).select("embedding").distinct().withColumn("_asked", F.lit(True))
    points = stored(
        few.join(asked, "embedding", "left").select(
            "embedding", "ids", F.get("ids", F.lit(0)).alias("rep"), F.coalesce("_asked", F.lit(False)).alias("is_query")
        ),
        "points",
    )
    n, n_queries = points.agg(F.count("*"), F.count_if("is_query")).first()
    enough = max(candidates, math.ceil(SHARE * n))
    blocks, parts = max(LEAST_BLOCKS, -(-n // BLOCK)), max(1, -(-n_queries // QUERIES))
    vectors = [F.size("embedding").alias("dim"), "rep", "embedding"]
    # Part 0 is the points of a block, the others are queries.
    held = points.select(F.pmod(F.xxhash64(F.lit(SEED), "rep"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("part"), *vectors)
    part = (F.pmod(F.xxhash64("rep"), F.lit(parts)) + 1).cast("int").alias("part")
    passing = points.filter("is_query").select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), part, *vectors)
    keys = ["block", "dim", "part"]
    dealt = held.unionByName(passing).repartition(blocks, "block").sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_block, place = None, None
        for group in _groups(batches, keys):
            block, dim, part = (group[k][0].as_py() for k in keys)
            rep = group["rep"].to_numpy()
            x = group["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            if part == 0:
                open_block, place = _Block(rep, x, trees), (block, dim)
            elif place == (block, dim):
                found = open_block.offers(rep, x, enough, top + 1)
                while some := list(islice(found, 256)):
                    yield pa.RecordBatch.from_pylist(some, _HITS)

    offers = dealt.mapInArrow(run, HITS)
    # One row per block and query: a list below holds the blocks times levels and top at most.
    pooled = offers.groupBy("rep").agg(F.collect_list("counts").alias("counts"), F.flatten(F.collect_list("hits")).alias("hits"))
    reached = F.transform(
        F.sequence(F.lit(0), F.lit(BITS)),
        lambda level: F.aggregate("counts", F.lit(0).cast("long"), lambda total, c: total + F.get(c, level)),
    )
    deep = F.array_max(F.filter(F.sequence(F.lit(0), F.lit(BITS)), lambda level: F.get("reached", level) >= enough))
    levelled = pooled.withColumn("reached", reached).withColumn("stop", F.coalesce(deep, F.lit(0)))
    taken = F.array_distinct(F.transform(F.filter("hits", lambda h: h["level"] >= F.col("stop")), lambda h: h["id"]))
    pairs = levelled.select("rep", F.explode(taken).alias("id"), F.col("hits"))
    score = F.array_max(F.transform(F.filter("hits", lambda h: h["id"] == F.col("id")), lambda h: h["score"]))
    scored = pairs.select("rep", "id", score.alias("score"))
    named = scored.join(points.select(F.col("rep").alias("id"), "ids"), "id").select(
        "rep", F.least("score", F.lit(1.0)).alias("score"), F.explode("ids").alias("vec_id")
    )
    best = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    lists = (
        named.groupBy("rep", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("_nth", F.row_number().over(best))
        .filter(F.col("_nth") <= top + 1)
        .groupBy("rep")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("v")))).alias("near"))
    )
    asks = rows.filter(F.col("vec_id") % query_step == 0).join(points.filter("is_query").select("embedding", "rep"), "embedding")
    answers = asks.select(F.col("vec_id").alias("query_id"), "rep").distinct().join(lists, "rep")
    own = F.slice(F.filter("near", lambda n: n["v"] != F.col("query_id")), 1, top)
    return answers.select("query_id", F.posexplode(own).alias("_at", "_n")).select(
        "query_id", (F.col("_at") + 1).cast("int").alias("rank"), F.col("_n.v").alias("vec_id"), (-F.col("_n.s")).alias("score")
    )
