"""Near duplicates: MinHash bands propose pairs, a sequential Bayesian test prunes them, full sets decide.

Documents with the same shingle set are one class, represented by its smallest doc_id; only representatives are
banded. Every member is first compared with the smallest one that it shares a bucket with. Then, in each bucket,
members that are still in different components are compared with each other inside blocks of bounded size: the
sequential test prunes on signatures, survivors are verified on their sets in the block, and two components are
compared no further once a link joins them. So a bucket of many copies sends on about one link per component, and
a bucket of strangers still gets all of its comparisons.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitflow.llm.components import components
from waitflow.llm.shingles import mix, shingle_set
from waitflow.llm.store import stored

PERCENT = 85  # pairs with 100 * intersection >= 85 * union are linked
BANDS, ROWS = 25, 5  # a pair at 0.85 shares no band with a probability of 8e-7
HASHES = 128
BATCH = 32
MISS = 1e-6  # a pair is pruned when its posterior chance of reaching the threshold is below this
BLOCK = 512  # members of a bucket that meet in one comparison block

_rng = np.random.Generator(np.random.PCG64(20240229))
_XOR = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)[:, None]
_MULTIPLY = (_rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_BAND_SALT = _rng.integers(0, 1 << 63, BANDS, dtype=np.uint64)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The smallest of each of HASHES scrambled 32-bit values over a set."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(best, ((x[None, i : i + 2048] ^ _XOR) * _MULTIPLY).min(axis=1), out=best)
    return best


def least_matches(percent: int = PERCENT, miss: float = MISS) -> list[tuple[int, int]]:
    """(hashes compared, matches needed to go on) after each batch.

    With a uniform prior on the similarity, the chance that it is at least t after m matches in n is the chance of
    at most m successes in n + 1 trials of probability t; below `miss` the pair is dropped.
    """
    t, steps = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        steps.append((n, m))
    return steps


def survivors(a: np.ndarray, b: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Positions of the signature pairs (rows of a and b) that no step prunes."""
    left, same, start = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, needed in steps:
        same = same + (a[left, start:n] == b[left, start:n]).sum(axis=1)
        keep = same >= needed
        left, same, start = left[keep], same[keep], n
    return left


def _matrix(column: pa.Array) -> np.ndarray:
    """Signatures of an Arrow column of binaries as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, hash of the whole set and signature of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, signs = [], [], []
            for text in batch["text"].cast(pa.binary()).to_pylist():
                s = shingle_set(text or b"")
                n.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                signs.append(signature(s).tobytes() if len(s) else None)
            yield pa.record_batch(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.binary())],
                names=["doc_id", "n_shingles", "set_key", "signature"],
            )

    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_key binary, signature binary"
    )


def bands(classes: DataFrame) -> DataFrame:
    """(bucket, band, rep) for every band of every class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            rows = _matrix(batch["signature"])[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
            h = np.broadcast_to(_BAND_SALT, rows.shape[:2]).copy()
            for i in range(ROWS):
                h = mix(h ^ (rows[:, :, i] * np.uint64(0x9E3779B97F4A7C15)))
            reps = np.repeat(batch["rep"].to_numpy(), BANDS)
            band = np.tile(np.arange(BANDS, dtype=np.int32), len(batch))
            yield pa.record_batch(
                [pa.array(h.reshape(-1).view(np.int64)), pa.array(band), pa.array(reps)], names=["bucket", "band", "rep"]
            )

    return classes.select("rep", "signature").mapInArrow(run, "bucket long, band int, rep long")


def test_pairs(pairs: DataFrame, classes: DataFrame, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """Pairs (a, b) that the sequential test does not prune."""
    steps = least_matches(percent, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = survivors(_matrix(batch["sign_a"]), _matrix(batch["sign_b"]), steps)
            yield batch.select(["a", "b"]).take(pa.array(kept))

    signs = classes.select("rep", "signature")
    both = pairs.join(signs.withColumnsRenamed({"rep": "a", "signature": "sign_a"}), "a").join(
        signs.withColumnsRenamed({"rep": "b", "signature": "sign_b"}), "b"
    )
    return both.select("a", "b", "sign_a", "sign_b").mapInArrow(run, "a long, b long")


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, hashes) of the documents named in wanted; texts are dealt out by doc_id once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingle_set(t or b"").tobytes() for t in batch["text"].cast(pa.binary()).to_pylist()]
            yield pa.record_batch([batch["doc_id"], pa.array(made, pa.binary())], names=["doc_id", "hashes"])

    own = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").join(wanted.hint("merge"), "doc_id", "left_semi")
    return own.mapInArrow(run, "doc_id long, hashes binary")


def verify(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for i, (x, y) in enumerate(zip(batch["set_a"].to_pylist(), batch["set_b"].to_pylist())):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    good.append(i)
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    both = pairs.join(sets.withColumnsRenamed({"doc_id": "a", "hashes": "set_a"}), "a").join(
        sets.withColumnsRenamed({"doc_id": "b", "hashes": "set_b"}), "b"
    )
    return both.select("a", "b", "set_a", "set_b").mapInArrow(exact, "a long, b long")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, also across batches; rows come sorted by the keys."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        if not len(table):
            continue
        change = np.zeros(len(table) - 1, bool)
        for k in keys:
            v = table[k].to_numpy()
            change |= v[1:] != v[:-1]
        cuts = [0, *(change.nonzero()[0] + 1)]
        for a, b in zip(cuts, cuts[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(cuts[-1])
    if rest is not None and len(rest):
        yield rest


def _first_shared(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The first band that a signature shares with each of many (BANDS if none)."""
    same = (many[:, : BANDS * ROWS] == one[: BANDS * ROWS]).reshape(-1, BANDS, ROWS).all(axis=2)
    return np.where(same.any(axis=1), same.argmax(axis=1), BANDS)


def _link_block(rep, comp, chunk, low, high, band, signs, sets, steps, percent) -> list[tuple[int, int]]:
    """Links that join the components of one block."""
    comp = comp.copy()
    sizes = np.array([len(x) for x in sets])
    ends = np.cumsum(sizes)
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    marks = np.zeros(int(ids.max()) + 1, np.int64)
    left, right = (chunk == low).nonzero()[0], (chunk == high).nonzero()[0]
    links = []
    for i in left:
        other = right[(comp[right] != comp[i]) & ((rep[right] > rep[i]) | (low != high))]
        if not len(other):
            continue
        other = other[survivors(np.broadcast_to(signs[i], (len(other), HASHES)), signs[other], steps)]
        # A pair that meets in several buckets is verified in the first of them.
        other = other[_first_shared(signs[i], signs[other]) == band]
        if not len(other):
            continue
        own = ids[ends[i] - sizes[i] : ends[i]]
        marks[own] = 1
        for a in range(0, len(other), 64):
            part = other[a : a + 64]
            part = part[comp[part] != comp[i]]
            if not len(part):
                continue
            common = np.array([marks[ids[ends[j] - sizes[j] : ends[j]]].sum() for j in part])
            linked = part[100 * common >= percent * (sizes[i] + sizes[part] - common)]
            for j in linked:
                if comp[j] != comp[i]:
                    links.append((int(min(rep[i], rep[j])), int(max(rep[i], rep[j]))))
                    comp[comp == comp[j]] = comp[i]
        marks[own] = 0
    return links


def link_buckets(members: DataFrame, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """Verified links (a, b) that join the components which meet in a bucket.

    members: bucket, band, rep, component, signature, hashes, n (members of the bucket). A bucket is dealt into
    chunks of about BLOCK members and every pair of chunks is a block of its own, so no task holds a large bucket.
    """
    steps = least_matches(percent, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["bucket", "low", "high"]):
            rep, comp, chunk = (group[c].to_numpy() for c in ("rep", "component", "chunk"))
            if len(set(comp.tolist())) < 2:
                continue
            low, high, band = (group[c][0].as_py() for c in ("low", "high", "band"))
            signs = _matrix(group["signature"].combine_chunks())
            sets = [np.frombuffer(x, np.uint64) for x in group["hashes"].to_pylist()]
            links = _link_block(rep, comp, chunk, low, high, band, signs, sets, steps, percent)
            if links:
                yield pa.record_batch([pa.array(c) for c in zip(*links)], names=["a", "b"])

    chunks = F.ceil(F.col("n") / BLOCK).cast("int")
    blocks = F.expr("transform(sequence(0, chunks - 1), j -> struct(least(chunk, j) AS low, greatest(chunk, j) AS high))")
    dealt = (
        members.withColumn("chunks", chunks)
        .withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
        .withColumn("block", F.explode(blocks))
        .select("bucket", "block.low", "block.high", "band", "chunk", "rep", "component", "signature", "hashes")
    )
    sorted_blocks = dealt.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return sorted_blocks.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept, for every row.

    A NULL, empty or blank text has no shingles and is linked with nothing. Repeated rows come back as often as
    they are given and share their component; a NULL doc_id takes no part and is kept. Columns other than doc_id
    and text are not read. An empty table gives no rows.
    """
    rows = stored(sketches(docs), "sketches")
    usable = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(
        usable.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature")), "classes"
    )
    placed = bands(classes)
    sizes = placed.groupBy("bucket").agg(F.min("rep").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stored(placed.join(sizes, "bucket"), "buckets")

    sets = stored(shingle_sets(docs, shared.select(F.col("rep").alias("doc_id")).distinct()), "sets")
    star = shared.filter("leader < rep").groupBy(F.col("rep").alias("b")).agg(F.min("leader").alias("a")).select("a", "b")
    links = stored(verify(test_pairs(star, classes, percent, miss), sets, percent), "links")
    first = components(links)
    labelled = shared.select("bucket", "band", "rep").join(first.withColumnRenamed("node", "rep"), "rep", "left")
    labelled = stored(labelled.withColumn("component", F.coalesce("component", "rep")), "members")
    mixed = (
        labelled.groupBy("bucket")
        .agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count(F.lit(1)).alias("n"))
        .filter("_low <> _high")
        .select("bucket", "n")
    )
    carried = classes.select("rep", "signature").join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    members = labelled.join(mixed, "bucket").join(carried, "rep")
    links = stored(links.union(link_buckets(members, percent, miss)), "links")
    final = components(links)

    by_class = classes.select("set_key", "rep").join(final.withColumnRenamed("node", "rep"), "rep", "left")
    placed_rows = rows.select("doc_id", "n_shingles", "set_key").join(
        by_class.select("set_key", F.coalesce("component", "rep").alias("component_id")), "set_key", "left"
    )
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return placed_rows.select("doc_id", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
