"""Language-model scoring by logistic context mixing of hashed-context bit predictors.

A text is its lower-cased words and one end token, every word closed by a blank. Its bits are predicted one after the
other. Six predictors, each with a table of bit counts per hashed context (the last one to five bytes, and the whole
beginning of the word), give a probability each; these are added in the logistic domain
with weights gated by the bit's place and by how often its contexts were seen, and an adaptive map refines the sum. The score of a
text is the sum over all its bits; no token, seen in training or not, is priced otherwise.

The contexts of bytes go on across the blank into the word before. So the bits of a word's first HEAD bytes hang on
the last TAIL bytes of the word before it (an edge: these and those bytes, one number), and all further ones on the
word alone (its rest). Equal edges and equal rests have equal bits: the distinct ones are counted over all training
tokens, and train the tables, the weights and the map with these counts; weights and map are learned online, with
one occurrence of what is predicted taken out of the tables. Only the tables, whose size is fixed, pass through the driver.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitflow.llm.shingles import mix
from waitflow.llm.store import stored

CHUNK_BYTES = 16 << 20  # text whose words form one dictionary
ORDERS = 6
HEAD, TAIL = 2, 3  # first bytes of a word, whose contexts reach into the last bytes of the word before
SLOT_BITS = 21
SLOTS = 1 << SLOT_BITS
BLOCKS = 16  # pieces of one table that partial sums are shuffled by
TYPES_PER_TASK = 1_000_000
MOST_TASKS = 256  # partial tables; beyond that a task reads more words
SEEN = 4  # steps of how often a context was seen
ZONES = 3  # first byte, further bytes of the head, rest
GATES = 8 * ZONES * SEEN * SEEN
STEP = 0.25
BATCH_WORDS = 2048
BUCKETS = 33  # of the adaptive map, over the logistic domain from -8 to 8
PRIOR = 0.1
_U = np.uint64
_SALT = np.array([0x9AE16A3B2F90404F, 0xC949C7DEFB4B0F1B, 0x8F14E45FCEEA167B, 0xD1B54A32D192ED03, 0xABC98388FB8FAC03, 0xE7037ED1A0B428DB], _U)
_P = 0x9E3779B97F4A7C15


@dataclass
class Flat:
    """Bytes of many words (or of parts of words) side by side."""

    data: np.ndarray  # bytes
    word: np.ndarray  # number of the word
    zone: np.ndarray  # 0 for first bytes, 1 for others of the head, 2 for the rest
    contexts: np.ndarray  # (ORDERS, bytes) hashes


def _flat(data: np.ndarray, word: np.ndarray, place: np.ndarray, before: list[np.ndarray], whole: np.ndarray) -> Flat:
    """before: the byte k places earlier, plus 1; 0 for the blank before the word and for what is not there."""
    last = [before[0]]
    for ks in ((0, 1), (0, 1, 2), (0, 1, 2, 3), (0, 1, 2, 3, 4)):
        h = np.zeros(len(data), _U)
        for k in ks:
            h = h * _U(257) + before[k]
        last.append(h)
    last.append(whole)
    zone = (place > 0).astype(np.int64) + (place >= HEAD)
    return Flat(data, word, zone, np.stack([mix(c * _U(_P) + s) for c, s in zip(last, _SALT)]))


def _powers(n: int) -> np.ndarray:
    powers = np.full(max(n, 1), _P, _U)
    powers[0] = 1
    return np.cumprod(powers, dtype=_U)


def flatten(words: list[bytes], skip: int = 0) -> Flat:
    """Words without a word before, each closed by a blank; the first bytes of each may be left out."""
    joined = b"".join(w + b" " for w in words)
    data = np.frombuffer(joined, np.uint8)
    sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    starts = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(data)) - starts[word]
    terms = (data.astype(_U) + _U(1)) * _powers(int(sizes.max()) if len(words) else 1)[place]
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(terms, dtype=_U)])
    at = np.flatnonzero(place >= skip)
    place, word = place[at], word[at]
    before = []
    for k in range(1, 6):
        there = place >= k
        before.append(np.where(there, data[np.where(there, at - k, 0)].astype(_U) + _U(1), _U(0)))
    return _flat(data[at], word, place, before, sums[at] - sums[starts[word]])


def letters(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The first HEAD bytes of each word closed by a blank, and its last TAIL bytes, as numbers below 2 ** 32."""
    data = np.frombuffer(b" ".join(words) + b" " * (HEAD + 1), np.uint8).astype(_U)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    heads, tails = np.zeros(len(words), _U), np.zeros(len(words), _U)
    for p in range(HEAD):
        heads = (heads << _U(8)) | np.where(p <= sizes, data[starts + np.minimum(p, sizes)], _U(0))
    for p in range(TAIL):
        tails |= np.where(p < sizes, data[starts + np.maximum(sizes - 1 - p, 0)], _U(0)) << _U(8 * p)
    return heads, tails


def edges_of(heads: np.ndarray, tails: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The edge of every token of texts that lie one behind the other; nothing is before a text's first word."""
    before = np.roll(tails[ids], 1)
    before[starts] = 0
    return (before << _U(32)) | heads[ids]


def _bytes_at(numbers: np.ndarray, n: int) -> np.ndarray:
    return np.stack([(numbers >> _U(8 * (n - 1 - p))) & _U(255) for p in range(n)], axis=1)


def flatten_edges(edges: np.ndarray) -> Flat:
    """The first HEAD bytes of words (or fewer, up to the closing blank) after the last bytes of the words before."""
    head, tail = _bytes_at(edges, HEAD), _bytes_at(edges >> _U(32), TAIL)
    none = np.zeros((len(edges), 5), _U)  # for what is further away than the tail
    codes = np.concatenate([none, tail + (tail > 0).astype(_U), none[:, :1], head + _U(1)], axis=1)
    blank = head == 32
    there = np.cumsum(blank, axis=1) - blank == 0  # nothing is behind the blank
    word, place = np.nonzero(there)
    sums = np.cumsum((head + _U(1)) * _powers(HEAD), axis=1, dtype=_U)
    whole = np.concatenate([none[:, :1], sums[:, :-1]], axis=1)[there]
    before = [codes[word, codes.shape[1] - HEAD + place - k] for k in range(1, 6)]
    return _flat(head[there].astype(np.uint8), word, place, before, whole)


def slots(flat: Flat, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """Table places (ORDERS, bytes) for one bit, given the bits above it, and the bit itself."""
    node = (_U(1) << _U(bit)) | (flat.data.astype(_U) >> _U(8 - bit))
    # The contexts are well mixed already, so one product spreads their nodes over the table.
    h = (flat.contexts ^ (node * _U(0xD6E8FEB86659FD93))[None, :]) * _U(_P)
    return (h >> _U(64 - SLOT_BITS)).astype(np.int64), ((flat.data >> (7 - bit)) & 1).astype(np.int64)


def _count(tables: np.ndarray, flat: Flat, counts: np.ndarray) -> None:
    w = counts[flat.word]
    for bit in range(8):
        at, y = slots(flat, bit)
        for order in range(ORDERS):
            np.add.at(tables[order].reshape(-1), at[order] + SLOTS * y, w)


def count_bits(tables: np.ndarray, words: list[bytes], counts: np.ndarray) -> None:
    """Adds words to tables of shape (ORDERS, 2, SLOTS)."""
    _count(tables, flatten(words), counts)


Inputs = tuple[np.ndarray, np.ndarray] | None  # table_inputs(model), if they are at hand


@dataclass
class Model:
    tables: np.ndarray  # (ORDERS, 2, SLOTS) float32
    weights: np.ndarray  # (GATES, ORDERS + 1)
    refine: np.ndarray  # (8, BUCKETS, 2)


def fresh(tables: np.ndarray) -> Model:
    refine = np.empty((8, BUCKETS, 2))
    p = 1 / (1 + np.exp(-np.linspace(-8, 8, BUCKETS)))
    refine[:, :, 1], refine[:, :, 0] = 4 * p, 4 * (1 - p)
    weights = np.full((GATES, ORDERS + 1), 0.3)
    weights[:, -1] = 0.0
    return Model(tables.astype(np.float32), weights, refine)


def _logit(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.log((n1 + np.float32(PRIOR)) / (n0 + np.float32(PRIOR)))


def _seen(n: np.ndarray) -> np.ndarray:
    """0 for nothing, 1 to SEEN - 1 for up to 3, up to 31 and more."""
    return (n > 0).astype(np.int64) + (n > 3) + (n > 31)


def _gate(bit: int, flat: Flat, seen: list[np.ndarray]) -> np.ndarray:
    """Which weights are used, by the bit, its zone, and how often the last two contexts were seen."""
    return ((bit * ZONES + flat.zone) * SEEN + seen[0]) * SEEN + seen[1]


def _inputs_without(model: Model, at: np.ndarray, own: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Logistic inputs (ORDERS + 1, bytes) with own counts left out, and how often the last two contexts were seen."""
    st, seen = np.full((ORDERS + 1, at.shape[1]), 0.3, np.float32), []
    own = own.astype(np.float32)
    own0, own1 = own * (y == 0), own * (y == 1)
    for order in range(ORDERS):
        n0 = np.maximum(model.tables[order, 0][at[order]] - own0, 0)
        n1 = np.maximum(model.tables[order, 1][at[order]] - own1, 0)
        st[order] = _logit(n0, n1)
        if order >= ORDERS - 2:
            seen.append(_seen(n0 + n1))
    return st, seen


def _refined(model: Model, bit: int, logit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of a 1 after the adaptive map, and the places in the map."""
    logit = np.clip(logit, -12, 12)
    p = 1 / (1 + np.exp(-logit))
    k = np.clip(np.round((logit + 8) * (BUCKETS - 1) / 16).astype(np.int64), 0, BUCKETS - 1)
    cell = model.refine[bit, k]
    return (p + cell[:, 1] / cell.sum(axis=1)) / 2, k


def _learn(model: Model, flat: Flat, counts: np.ndarray) -> None:
    mass_of = counts[flat.word].astype(np.float64)
    own = np.minimum(mass_of, 1.0)
    for bit in range(8):
        at, y = slots(flat, bit)
        st, seen = _inputs_without(model, at, own, y)
        gate = _gate(bit, flat, seen)
        logit = np.einsum("jn,nj->n", st, model.weights[gate])
        p, k = _refined(model, bit, logit)
        error = (y - p) * mass_of
        mass = np.bincount(gate, weights=mass_of, minlength=GATES)
        for j in range(ORDERS + 1):
            slope = np.bincount(gate, weights=error * st[j], minlength=GATES)
            model.weights[:, j] += STEP * slope / np.maximum(mass, 64)
        for value in (0, 1):
            model.refine[bit, :, value] += np.bincount(k, weights=mass_of * (y == value), minlength=BUCKETS)


def learn_online(model: Model, words: list[bytes], counts: np.ndarray) -> None:
    """One online step over a batch of words, one occurrence of each left out of the tables."""
    _learn(model, flatten(words), counts)


def table_inputs(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The logistic input of every table place, and how often the last two orders' places were seen."""
    return _logit(model.tables[:, 0], model.tables[:, 1]), _seen(model.tables[-2:].sum(axis=1)).astype(np.int8)


def _log10(model: Model, flat: Flat, n: int, inputs: Inputs) -> np.ndarray:
    """log10 probability of the bits of each of n words."""
    stretched, seen = inputs or table_inputs(model)
    total = np.zeros(len(flat.data))
    for bit in range(8):
        at, y = slots(flat, bit)
        gate = _gate(bit, flat, [seen[0][at[-2]], seen[1][at[-1]]])
        logit = 0.3 * model.weights[gate, -1]
        for order in range(ORDERS):
            logit += stretched[order][at[order]] * model.weights[gate, order]
        p, _ = _refined(model, bit, logit)
        total += np.log10(np.where(y == 1, p, 1 - p))
    return np.bincount(flat.word, weights=total, minlength=n)


def bits_log10(model: Model, words: list[bytes], inputs: Inputs = None) -> np.ndarray:
    """log10 probability of every word, with its closing blank, that no word is before."""
    return _log10(model, flatten(words), len(words), inputs)


def rests_log10(model: Model, words: list[bytes], inputs: Inputs = None) -> np.ndarray:
    """log10 probability of every word behind its first HEAD bytes, which the word before has no part in."""
    return _log10(model, flatten(words, HEAD), len(words), inputs)


def edges_log10(model: Model, edges: np.ndarray, inputs: Inputs = None) -> np.ndarray:
    """log10 probability of the first HEAD bytes of words after the last bytes of the words before them."""
    parts = [edges[at : at + 8 * BATCH_WORDS] for at in range(0, len(edges), 8 * BATCH_WORDS)]
    return np.concatenate([np.empty(0), *[_log10(model, flatten_edges(part), len(part), inputs) for part in parts]])


def _in_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Flat, np.ndarray]]:
    """Rests (rows with a word) and edges (the others), with their counts."""
    for whole in batches:
        for at in range(0, len(whole), BATCH_WORDS):
            batch = whole.slice(at, BATCH_WORDS)
            words, edges = batch["word"].drop_null().to_pylist(), batch["edge"].drop_null().to_numpy().view(_U)
            counts, is_edge = batch["c"].to_numpy(), batch["edge"].is_valid().to_numpy(zero_copy_only=False)
            rests, firsts = flatten(words, HEAD), flatten_edges(edges)
            flat = Flat(
                np.concatenate([rests.data, firsts.data]),
                np.concatenate([rests.word, firsts.word + len(words)]),
                np.concatenate([rests.zone, firsts.zone]),
                np.concatenate([rests.contexts, firsts.contexts], axis=1),
            )
            yield flat, np.concatenate([counts[~is_edge], counts[is_edge]])


def held_out(doc_id: Column, modulus: int = 7) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == 2, F.lit(False))


CHUNKS = "chunk long, doc_id long, held_out boolean, n_tokens long, n_bytes long, ids binary, place int, word binary, edge long, in_training long"
_CHUNK_TYPES = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]


class _Chunk:
    """Documents as places in a dictionary of words; the end token is the empty word."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.places: defaultdict[bytes, int] = defaultdict()
        self.places.default_factory = self.places.__len__  # a new word gets the next place
        self.places[b""]
        self.learned: list[np.ndarray] = []  # places of the words of training documents
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, held: bool, text: bytes) -> None:
        words = text.lower().split()
        words.append(b"")
        ids = np.fromiter(map(self.places.__getitem__, words), np.int32, len(words))
        if not held:
            self.learned.append(ids)
        self.rows.append((doc_id, held, len(words), sum(map(len, words)) + len(words), zlib.compress(ids.tobytes(), 1)))
        self.size += len(text)

    def batches(self) -> Iterator[pa.RecordBatch]:
        words, ids = [*self.places], np.concatenate([np.empty(0, np.int32), *self.learned])
        sizes = np.fromiter(map(len, self.learned), np.int64, len(self.learned))
        edges, counts = np.unique(edges_of(*letters(words), ids, np.cumsum(sizes) - sizes), return_counts=True)
        names = ["doc_id", "held_out", "n_tokens", "n_bytes", "ids"]
        yield self._batch(len(self.rows), dict(zip(names, zip(*self.rows))))
        yield self._batch(len(words), {"place": np.arange(len(words)), "word": words, "in_training": np.bincount(ids, minlength=len(words))})
        yield self._batch(len(edges), {"edge": edges.view(np.int64), "in_training": counts})

    def _batch(self, n: int, columns: dict) -> pa.RecordBatch:
        columns["chunk"] = np.full(n, self.number, np.int64)
        names = [c.split()[0] for c in CHUNKS.split(", ")]
        values = [pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(names, _CHUNK_TYPES)]
        return pa.record_batch(values, names=names)


def chunked(docs: DataFrame) -> DataFrame:
    """Documents as places of words, and the dictionaries of chunks of about CHUNK_BYTES of text they refer to.

    Rows with a word are dictionary rows (place, count in training documents), rows with an edge give its count in
    training documents; the others are documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, chunk = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            for doc_id, held, text in zip(
                batch["doc_id"].to_pylist(), batch["held_out"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()
            ):
                chunk = chunk or _Chunk((part << 32) | number)
                chunk.add(doc_id, held, text or b"")
                if chunk.size >= CHUNK_BYTES:
                    yield from chunk.batches()
                    chunk, number = None, number + 1
        if chunk:
            yield from chunk.batches()

    slim = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return slim.mapInArrow(run, CHUNKS)


def packed(counts: np.ndarray) -> bytes:
    """Counts as the upper halves of their floats (nine binary digits), small to send."""
    return zlib.compress((counts.astype(np.float32).view(np.uint32) >> 16).astype(np.uint16).tobytes(), 1)


def unpacked(blocks: tuple[tuple[int, bytes], ...]) -> np.ndarray:
    """Tables from their packed pieces."""
    tables, step = np.zeros((ORDERS, 2, SLOTS), np.float32), SLOTS // BLOCKS
    for block, raw in blocks:
        order, b = divmod(block, BLOCKS)
        halves = np.frombuffer(zlib.decompress(raw), np.uint16).astype(np.uint32)
        tables[order, :, b * step : (b + 1) * step] = (halves << 16).view(np.float32).reshape(2, step)
    return tables


_inputs: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # of the last tables a Python worker scored with


def _inputs_of(model: Model, blocks: tuple[tuple[int, bytes], ...]) -> tuple[np.ndarray, np.ndarray]:
    key = hash(blocks)
    if key not in _inputs:
        _inputs.clear()
        _inputs[key] = table_inputs(Model(unpacked(blocks), model.weights, model.refine))
    return _inputs[key]


def train(words: DataFrame, edges: DataFrame) -> tuple[Model, Broadcast]:
    """Weights and adaptive map, and the packed tables, from all words (word, c) and edges (edge, c) with a count above 0.

    Sums do not hang on how rows are dealt; for what is learned online they are dealt and sorted by hash, so the model
    does not hang on how the documents were dealt.
    """
    typed = words.filter("c > 0").selectExpr("word", "CAST(NULL AS BIGINT) AS edge", "c").unionByName(
        edges.selectExpr("CAST(NULL AS BINARY) AS word", "edge", "c")
    )
    n_types = typed.count()
    tasks = min(max(1, -(-n_types // TYPES_PER_TASK)), MOST_TASKS)
    by_hash = F.xxhash64("word", "edge")
    dealt = typed.repartition(tasks, by_hash).sortWithinPartitions(by_hash, "word", "edge")
    step = SLOTS // BLOCKS

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((ORDERS, 2, SLOTS), np.int64)
        for flat, counts in _in_batches(batches):
            _count(tables, flat, counts)
        if not tables.any():
            return
        for order in range(ORDERS):
            for b in range(BLOCKS):
                cut = tables[order, :, b * step : (b + 1) * step]
                yield pa.record_batch([pa.array([order * BLOCKS + b], pa.int32()), pa.array([zlib.compress(cut.tobytes(), 1)], pa.binary())], names=["block", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(2 * step, np.int64)
        for raw in rows["counts"]:
            total += np.frombuffer(zlib.decompress(raw), np.int64)
        return pd.DataFrame({"block": rows["block"].iloc[:1], "counts": [packed(total)]})

    summed = typed.repartition(tasks).mapInArrow(partial, "block int, counts binary").groupBy("block").applyInPandas(add, "block int, counts binary")
    pieces = summed.toArrow()  # at most ORDERS * SLOTS * 4 bytes in all, whatever the corpus
    blocks = tuple(sorted(zip(pieces["block"].to_pylist(), pieces["counts"].to_pylist())))
    shared = words.sparkSession.sparkContext.broadcast(blocks)

    def online(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, mass = fresh(unpacked(shared.value)), 0
        for flat, counts in _in_batches(batches):
            _learn(model, flat, counts)
            mass += int(counts.sum())
        if mass:
            yield pa.record_batch(
                [pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.refine.tobytes()], pa.binary()), pa.array([mass])],
                names=["weights", "refine", "mass"],
            )

    model, mass = fresh(np.empty(0)), 0
    got = dealt.mapInArrow(online, "weights binary, refine binary, mass long").collect()  # one row per task, at most MOST_TASKS
    if got:
        mass = sum(r.mass for r in got)
        got.sort(key=lambda r: bytes(r.weights))
        model.weights = sum(np.frombuffer(r.weights).reshape(model.weights.shape) * (r.mass / mass) for r in got)
        model.refine = sum(np.frombuffer(r.refine).reshape(model.refine.shape) for r in got)
    return model, shared


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for every row.

    A NULL or empty text is the end token alone. Without a training document all counts are 0, and the texts are
    scored by untrained bits. Repeated rows are all scored (and all learned from). A NULL doc_id is a training
    document. Columns other than doc_id and text are not read; an empty table gives no rows.
    """
    parts = stored(chunked(docs), "chunks")
    words = parts.filter("word IS NOT NULL").select("chunk", "place", "word", "in_training")
    types = stored(words.groupBy("word").agg(F.sum("in_training").alias("c")), "types")
    edges = stored(parts.filter("edge IS NOT NULL").groupBy("edge").agg(F.sum("in_training").alias("c")), "edges")
    row = types.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total"), F.count_if(F.col("c") > 0).alias("distinct")).first()
    total = row.total
    model, tables = train(types, edges)
    base_log = float(np.log10(total + row.distinct + 1))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inputs = _inputs_of(model, tables.value)
        for whole in batches:
            for at in range(0, len(whole), BATCH_WORDS):
                batch = whole.slice(at, BATCH_WORDS)
                found = batch["word"].to_pylist()
                heads, tails = letters(found)
                ends = ((tails << _U(32)) | heads).view(np.int64)
                rest = rests_log10(model, found, inputs)
                yield pa.record_batch([batch["word"], batch["c"], pa.array(ends), pa.array(rest.astype(np.float32))], names=["word", "c", "ends", "rest"])

    rated = types.mapInArrow(rate, "word binary, c long, ends long, rest float")
    looked_up = words.select("chunk", "place", "word").join(rated, "word").select(F.col("chunk").alias("of_chunk"), "place", "c", "ends", "rest")
    texts = parts.filter("ids IS NOT NULL").select("chunk", "doc_id", "held_out", "n_tokens", "n_bytes", "ids")

    def finish(docs_of: pa.Table, dictionary: pa.Table) -> pa.Table:
        inputs = _inputs_of(model, tables.value)
        order = np.argsort(dictionary["place"].to_numpy())
        c, rest = dictionary["c"].to_numpy()[order], dictionary["rest"].to_numpy()[order].astype(np.float64)
        ends = dictionary["ends"].to_numpy()[order].view(_U)
        base = np.log10(c + 1.0) - base_log
        rows = [np.frombuffer(zlib.decompress(raw), np.int32) for raw in docs_of["ids"].to_pylist()]
        ids = np.concatenate(rows)
        stops = np.cumsum(docs_of["n_tokens"].to_numpy())
        starts = stops - docs_of["n_tokens"].to_numpy()
        found, own = np.unique(edges_of(ends & _U(0xFFFFFFFF), ends >> _U(32), ids, starts), return_inverse=True)
        bits = rest[ids] + edges_log10(model, found, inputs)[own]
        scores = np.array([bits[a:b].sum() for a, b in zip(starts, stops)])
        return pa.table(
            {
                "doc_id": docs_of["doc_id"],
                "held_out": docs_of["held_out"],
                "n_tokens": docs_of["n_tokens"],
                "n_known": np.array([(c[r] > 0).sum() for r in rows], np.int64),
                "train_tokens": np.full(len(rows), total, np.int64),
                "base_score": np.array([base[r].sum() for r in rows]),
                "score": scores,
                "bits_per_byte": -scores / np.log10(2.0) / docs_of["n_bytes"].to_numpy(),
            }
        )

    return texts.groupBy("chunk").cogroup(looked_up.groupBy("of_chunk")).applyInArrow(
        finish,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double",
    )
