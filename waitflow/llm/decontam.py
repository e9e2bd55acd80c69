"""Benchmark decontamination by templates.

Numbers, names and units become typed placeholders, so that a question asked again with other values keeps its
template. Windows of template words are hash-joined with those of the benchmark, matches on one diagonal
(document position minus item position) are put together, and the values behind the placeholders are compared: a
value that stands twice in the item must stand for the same value both times in the document, or else the windows
that hold it do not count.

Where a window has too few plain words to be told by its template, its words themselves are compared, and a long run
of an item's own words is a hit whatever its share of the item.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitflow.llm.shingles import mix
from waitflow.llm.store import stored

WIDTH = 8  # words of a window; an item with fewer words is one window of its own length
PLAIN = 4  # words of a full window that must be no placeholders
COVER = 0.5  # share of an item's words that must lie in matched windows
RUN = 13  # running words of an item that are a hit alone
FILTER_BITS = 24

# Unit words, recognised after a number.
UNITS = frozenset(
    "mm cm m km g kg mg t s ms min h hr hour hours minute minutes second seconds day days week weeks month months year years "
    "meter meters metre metres kilometer kilometers mile miles inch inches foot feet gram grams kilogram kilograms pound pounds "
    "liter liters litre litres ml l percent % dollar dollars euro euros cent cents usd eur $ € degree degrees mph kmh".split()
)
_EDGES = re.compile(r"^[^\w$€%]+|[^\w$€%]+$")
_NUMBER = re.compile(r"[+-]?[$€]?[0-9][0-9.,:/]*%?$")
_WORD, _NUM, _CAP, _UNIT = 0, 1, 2, 3
_CODES = np.array([0, 0x1111, 0x2222, 0x3333], np.uint64)
_Q = np.uint64(0xD6E8FEB86659FD93)
_MEMO = 500_000  # words remembered per Python worker


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text)


class _Words(dict):
    """Word -> number of its row in the arrays of facts; forgotten as a whole when full."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[tuple[int, int, bool]] = []
        self.facts = np.empty((1024, 3), np.uint64)
        self.filled = 0

    def __missing__(self, word: str) -> int:
        core = _EDGES.sub("", word)
        kind = _WORD
        if _NUMBER.match(core):
            kind = _NUM
        elif core.lower() in UNITS:
            kind = _UNIT
        elif core[:1].isupper() and core[1:] == core[1:].lower() and len(core) > 1:
            kind = _CAP
        ends = word[-1:] in ".!?:" or not core
        self.rows.append((_hash(core.lower() or word), kind, ends))
        self[word] = self.filled + len(self.rows) - 1
        return self[word]

    def of(self, ids: np.ndarray) -> np.ndarray:
        """(value, kind, ends a sentence) of some rows."""
        if self.rows:
            end = self.filled + len(self.rows)
            if end > len(self.facts):
                self.facts = np.concatenate([self.facts[: self.filled], np.empty((end, 3), np.uint64)])
            self.facts[self.filled : end] = self.rows
            self.filled, self.rows = end, []
        return self.facts[ids]


_memo = _Words()


def template(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, value, placeholder?) per word: code is what windows compare, value is the word itself.

    Words are split at white space. A capitalised word is a name unless it starts a sentence or a line; a unit word is
    a unit after a number.
    """
    global _memo
    if len(_memo) > _MEMO:
        _memo = _Words()
    ids: list[int] = []
    firsts: list[int] = []
    for line in text.splitlines():
        words = line.split()
        if words:
            firsts.append(len(ids))
            ids += map(_memo.__getitem__, words)
    if not ids:
        empty = np.empty(0, np.uint64)
        return empty, empty, np.empty(0, bool)
    facts = _memo.of(np.array(ids, np.int64))
    value, kind = facts[:, 0].copy(), facts[:, 1].astype(np.int64)
    starts = np.zeros(len(ids), bool)
    starts[firsts] = True
    starts[1:] |= facts[:-1, 2] == 1
    kind[(kind == _CAP) & starts] = _WORD
    kind[1:][(kind[1:] == _UNIT) & (kind[:-1] != _NUM)] = _WORD
    if kind[0] == _UNIT:
        kind[0] = _WORD
    slot = kind != _WORD
    return np.where(slot, _CODES[kind], value), value, slot


def windows(code: np.ndarray, slot: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the windows of one width that hold enough plain words."""
    n = len(code) - width + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = np.full(n, width, np.uint64)
    for i in range(width):
        h = h * _Q + code[i : i + n]
    sums = np.concatenate([[0], np.cumsum(~slot)])
    at = (sums[width:] - sums[:-width] >= min(PLAIN, width)).nonzero()[0]
    return at, mix(h[at])


def exact_windows(value: np.ndarray, slot: np.ndarray, width: int, most_plain: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the windows of word values with at most some plain words."""
    if len(value) < width:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    sums = np.concatenate([[0], np.cumsum(~slot)])
    at = (sums[width:] - sums[:-width] <= most_plain).nonzero()[0]
    h = np.full(len(at), width + 1000, np.uint64)
    for i in range(width):
        h = h * _Q + value[at + i]
    return at, mix(h)


def item_windows(code: np.ndarray, value: np.ndarray, slot: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, positions, hashes) of an item; the width of windows of word values is negative."""
    width = min(WIDTH, len(code))
    if width:
        yield width, *windows(code, slot, width)
        yield -width, *exact_windows(value, slot, width, min(PLAIN, width) - 1)
        yield -RUN, *exact_windows(value, slot, RUN, RUN)


def doc_windows(code: np.ndarray, value: np.ndarray, slot: np.ndarray, widths: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The same of a document. A word may be plain here and none in the item, as that hangs on the words before it."""
    for width in widths:
        if width > 0:
            yield width, *windows(code, slot, width)
        else:
            yield width, *exact_windows(value, slot, -width, RUN if width == -RUN else PLAIN + 2)


SCHEMA = "id long, n_words int, width int, position int, window long, item_values array<long>, slots array<boolean>"


def _rows(ids: list, texts: list, widths: list[int] | None, bits: np.ndarray | None) -> pa.RecordBatch:
    """Window rows of some texts. widths None: an item's own width. bits: windows that may be in the benchmark."""
    out: dict[str, list] = {k: [] for k in ("id", "n_words", "width", "position", "window", "item_values", "slots")}
    for i, text in zip(ids, texts):
        code, value, slot = template(text or "")
        for width, at, h in item_windows(code, value, slot) if widths is None else doc_windows(code, value, slot, widths):
            if bits is not None and len(h):
                k = h >> np.uint64(64 - FILTER_BITS)
                maybe = (bits[(k >> np.uint64(3)).astype(np.int64)] >> (k & np.uint64(7)).astype(np.uint8)) & 1 == 1
                at, h = at[maybe], h[maybe]
            signed = value.view(np.int64)
            for p, x in zip(at.tolist(), h.view(np.int64).tolist()):
                out["id"].append(i)
                out["n_words"].append(len(code))
                out["width"].append(width)
                out["position"].append(p)
                out["window"].append(x)
                end = p + width if width > 0 else p  # equal words leave nothing to compare
                out["item_values"].append(signed[p:end])
                out["slots"].append(slot[p:end])
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_())]
    return pa.record_batch([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))


def _window_frame(df: DataFrame, key: str, widths: list[int] | None, bits: np.ndarray | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _rows(batch["id"].to_pylist(), batch["text"].to_pylist(), widths, bits)

    return df.select(F.col(key).cast("long").alias("id"), "text").mapInArrow(run, SCHEMA)


def leaks(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """(doc_id, item_id, covered share) for every document that holds at least `cover` of an item's words in templates.

    Only windows with enough plain words are compared; hits() adds the others.
    """
    return _found(docs, benchmark, cover, False)


def hits(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """leaks(), also of words in windows that are no templates, and with every document that holds RUN running words.

    An item with fewer words than a window and too few plain ones is found by its words only. The share of a run may
    be below `cover`.
    """
    return _found(docs, benchmark, cover, True)


def _found(docs: DataFrame, benchmark: DataFrame, cover: float, exact: bool) -> DataFrame:
    """What leaks() and hits() return.

    Before the join, windows of documents are looked up in a bit set of 2 ** 24 slots that is filled from the
    benchmark; its size of 2 MB does not grow. What passes is joined by the window's hash.
    """
    items = stored(_window_frame(benchmark, "item_id", None, None).filter(F.lit(exact) | (F.col("width") > 0)), "items")
    slots = items.select((F.shiftrightunsigned("window", 64 - FILTER_BITS)).cast("int").alias("slot")).distinct()
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for batch in slots.toArrow().to_batches():  # at most 2 ** 24 numbers
        k = batch["slot"].to_numpy()
        np.bitwise_or.at(bits, k >> 3, (1 << (k & 7)).astype(np.uint8))
    widths = [r.width for r in items.select("width").distinct().collect()]  # at most 2 * WIDTH + 1 numbers
    if not widths:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, share double")
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _rows(batch["id"].to_pylist(), batch["text"].to_pylist(), widths, shared.value)

    found = docs.select(F.col("doc_id").cast("long").alias("id"), "text").filter("text IS NOT NULL").mapInArrow(run, SCHEMA)
    d = found.select(F.col("id").alias("doc_id"), "width", "window", F.col("position").alias("at"), F.col("item_values").alias("doc_values"))
    i = items.select(F.col("id").alias("item_id"), "n_words", "width", "window", "position", "item_values", "slots")
    matched = d.join(i, ["window", "width"]).select(
        "doc_id",
        "item_id",
        "n_words",
        (F.col("at") - F.col("position")).alias("diagonal"),
        "position",
        "width",
        # Values behind placeholders, item and document side by side.
        F.expr(
            "filter(zip_with(slots, arrays_zip(item_values, doc_values), (s, v) -> IF(s, v, NULL)), v -> v IS NOT NULL)"
        ).alias("pairs"),
    )
    # An item and a diagonal bound every collected list by the words of the item.
    lines = matched.groupBy("doc_id", "item_id", "n_words", "diagonal").agg(
        F.collect_set(F.struct("position", "width", "pairs")).alias("found"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
    )
    torn = "filter(pairs.item_values, v -> size(filter(pairs.item_values, w -> w = v)) > 1)"
    kept = "filter(found, f -> NOT arrays_overlap(f.pairs.item_values, torn))"
    words = "flatten(transform(kept, f -> sequence(f.position, f.position + abs(f.width) - 1)))"
    good = lines.withColumn("torn", F.expr(torn)).withColumn("kept", F.expr(kept)).withColumn("words", F.expr(words))
    covered = good.groupBy("doc_id", "item_id", "n_words").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("words")))).alias("n"),
        F.bool_or(F.exists("kept", lambda f: f["width"] == -RUN)).alias("run"),
    )
    share = F.col("n") / F.col("n_words")
    return covered.filter((F.col("n") > 0) & (F.col("run") | (share >= cover))).select("doc_id", "item_id", share.alias("share"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, cover: float = COVER) -> DataFrame:
    """doc_id, contaminated, n_items and best_item (the item covered most, ties to the smaller id) for every row.

    A NULL or empty text is clean, as is everything against an empty benchmark; NULL and empty items are ignored;
    repeated rows are all returned; rows without a doc_id are returned as clean. Other columns are not read.
    """
    dirty = hits(docs, benchmark, cover).filter("doc_id IS NOT NULL")
    by_doc = dirty.groupBy("doc_id").agg(
        F.count_distinct("item_id").alias("n_items"), F.min(F.struct(-F.col("share"), F.col("item_id"))).getField("item_id").alias("best_item")
    )
    joined = docs.select(F.col("doc_id").cast("long")).join(by_doc, "doc_id", "left")
    return joined.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"), "best_item")
