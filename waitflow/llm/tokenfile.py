"""Token files: Parquet rows with an id list per document, in global doc_id order, and their readers.

Layout of a folder: one Parquet file per range of doc_id; columns doc_id, part (the range), local_start (ids of
the range before the document), n_tokens and tokens (list of ids). The id list is dictionary encoded, the other
columns are delta encoded in V2 pages. Row groups and pages are kept small, and the writer adds page indexes, so
that a filter on doc_id reads few pages and a read of the metadata leaves the id column untouched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
MEMO_BYTES = 64 << 20  # pieces and ids remembered per Python worker; a memory, not a limit of what is encoded
PIECE_BYTES = 150  # of a remembered piece beside its text and ids
MEMO_WORD = 64  # longer pieces are encoded anew wherever they stand
SLICE = 1 << 20  # bytes of text that are encoded at once
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10

FILE_SCHEMA = "doc_id long, part int, local_start long, n_tokens long, tokens array<int>"
WRITE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.enable.dictionary": "true",
    **{f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "part", "local_start", "n_tokens")},
}

_BLANKS = bytes(0x20 if b in b"\n\t\r" else b for b in range(256))
_LOWERED = _BLANKS.lower()
# Kinds of bytes: 0 blank, 1 letter, 2 digit or sign, 3 whatever may belong to more than one kind of piece.
_KIND = np.full(256, 3, np.uint8)
_KIND[0x20] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KIND[[b for b in range(0x21, 0x7F) if _KIND[b] == 3 and chr(b) not in "'<|>"]] = 2
LOT = 4_000  # pieces that the library encodes at once

_memos: dict[str, "_Pieces"] = {}


class _Pieces:
    """Ids of pieces of text, remembered; the library encodes a piece when it is first met.

    The tokenizer folds case, cuts at white space, and cuts between a letter and a digit or sign before it looks for
    tokens, so the ids of a text are the ids of such pieces one after the other. A slice of text that holds one of the
    tokenizer's special strings in any case is cut at white space only and keeps its case.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        plain = lambda t: t.special and not (t.normalized or t.single_word or t.lstrip or t.rstrip)
        known = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if plain(t)]
        self.between_id, self.between = max(known, default=(-1, ""))
        self.clear()

    def clear(self) -> None:
        self.places: dict[bytes, int] = {}
        self.bytes = 0
        self.starts, self.ids = np.zeros(1, np.int64), np.empty(0, np.int32)

    def cut(self, raw: bytes, text_starts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Pieces of texts that lie one behind the other, and where each begins."""
        lowered = raw.translate(_LOWERED)
        plain = any(t in lowered for t in self.special)
        data = np.frombuffer(raw.translate(_BLANKS) if plain else lowered, np.uint8)
        kind = np.concatenate([[0], _KIND[data]])
        before, own = kind[:-1], kind[1:]
        begins = (own != 0) & (before == 0)
        if not plain:
            begins |= (own ^ before) == 3  # 1 beside 2, or a blank beside 3
        begins[text_starts[text_starts < len(data)]] = True
        begins &= own != 0
        inside = own != 0
        starts = np.flatnonzero(begins)
        offsets = np.append(np.cumsum(inside, dtype=np.int32)[starts] - 1, inside.sum()).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[inside].tobytes())]
        return pa.Array.from_buffers(pa.binary(), len(starts), buffers), starts

    def encode(self, pieces: list[bytes], memo_bytes: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and where those of each piece begin (and the last one's end)."""
        at = np.fromiter(map(self.places.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(at < 0)
        fresh = [pieces[i] for i in new.tolist()]
        found, sizes = self._fresh(fresh)
        at[new] = len(self.starts) - 1 + np.arange(len(new))
        starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        flat = np.concatenate([self.ids, found])
        lengths = starts[at + 1] - starts[at]
        ids = _gathered(flat, starts[at], lengths)
        own = np.fromiter(map(len, fresh), np.int64, len(fresh))
        short = own <= MEMO_WORD
        size = int((PIECE_BYTES + own + 4 * sizes)[short].sum())
        if self.bytes + size > memo_bytes:  # what stands in this slice has the common pieces; the others are let go
            own = np.fromiter(map(len, pieces), np.int64, len(pieces))
            fresh, sizes, found, short = pieces, lengths, ids, own <= MEMO_WORD
            self.clear()
            starts, flat = np.concatenate([[0], np.cumsum(sizes)]), found
            size = int((PIECE_BYTES + own + 4 * sizes)[short].sum())
        first = len(self.starts) - 1
        if short.all():
            self.starts, self.ids = starts, flat
        else:  # longer pieces leave their ids out as well
            fresh, found = [w for w, s in zip(fresh, short.tolist()) if s], found[np.repeat(short, sizes)]
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes[short])])
            self.ids = np.concatenate([self.ids, found])
        self.places.update(zip(fresh, range(first, first + len(fresh))))
        self.bytes += size
        return ids, np.concatenate([[0], np.cumsum(lengths)])

    def _fresh(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that the library encodes, one after the other, and how many each has.

        It reads a lot of pieces as one text, with a special string between them: it takes these out before all else,
        so each piece is encoded by itself. Where a piece holds that string, each is a text of its own.
        """
        found, sizes = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for low in range(0, len(pieces), LOT):
            lot = pieces[low : low + LOT]
            texts = [w.decode(errors="replace") for w in lot]
            text = self.between.join(texts)
            ids = ends = np.empty(0, np.int32)
            if self.between and text.count(self.between) == len(lot) - 1:
                ids = np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
                ends = np.append(np.flatnonzero(ids == self.between_id), len(ids))
            if len(ends) == len(lot):
                found.append(ids[ids != self.between_id])
                sizes.append(np.diff(ends, prepend=-1) - 1)
            else:
                each = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
                found += [np.asarray(x, np.int32) for x in each]
                sizes.append(np.fromiter(map(len, each), np.int64, len(each)))
        return np.concatenate(found), np.concatenate(sizes)


def _gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[start : start + length] of every pair, one after the other."""
    ends = np.cumsum(lengths)
    at = np.arange(ends[-1] if len(ends) else 0, dtype=np.int64)
    return flat[at + np.repeat(starts - (ends - lengths), lengths)]


def _pieces(path: str) -> "_Pieces":
    if path not in _memos:
        _memos[path] = _Pieces(path)
    return _memos[path]


def _bytes_of(values: pa.Array) -> list[bytes]:
    """to_pylist() of binary values without NULLs, by slices of their buffer."""
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].tolist()
    data = values.buffers()[2].to_pybytes() if len(values) else b""
    return [data[a:b] for a, b in zip(ends, ends[1:])]


def encode_texts(texts: pa.Array, path: str = TOKENIZER, memo_bytes: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of whole texts (UTF-8 bytes, none NULL) one after the other, and how many each text has.

    Different pieces of the texts are found first, so that only these are looked up or encoded.
    """
    if not len(texts):
        return np.empty(0, np.int32), np.empty(0, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    low, high = int(offsets[0]), int(offsets[-1])
    raw = texts.buffers()[2].slice(low, high - low).to_pybytes() if high > low else b""
    known = _pieces(path)
    pieces, at = known.cut(raw, offsets[:-1] - low)
    coded = pieces.dictionary_encode()
    ids, starts = known.encode(_bytes_of(coded.dictionary), MEMO_BYTES if memo_bytes is None else memo_bytes)
    own = coded.indices.to_numpy()
    lengths = np.diff(starts)[own]
    before = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(at, offsets - low)]
    return _gathered(ids, starts[own], lengths), np.diff(before)


def encode_text(text: str, path: str = TOKENIZER) -> bytes:
    """Ids of a whole text as little-endian unsigned 32-bit integers."""
    return encode_texts(pa.array([text.encode()], pa.binary()), path)[0].astype("<u4").tobytes()


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about SLICE bytes; a longer text is one of its own."""
    low, room = 0, 0
    for i, size in enumerate(sizes):
        if i > low and room + size > SLICE:
            yield low, i
            low, room = i, 0
        room += size
    if len(sizes) > low:
        yield low, len(sizes)


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID, memo_bytes: int | None = None
) -> None:
    """Encodes every text (NULL: empty), ends each document with end_id, and writes the files.

    memo_bytes: what a Python worker may remember of pieces, for workers that hold other operators' models as well.

    Repeated doc_ids are all written, ordered by checksum of the text; a NULL doc_id comes first.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        for whole in batches:
            sizes = np.diff(np.frombuffer(whole["text"].buffers()[1], np.int32)[whole["text"].offset :][: whole.num_rows + 1])
            for low, high in _slices(sizes):
                batch = whole.slice(low, high - low)
                ids, counts = encode_texts(batch["text"], tokenizer, memo_bytes)
                ends = np.cumsum(counts + 1)
                tokens = np.insert(ids, np.cumsum(counts), end_id)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(tokens))
                yield pa.record_batch(
                    [batch["doc_id"], pa.array(np.full(len(ends), part, np.int32)), pa.array(start + ends - counts - 1), pa.array(counts + 1), lists],
                    names=["doc_id", "part", "local_start", "n_tokens", "tokens"],
                )
                start += int(ends[-1])

    order = [F.asc_nulls_first("doc_id"), F.asc("_crc")]
    slim = docs.select(F.col("doc_id").cast("long"), "text", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("_crc"))
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    dealt = slim.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", text)
    dealt.mapInArrow(encode, FILE_SCHEMA).write.options(**WRITE_OPTIONS).parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and n_tokens, without touching the id column."""
    meta = spark.read.schema(FILE_SCHEMA).parquet(path).select("doc_id", "part", "local_start", "n_tokens")
    return meta.join(_part_starts(meta), "part").select("doc_id", (F.col("part_start") + F.col("local_start")).alias("start"), "n_tokens")


def _part_starts(files: DataFrame) -> DataFrame:
    """Ids before each range: one row per file meets in the window."""
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("part_start"))


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id and tokens; with doc_ids, a filter that skips row groups and pages by their statistics."""
    rows = spark.read.schema(FILE_SCHEMA).parquet(path).select("doc_id", "tokens")
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(doc_ids))


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned crc32 of the ids of every document, all from the files."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["tokens"]
            at = np.asarray(lists.offsets).astype(np.int64) * 4
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
            crcs = np.fromiter((zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:])), np.int64, len(lists))
            yield pa.record_batch(
                [batch["doc_id"], batch["part"], batch["local_start"], batch["n_tokens"], pa.array(crcs)],
                names=["doc_id", "part", "local_start", "n_tokens", "ids_crc32"],
            )

    summed = files.mapInArrow(digest, "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long")
    return summed.join(_part_starts(files.select("part", "n_tokens")), "part").select(
        "doc_id", (F.col("part_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )
