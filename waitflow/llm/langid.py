"""Language identification by unigram pieces, summed over all segmentations.

Every language has a probability for every piece of a fixed public vocabulary. The likelihood of a word is the sum
over all its segmentations into pieces, found by a forward pass; a text is the product of its words. Pieces do not
cross white space, so a word is scored once and remembered.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
SAMPLE = 2000  # labelled documents per language that the probabilities are learned from
SALTS = 256  # parts of a language that are sorted apart before the last cut
SMOOTHING = 0.05  # added to the count of every piece
FALLBACK = 1e-6  # probability of one byte of a character outside the vocabulary, alike in all languages
MEMO = 300_000
UNKNOWN = "und"
MARK = "▁"


@lru_cache(maxsize=2)
def pieces(path: str) -> tuple[dict[str, int], int]:
    """Text pieces of the vocabulary by id, and the longest one's length."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    found = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i))}
    return found, max(map(len, found))


def _trie(vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (node, character) keys of the pieces' prefixes, the node each leads to, and the piece it ends (or -1)."""
    nodes: dict[tuple[int, str], int] = {}
    piece = [-1]
    for text, i in vocabulary.items():
        at = 0
        for c in text:
            at = nodes.setdefault((at, c), len(piece))
            if at == len(piece):
                piece.append(-1)
        piece[at] = i
    keys = np.array([(at << 21) | ord(c) for at, c in nodes], np.int64)
    order = keys.argsort()
    to = np.fromiter(nodes.values(), np.int64, len(nodes))[order]
    return keys[order], to, np.array(piece, np.int64)[to]


def forward(words: list[str], table: np.ndarray, vocabulary: dict[str, int], longest: int, trie: tuple | None = None) -> np.ndarray:
    """Natural log likelihood per word and language. table: rows by piece id, the last rows for fallbacks."""
    trie = trie or _trie(vocabulary)
    out = np.empty((len(words), table.shape[1]))
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    at = 0
    while at < len(order):
        n = at
        while n < len(order) and (n == at or (n - at + 1) * (len(words[order[n]]) + 2) <= 400_000):
            n += 1
        out[order[at:n]] = _forward([MARK + words[i] for i in order[at:n]], table, len(vocabulary) + 1000, longest, trie)
        at = n
    return out


def _forward(words: list[str], table: np.ndarray, fallback: int, longest: int, trie: tuple) -> np.ndarray:
    """Of words in the order of their lengths. Every place hands its sum on along the pieces that start there."""
    keys, to, ends = trie
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    top_length = int(lengths.max())
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    own = np.repeat(np.arange(len(words)), lengths)
    chars = np.full((top_length + longest, len(words)), -1, np.int64)
    chars[np.arange(len(flat)) - (np.cumsum(lengths) - lengths)[own], own] = flat
    alpha = np.zeros((top_length + longest + 1, len(words), table.shape[1]))
    alpha[0] = 1.0
    scale = np.zeros(len(words))
    live_from = np.searchsorted(lengths, np.arange(top_length), side="right")
    for i in range(top_length):
        w = np.arange(live_from[i], len(words))
        if i and i % 8 == 0:  # keeps long words above the smallest double
            top = alpha[i, w].max(axis=1)
            low = ((top > 0) & (top < 1e-60)).nonzero()[0]
            if len(low):
                alpha[i : i + longest, w[low]] /= top[low][None, :, None]
                scale[w[low]] += np.log(top[low])
        node = np.zeros(len(w), np.int64)
        for step in range(longest):
            c = chars[i + step, w]
            k = np.searchsorted(keys, (node << 21) | c)
            k[k == len(keys)] = 0
            known = (keys[k] == (node << 21) | c) & (c >= 0)
            piece = np.where(known, ends[k], -1)
            if step == 0:  # a character that is no piece costs its bytes
                size = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
                piece = np.where(piece < 0, fallback + size, piece)
            hit = (piece >= 0).nonzero()[0]
            alpha[i + step + 1, w[hit]] += alpha[i, w[hit]] * table[piece[hit]]
            w, node = w[known], to[k[known]]
            if not len(w):
                break
    with np.errstate(divide="ignore"):
        return np.log(np.maximum(alpha[lengths, np.arange(len(words))], 1e-300)) + scale[:, None]


class _Scores:
    """Remembered word scores of one Python worker; emptied when full."""

    def __init__(self, table: np.ndarray, path: str):
        self.table = table
        self.vocabulary, self.longest = pieces(path)
        self.trie = _trie(self.vocabulary)
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.values = np.empty((0, self.table.shape[1]))

    def texts(self, texts: list[str]) -> np.ndarray:
        split = [t.split() for t in texts]
        if len(self.rows) > MEMO:
            self.clear()
        new = list({w for words in split for w in words if w not in self.rows})
        if new:
            self.values = np.concatenate([self.values, forward(new, self.table, self.vocabulary, self.longest, self.trie)])
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
        sizes = np.array([len(words) for words in split])
        at = np.fromiter(map(self.rows.__getitem__, chain.from_iterable(split)), np.int64, sizes.sum())
        out = np.zeros((len(texts), self.table.shape[1]))
        some = sizes > 0
        if len(at):
            out[some] = np.add.reduceat(self.values[at], (np.cumsum(sizes) - sizes)[some], axis=0)
        return out


def held_out(doc_id: Column, modulus: int = 4) -> Column:
    """Documents that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == 2, F.lit(False))


def learn(docs: DataFrame, path: str = VOCABULARY, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the probability of every piece in each.

    Pieces are counted over the `sample` labelled documents of each language with the smallest hash of doc_id (all
    of them where there are fewer). Counts come back as one row per language and piece of the vocabulary.
    """
    labelled = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # A language is first cut in SALTS parts, so that the last sort has at most SALTS * sample rows of it.
    chosen = labelled.select("lang", "doc_id", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SALTS)).alias("_salt"))
    for part in (["lang", "_salt"], ["lang"]):
        nth = F.row_number().over(Window.partitionBy(*part).orderBy(F.xxhash64("doc_id"), "doc_id"))
        chosen = chosen.withColumn("_nth", nth).filter(F.col("_nth") <= sample).drop("_nth")
    chosen = chosen.select("lang", "doc_id").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                own = sums.setdefault(lang, np.zeros(sp.get_piece_size(), np.int64))
                ids = sp.encode(" ".join(text.split()))
                own += np.bincount(ids, minlength=len(own)) if ids else 0
        for lang, own in sums.items():
            at = own.nonzero()[0]
            yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(own[at])], names=["lang", "piece", "n"])

    picked = labelled.select("lang", "doc_id", "text").join(chosen, ["lang", "doc_id"], "left_semi").select("lang", "text")
    counts = picked.mapInArrow(count, "lang string, piece long, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    got = counts.toArrow()  # at most languages x vocabulary
    langs = sorted(set(got["lang"].to_pylist()))
    vocabulary, _ = pieces(path)
    own_ids = np.fromiter(vocabulary.values(), np.int64)
    table = np.zeros((len(vocabulary) + 1005, len(langs)))
    if langs:
        where = {x: i for i, x in enumerate(langs)}
        np.add.at(table, (got["piece"].to_numpy(), [where[x] for x in got["lang"].to_pylist()]), got["n"].to_numpy())
        known = np.zeros(len(table), bool)
        known[own_ids] = True
        table[~known] = 0
        table[own_ids] += SMOOTHING
        table /= table.sum(axis=0)
        for n in range(1, 5):
            table[len(vocabulary) + 1000 + n] = FALLBACK**n
    return langs, table


def predict(docs: DataFrame, langs: list[str], table: np.ndarray, path: str = VOCABULARY) -> DataFrame:
    """doc_id, held_out, lang_pred, score: the most probable language and its share of the likelihood.

    `und` with score 0 for a NULL text, one without a letter, and when no language was learned; ties go to the
    language first in order. Texts of any length are scored whole; repeated rows are all returned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table)  # vocabulary x languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _worker_scores(shared, path)
        for batch in batches:
            texts = batch["text"].to_pylist()
            names, values = [UNKNOWN] * len(texts), np.zeros(len(texts))
            real = [i for i, t in enumerate(texts) if langs and t and any(map(str.isalpha, t))]
            for a in range(0, len(real), 128):
                part = real[a : a + 128]
                logs = scores.texts([texts[i] for i in part])
                best = logs.argmax(axis=1)
                share = 1 / np.exp(np.minimum(logs - logs.max(axis=1, keepdims=True), 0)).sum(axis=1)
                for i, k, s in zip(part, best, share):
                    names[i], values[i] = langs[k], s
            yield pa.record_batch(
                [batch["doc_id"], batch["held_out"], pa.array(names, pa.string()), pa.array(values)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    slim = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return slim.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


_worker: dict = {}


def _worker_scores(shared, path: str) -> _Scores:
    """Kept over the tasks of a worker as long as the model is the same."""
    table = shared.value
    if _worker.get("table") is not table:
        _worker.update(table=table, scores=_Scores(table, path))
    return _worker["scores"]


def identify(docs: DataFrame, path: str = VOCABULARY, sample: int = SAMPLE) -> DataFrame:
    """predict() with what learn() finds in the same documents."""
    langs, table = learn(docs, path, sample)
    return predict(docs, langs, table, path)
