"""Toxicity by two Kneser-Ney models of letters, one of toxic and one of ordinary texts.

A text is read as letters, everything else being a blank. Each class has its own counts of ORDER letters; shorter
contexts are shared: their continuation counts come from both classes, so that an expression which one class has
rarely or never seen is smoothed alike in both. A text's evidence is the difference of its two log-likelihoods by
letter, over the whole text and over its most toxic WINDOW letters; a logistic curve over both gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitflow.llm.probing import Places
from waitflow.llm.store import stored

ORDER, WINDOW = 5, 8
DISCOUNT = 0.75
SAMPLE = 20_000  # labelled documents of a class that are learned from (about: chosen by hash of doc_id)
MODEL_GRAMS = 1_000_000  # most letter groups of a model; the rarest go first
FOLDS, HELD_OUT, TUNING = 5, 0, 1  # of crc32(doc_id): never learned from; kept for the logistic curve
SLICE = 1 << 20  # characters that are read at once
MIN_TUNING = 20  # documents of the smaller class that a curve is fitted on
CURVE = np.array([-6.0, 4.5, 0.0, 0.0])  # the curve where there are fewer

BITS = 10  # of a letter's number; higher code points share numbers by hash
_MASK = (1 << BITS) - 1
_LETTER = np.array([chr(i).isalpha() for i in range(0x110000)])
_PAD = "\x00" * WINDOW


def _symbols(text: str, after_letter: bool) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a text's letters, a run of anything else being one blank, and which of them are NUL characters."""
    codes = np.frombuffer(text.casefold().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter, pad = _LETTER[codes], codes == 0
    keep = letter | pad
    keep[1:] |= letter[:-1]
    if len(keep) and after_letter:
        keep[0] = True
    codes = np.where(letter, codes, 32)[keep].astype(np.int64)
    high = codes > _MASK
    codes[high] = (codes[high] * 2654435761 >> 7) & _MASK
    return codes, pad[keep]


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts, each text led by WINDOW blanks, and where these begin."""
    codes, pads = _symbols("".join(_PAD + t.replace("\x00", " ") for t in texts), False)
    return codes, np.flatnonzero(pads)[::WINDOW]


def _lots(texts: list[str]) -> Iterator[list[int]]:
    """Places of the texts of up to SLICE characters, in lots of about that size."""
    lot, size = [], 0
    for i, text in enumerate(texts):
        if len(text) <= SLICE:
            lot.append(i)
            size += len(text) + WINDOW
            if size >= SLICE:
                yield lot
                lot, size = [], 0
    if lot:
        yield lot


def _stream(text: str) -> Iterator[np.ndarray]:
    """Symbols of a long text slice by slice, each led by the WINDOW symbols before it (blanks at first)."""
    tail = np.full(WINDOW, 32, np.int64)
    for low in range(0, len(text), SLICE):
        codes, _ = _symbols(text[low : low + SLICE].replace("\x00", " "), bool(tail[-1] != 32))
        out = np.concatenate([tail, codes])
        yield out
        tail = out[-WINDOW:]


def groups(codes: np.ndarray) -> np.ndarray:
    """The ORDER letters that end at each place from the ORDER-th on, as one number."""
    out = codes[: len(codes) - ORDER + 1].copy()
    for i in range(1, ORDER):
        out = (out << BITS) | codes[i : len(codes) - ORDER + 1 + i]
    return out


@dataclass
class Model:
    """Known groups with their log ratio, and what the ratio of any other group is computed from."""

    keys: np.ndarray  # groups of ORDER letters
    counts: np.ndarray  # of ordinary and toxic texts

    def __post_init__(self) -> None:
        self.classes = [_discounted(self.keys, self.counts[:, c]) for c in (0, 1)]
        self.shared, keys = [], self.keys
        for order in range(ORDER - 1, 0, -1):
            keys, continuations = np.unique(keys & ((1 << BITS * order) - 1), return_counts=True)
            self.shared.insert(0, (Places(keys), *_discounted(keys, continuations)))
        self.places = Places(self.keys)
        self.ratios = self._ratios(self.keys, np.arange(len(self.keys)))

    def _ratios(self, asked: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log P(toxic) - log P(ordinary) of the last letter after the others; at: place of the group, or -1.

        Rounded to a binary fraction, so that sums of them are exact and do not hang on how texts are dealt.
        """
        p = np.full(len(asked), 1.0 / (_MASK + 1))
        for order, (places, own, contexts, left) in enumerate(self.shared, 1):
            part = asked & ((1 << BITS * order) - 1)
            p = _interpolated(p, places.find(part), contexts.find(part >> BITS), own, left)
        logs = [np.log(_interpolated(p, at, contexts.find(asked >> BITS), own, left)) for own, contexts, left in self.classes]
        return np.round((logs[1] - logs[0]) * (1 << 20)) / (1 << 20)

    def ratio(self, asked: np.ndarray) -> np.ndarray:
        at = self.places.find(asked)
        known = at >= 0
        out = np.zeros(len(asked))
        out[known] = self.ratios[at[known]]
        if not known.all():
            new, back = np.unique(asked[~known], return_inverse=True)
            out[~known] = self._ratios(new, np.full(len(new), -1))[back]
        return out

    def evidence(self, texts: list[str]) -> np.ndarray:
        """Per text: mean ratio by letter, highest mean over WINDOW letters (0 beyond the text's ends), letters."""
        total, best, size = np.zeros(len(texts)), np.zeros(len(texts)), np.zeros(len(texts))
        for lot in _lots(texts):
            codes, starts = letters([texts[i] for i in lot])
            ratio = np.zeros(len(codes) + WINDOW)
            ratio[ORDER - 1 : len(codes)] = self.ratio(groups(codes))
            ratio[_blanks(starts)] = 0.0
            total[lot] = np.add.reduceat(ratio, starts)
            best[lot] = np.maximum.reduceat(_windows(ratio), starts)
            size[lot] = np.diff(np.append(starts, len(codes))) - WINDOW
        for i, text in enumerate(texts):
            if len(text) > SLICE:
                total[i], best[i], size[i] = self._long_evidence(text)
        return np.stack([total / np.maximum(size, 1), np.where(size > 0, best, 0.0), size], axis=1)

    def _long_evidence(self, text: str) -> tuple[float, float, int]:
        total, best, size, tail = 0.0, -np.inf, 0, np.zeros(WINDOW)
        for codes in _stream(text):
            ratio = np.concatenate([tail, self.ratio(groups(codes))[WINDOW - ORDER + 1 :]])
            new = len(codes) - WINDOW
            total, size = total + ratio[WINDOW:].sum(), size + new
            best = max(best, _windows(ratio).max()) if new else best
            tail = ratio[-WINDOW:]
        return total, max(best, _windows(np.concatenate([tail, np.zeros(WINDOW)])).max()), size


def _blanks(starts: np.ndarray) -> np.ndarray:
    return (starts[:, None] + np.arange(WINDOW)).ravel()


def _windows(ratio: np.ndarray) -> np.ndarray:
    """Mean of the WINDOW values from each place on."""
    most = len(ratio) - WINDOW
    return sum((ratio[i : most + i] for i in range(1, WINDOW)), ratio[:most]) / WINDOW


def _discounted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, Places, np.ndarray]:
    """Discounted share of every key after its context, the contexts, and the share that each leaves to its backoff."""
    contexts, at = np.unique(keys >> BITS, return_inverse=True)
    whole = np.maximum(np.bincount(at, counts, len(contexts)), 1e-9)
    kinds = np.bincount(at, counts > 0, len(contexts))
    left = np.where(kinds > 0, DISCOUNT * kinds / whole, 1.0)
    return np.where(counts > 0, (counts - DISCOUNT) / whole[at], 0.0), Places(contexts), left


def _interpolated(p: np.ndarray, at: np.ndarray, context: np.ndarray, own: np.ndarray, left: np.ndarray) -> np.ndarray:
    seen = np.where(at >= 0, own[at], 0.0) if len(own) else 0.0
    return seen + (np.where(context >= 0, left[context], 1.0) if len(left) else 1.0) * p


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text by FOLDS; a NULL id is in no fold and is never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text, toxic and tuning (boolean) of about `sample` labelled documents a class, chosen by hash of their id.

    An id with both labels is a toxic one. Only the chosen ids, of which there are at most about twice `sample`,
    are sent to the documents; a sample over the bound by more than six standard deviations is an error.
    """
    own = F.col("doc_id").cast("long")
    marked = labels.filter(F.col("toxic").isNotNull() & own.isNotNull() & (fold(own) != HELD_OUT))
    marked = marked.select(own.alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("toxic IN (0, 1)")
    marked = stored(marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labels")
    sizes = {r.toxic: r.n for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    spread = 1 << 40
    limits = F.when(F.col("toxic") == 1, _limit(sizes.get(1, 0), sample, spread)).otherwise(_limit(sizes.get(0, 0), sample, spread))
    chosen = stored(marked.filter(F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(spread)) < limits), "chosen")
    if chosen.count() > 2 * sample + 6 * (2 * sample) ** 0.5:
        raise ValueError("the sample of labelled documents is larger than its bound")
    texts = docs.filter(F.col("text").isNotNull()).select(own.alias("doc_id"), "text")
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic", (fold(F.col("doc_id")) == TUNING).alias("tuning"))


def _limit(size: int, sample: int, spread: int) -> Column:
    return F.lit(spread if size <= sample else spread * sample // size).cast("long")


def count_groups(texts: DataFrame) -> DataFrame:
    """g, ordinary and toxic: how often each group of letters stands in the texts of either class."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(found: np.ndarray, label: int) -> pa.RecordBatch:
            keys, n = np.unique(found, return_counts=True)
            none = np.zeros_like(n)
            return pa.record_batch([pa.array(keys), pa.array(none if label else n), pa.array(n if label else none)], names=["g", "ordinary", "toxic"])

        for batch in batches:
            labels, texts = batch["toxic"].to_pylist(), batch["text"].to_pylist()
            for lot in _lots(texts):
                for label in (0, 1):
                    own = [texts[i] for i in lot if labels[i] == label]
                    if own:
                        codes, starts = letters(own)
                        real = np.ones(len(codes), bool)
                        real[_blanks(starts)] = False
                        yield rows(groups(codes)[real[ORDER - 1 :]], label)
            for label, text in zip(labels, texts):
                if len(text) > SLICE:
                    for codes in _stream(text):
                        yield rows(groups(codes)[WINDOW - ORDER + 1 :], label)

    counted = texts.select("text", "toxic").mapInArrow(count, "g long, ordinary long, toxic long")
    return counted.groupBy("g").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def learn(sample: DataFrame, most: int = MODEL_GRAMS) -> Model:
    """Both models from the texts that are not for tuning. Groups below the smallest count that leaves at most `most`
    of them are dropped, so what comes to the driver has a fixed size."""
    counts = stored(count_groups(sample.filter("NOT tuning")), "letters")
    both = F.col("ordinary") + F.col("toxic")
    by_count = counts.groupBy(F.least(both, F.lit(1000)).alias("c")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("c")).collect()
    cutoff, kept = 1001, 0
    for row in by_count:
        kept += row.n
        if kept > most:
            break
        cutoff = row.c
    table = counts.filter(both >= cutoff).toArrow().sort_by("g")
    return Model(table["g"].to_numpy(), np.stack([table["ordinary"].to_numpy(), table["toxic"].to_numpy()], axis=1).reshape(-1, 2))


def _features(evidence: np.ndarray) -> np.ndarray:
    mean, best, size = evidence.T
    return np.stack([np.ones(len(mean)), best, mean, np.log1p(size) / 10], axis=1)


def fit_curve(evidence: np.ndarray, toxic: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic weights by Newton's method."""
    x, weights = _features(evidence), CURVE.copy()
    if min(toxic.sum(), len(toxic) - toxic.sum()) < MIN_TUNING:
        return weights
    for _ in range(50):
        p = _curve(x, weights)
        gradient = x.T @ (toxic - p) - ridge * (weights - CURVE)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1]), gradient)
        weights = weights + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return weights


def _curve(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights, -500, 500)))


_worker: dict = {}


def _model(shared) -> Model:
    """Built once a Python worker."""
    if _worker.get("shared") is not shared.value:
        _worker.update(shared=shared.value, model=Model(*shared.value))
    return _worker["model"]


def _evidence(df: DataFrame, shared, kept: list[str], schema: str) -> DataFrame:
    """The columns named by `kept`, then mean_ratio, top_ratio and n_letters of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared)
        for batch in batches:
            found = model.evidence([t or "" for t in batch["text"].to_pylist()])
            columns = [pa.array(np.ascontiguousarray(found[:, i])) for i in (0, 1)] + [pa.array(found[:, 2].astype(np.int64))]
            yield pa.record_batch([batch[c] for c in kept] + columns, names=[*kept, "mean_ratio", "top_ratio", "n_letters"])

    return df.select(*kept, "text").mapInArrow(run, f"{schema}, mean_ratio double, top_ratio double, n_letters long")


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted, mean_ratio, top_ratio and n_letters for every row of docs.

    Learns from labelled documents outside the held-out fold; labels, lang, source and doc_id are no inputs of a
    score. NULL texts are empty; an empty text, or one without letters, has ratios of 0 and the score of the curve
    there. Without toxic documents to learn from every score is 0, without ordinary ones 1. A NULL doc_id is not
    held out and not learned from; repeated rows are all scored and repeated documents learned from as often as they
    stand there; texts of any length are read whole; an empty table gives no rows.
    """
    chosen = stored(training_sample(docs, labels, sample), "toxicity")
    model = learn(chosen)
    held_out = F.coalesce(fold(F.col("doc_id").cast("long")) == HELD_OUT, F.lit(False))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    shared = docs.sparkSession.sparkContext.broadcast((model.keys, model.counts))  # at most MODEL_GRAMS rows
    found = _evidence(slim, shared, ["doc_id", "held_out"], "doc_id long, held_out boolean")
    seen = model.counts.sum(axis=0) if len(model.keys) else np.zeros(2)
    if not seen.all():
        value = F.lit(1.0 if seen[1] else 0.0)
    else:
        tuning = _evidence(chosen.filter("tuning"), shared, ["doc_id", "toxic"], "doc_id long, toxic int")
        one = tuning.groupBy("doc_id").agg(*[F.max(c).alias(c) for c in ("toxic", "mean_ratio", "top_ratio", "n_letters")])
        rows = one.toPandas().sort_values("doc_id")  # about twice the sample's fifth
        weights = fit_curve(rows[["mean_ratio", "top_ratio", "n_letters"]].to_numpy(float), rows["toxic"].to_numpy(float))
        terms = [F.lit(1.0), F.col("top_ratio"), F.col("mean_ratio"), F.log1p("n_letters") / 10]
        value = sum((F.lit(float(w)) * t for w, t in zip(weights[1:], terms[1:])), F.lit(float(weights[0])))
        value = 1 / (1 + F.exp(-value))
    predicted = (F.col("score") >= 0.5).cast("int")
    return found.withColumn("score", value).withColumn("predicted", predicted)
