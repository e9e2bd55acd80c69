"""Audit of how far the sources of a language differ in the terms they use.

Terms held by enough documents of a language are sorted and built into minimal acyclic transducers, whose ordinals
number a language's terms in lexicographic order. All texts are then streamed through them to count the kept terms
by source, and ordinals stand for terms in every later step, ties included.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitflow.llm.store import stored
from waitflow.llm.transducer import TERM_BYTES, Builder, Transducer, term_spans

MIN_DOCS = 30
TOP = 50
SCALE, PRIOR = 1_000_000_000, 5

PART_TERMS = 400_000  # kept terms of one transducer
PASS_BYTES = 128 << 20  # transducers that are sent out for one reading of the texts
MEMO = 400_000  # terms or counts that a task gathers before it hands them on
BLOCK = 4096  # ordinals of a block of the comparison
SLICE = 4 << 20  # bytes of text that are read in lockstep


def _texts(docs: DataFrame) -> DataFrame:
    blank = F.lit("")
    return docs.select(*[F.coalesce(F.col(c), blank).alias(c) for c in ("lang", "source")], F.coalesce("text", blank).cast("binary").alias("text"))


def document_counts(docs: DataFrame) -> DataFrame:
    """lang, term and n_docs: documents (rows) of the language that hold the term. Tasks hand on sums of MEMO terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, Counter] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, found in sums.items():
                if found:
                    terms = pa.array(list(found), pa.binary())
                    yield pa.record_batch([pa.array([lang] * len(found), pa.string()), terms, pa.array(list(found.values()), pa.int64())], names=["lang", "term", "n"])

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                found = sums.setdefault(lang, Counter())
                found.update(set(text.as_buffer().to_pybytes().translate(TERM_BYTES).split()))
                if len(found) > MEMO:
                    yield from rows()
                    sums.clear()
        yield from rows()

    counted = _texts(docs).select("lang", "text").mapInArrow(count, "lang string, term binary, n long")
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n_docs"))


def vocabulary(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, term (bytes), ordinal and place of the kept terms; place numbers all of them by language and term.

    The order comes from sorted ranges and the sums of what lies before each range, so no task holds all terms.
    """
    kept = document_counts(docs).filter(F.col("n_docs") >= min_docs).select("lang", "term")
    ranges = stored(
        kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term").withColumn("_id", F.monotonically_increasing_id()), "terms"
    )
    row, part = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)), F.shiftright("_id", 33)
    ranges = ranges.select("lang", "term", part.alias("_range"), row.alias("_row"))
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # one row a range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = ranges.join(starts, "_range").select("lang", "term", (F.col("_start") + F.col("_row")).alias("place"))
    firsts = placed.groupBy("lang").agg(F.min("place").alias("_first"))
    return placed.join(firsts, "lang").select("lang", "term", "place", (F.col("place") - F.col("_first")).alias("ordinal"))


def transducers(terms: DataFrame, part_terms: int = PART_TERMS) -> DataFrame:
    """part, firsts (the first ordinal of each language in the part) and payload, for runs of part_terms places."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        langs, words = table["lang"].to_pylist(), table["term"].to_pylist()
        ordinals, builder, firsts, at = table["ordinal"].to_pylist(), Builder(), {}, 0
        while at < len(langs):
            end = at
            while end < len(langs) and langs[end] == langs[at]:
                end += 1
            builder.add_root(langs[at], words[at:end])
            firsts[langs[at]] = ordinals[at]
            at = end
        part = table["place"][0].as_py() // part_terms
        kind = pa.map_(pa.string(), pa.int64())
        return pa.table({"part": [part], "firsts": pa.array([list(firsts.items())], kind), "payload": pa.array([builder.dump()], pa.binary())})

    parts = terms.withColumn("_part", F.floor(F.col("place") / part_terms))
    return parts.groupBy("_part").applyInArrow(build, "part long, firsts map<string,long>, payload binary")


def recount(docs: DataFrame, parts: DataFrame, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """lang, source, ordinal and n (occurrences, above 0) of the kept terms in all texts.

    Transducers of up to pass_bytes are sent out at a time (one always is); what is beyond takes further readings of
    the texts.
    """
    sizes = sorted((r.part, r.size) for r in parts.select("part", F.octet_length("payload").alias("size")).collect())
    passes: list[list[int]] = []
    room = 0
    for part, size in sizes:
        if size > room or not passes:
            passes.append([])
            room = pass_bytes
        passes[-1].append(part)
        room -= size
    spark = docs.sparkSession
    counted = [spark.createDataFrame([], "lang string, source string, ordinal long, n long")]
    for chosen in passes:
        rows = parts.filter(F.col("part").between(chosen[0], chosen[-1])).collect()
        counted.append(_recount(docs, spark.sparkContext.broadcast([(r.firsts, bytes(r.payload)) for r in rows])))
    together = counted[0]
    for more in counted[1:]:
        together = together.unionByName(more)
    return together.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


_worker: dict = {}


def _loaded(shared) -> list[tuple[dict[str, int], Transducer]]:
    """Transducers are unpacked once a worker."""
    if _worker.get("shared") is not shared.value:
        _worker.update(shared=shared.value, read=[(firsts, Transducer(p)) for firsts, p in shared.value])
    return _worker["read"]


class _Sums:
    """Counts by (group, ordinal) key, as sorted arrays that are merged when they have grown enough."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.merged = 0

    def add(self, keys: np.ndarray) -> None:
        self.parts.append(np.unique(keys, return_counts=True))
        self.size += len(self.parts[-1][0])
        if self.size > 2 * self.merged + MEMO:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) > 1:
            keys, at = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
            self.parts = [(keys, np.bincount(at, np.concatenate([n for _, n in self.parts])).astype(np.int64))]
        self.size = self.merged = len(self.parts[0][0]) if self.parts else 0
        return self.parts[0] if self.parts else (np.empty(0, np.int64), np.empty(0, np.int64))

    def rows(self) -> pa.RecordBatch:
        keys, counts = self.merge()
        langs, sources = zip(*self.groups) if self.groups else ((), ())
        group = pa.array((keys >> 40).astype(np.int32))
        named = [pa.DictionaryArray.from_arrays(group, pa.array(list(x), pa.string())).cast(pa.string()) for x in (langs, sources)]
        batch = pa.record_batch([*named, pa.array(keys & ((1 << 40) - 1)), pa.array(counts, pa.int64())], names=["lang", "source", "ordinal", "n"])
        self.__init__()
        return batch


def _slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about SLICE bytes that end where a text or a term does."""
    low = 0
    while low < len(data):
        high = min(low + SLICE, len(data))
        while high < len(data):
            blank = np.flatnonzero(np.frombuffer(data[high : high + SLICE].tobytes().translate(TERM_BYTES), np.uint8) == 0x20)
            if len(blank):
                high += int(blank[0])
                break
            high = min(high + SLICE, len(data))
        yield low, high
        low = high


def _recount(docs: DataFrame, shared) -> DataFrame:
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded, sums = _loaded(shared), _Sums()
        for batch in batches:
            text = batch["text"]
            offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
            if not len(text) or offsets[0] == offsets[-1]:
                continue
            data = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
            offsets -= offsets[0]
            langs = batch["lang"].to_pylist()
            groups = np.array([sums.groups.setdefault(g, len(sums.groups)) for g in zip(langs, batch["source"].to_pylist())], np.int64)
            roots = [(np.array([t.roots.get(g, -1) for g in langs]), np.array([firsts.get(g, 0) for g in langs]), t) for firsts, t in loaded]
            for low, high in _slices(data, offsets):
                inside = offsets[(offsets >= low) & (offsets < high)] - low
                starts, lengths = term_spans(data[low:high], inside)
                doc = np.searchsorted(offsets, starts + low, side="right") - 1
                for root, first, transducer in roots:
                    found = transducer.ordinals(data[low:high], starts, lengths, root[doc])
                    hit = np.flatnonzero(found >= 0)
                    if len(hit):
                        sums.add((groups[doc[hit]] << 40) | (found[hit] + first[doc[hit]]))
            if sums.merged > 4 * MEMO or len(sums.groups) > MEMO:
                yield sums.rows()
        yield sums.rows()

    return _texts(docs).mapInArrow(stream, "lang string, source string, ordinal long, n long")


def _share(count: Column, whole: Column) -> Column:
    """1 + floor(SCALE * count / whole) for 0 <= count <= whole, in steps of a thousand so that no product overflows."""
    digits, rest = F.lit(0).cast("long"), count
    for _ in range(3):
        rest = rest * 1000
        digits, rest = digits * 1000 + F.call_function("div", rest, whole), rest % whole
    return F.when(count == whole, F.lit(SCALE).cast("long")).otherwise(digits) + 1


def _shares(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    digits, rest = np.zeros_like(counts), counts
    for _ in range(3):
        rest = rest * 1000
        digits, rest = digits * 1000 + rest // whole, rest % whole
    return np.where(counts == whole, SCALE, digits) + 1


def _pairs(block: pa.Table) -> pa.Table:
    """Sums of differences over one block of ordinals, for all ordered pairs of sources of a language."""
    sources, whole, width = block["source"].to_pylist(), block["whole"].to_numpy()[:, None], block["width"][0].as_py()
    counts = np.zeros((len(sources), width), np.int64)
    for i, cells in enumerate(block["cells"].to_pylist()):
        for cell in cells or ():
            counts[i, cell["o"]] = cell["n"]
    shares = _shares(counts + PRIOR, whole) if width else counts
    own, other, value = [], [], []
    for i, source in enumerate(sources):
        gaps = np.abs(shares - shares[i]).sum(axis=1)
        own += [source] * (len(sources) - 1)
        other += sources[:i] + sources[i + 1 :]
        value += np.delete(gaps, i).tolist()
    lang = pa.array([block["lang"][0].as_py()] * len(own), pa.string())
    return pa.table({"lang": lang, "source": pa.array(own, pa.string()), "item": pa.array(other, pa.string()), "value": pa.array(value, pa.int64())})


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank: see the module's head and README.

    `pair` ranks the other sources of the language by the summed differences of their shares, `term` the terms that a
    source uses more than its language does, up to `top` of them. NULL text, lang and source are empty strings; a
    group without terms, and a language without kept terms, has its shares from the prior alone (or 0 over no terms);
    a language with one source has no pairs; repeated rows all count; texts of any length are read whole; an empty
    table gives no rows. Ties go to the item that comes first in byte order. Only text, lang and source are read.
    """
    terms = stored(vocabulary(docs, min_docs), "vocabulary")
    counts = stored(recount(docs, stored(transducers(terms), "transducers")), "recount")
    groups = _texts(docs).select("lang", "source").distinct()
    kept = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    groups = stored(
        groups.join(kept, "lang", "left").join(sums, ["lang", "source"], "left")
        .select("lang", "source", F.coalesce("v", zero).alias("v"), F.coalesce("total", zero).alias("total")),
        "groups",
    )
    return _pair_part(counts, groups).unionByName(_term_part(counts, groups, terms, top))


def _ranked(df: DataFrame, order: list[Column], part: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))
    return df.withColumns({"part": F.lit(part), "rank": rank})


def _pair_part(counts: DataFrame, groups: DataFrame) -> DataFrame:
    last = F.greatest(F.floor((F.col("v") - 1) / BLOCK), F.lit(0))
    whole = F.col("total") + PRIOR * F.col("v")
    width = F.least(F.col("v") - F.col("block") * BLOCK, F.lit(BLOCK))
    blocks = groups.select("lang", "source", whole.alias("whole"), "v", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    cell = F.struct((F.col("ordinal") % BLOCK).alias("o"), "n")
    cells = counts.groupBy("lang", "source", F.floor(F.col("ordinal") / BLOCK).alias("block")).agg(F.collect_list(cell).alias("cells"))
    rows = blocks.withColumn("width", width).join(cells, ["lang", "source", "block"], "left")
    sums = rows.groupBy("lang", "block").applyInArrow(_pairs, "lang string, source string, item string, value long")
    summed = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return _ranked(summed, [F.desc("value"), F.asc("item")], "pair").select("lang", "source", "part", "item", "value", "rank")


def _term_part(counts: DataFrame, groups: DataFrame, terms: DataFrame, top: int) -> DataFrame:
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    sized = groups.join(langs, "lang").select("lang", "source", "v", "total", "lang_total")
    both = counts.withColumn("lang_n", F.sum("n").over(Window.partitionBy("lang", "ordinal"))).join(sized, ["lang", "source"])
    prior = PRIOR * F.col("v")
    p, q = _share(F.col("n") + PRIOR, F.col("total") + prior), _share(F.col("lang_n") + PRIOR, F.col("lang_total") + prior)
    over = both.select("lang", "source", "ordinal", (p - q).alias("value")).filter("value > 0")
    first = _ranked(over, [F.desc("value"), F.asc("ordinal")], "term").filter(F.col("rank") <= top)
    named = terms.select("lang", "ordinal", F.col("term").cast("string").alias("item"))
    return first.join(named, ["lang", "ordinal"]).select("lang", "source", "part", "item", "value", "rank")


def audit_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    terms = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
    p = "(1 + ({0}::HUGEINT + %d) * %d // ({1}::HUGEINT + %d * v))" % (PRIOR, SCALE, PRIOR)
    return f"""
        WITH docs AS (SELECT COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
                             regexp_extract_all(translate(COALESCE(text, ''), '{upper}', '{lower}'), '{terms}') AS words FROM documents),
        kept AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(words)) AS term FROM docs)
                 GROUP BY lang, term HAVING COUNT(*) >= {MIN_DOCS}),
        sizes AS (SELECT lang, COUNT(*) AS v FROM kept GROUP BY lang),
        found AS (SELECT lang, source, term, COUNT(*) AS n FROM (SELECT lang, source, unnest(words) AS term FROM docs)
                  JOIN kept USING (lang, term) GROUP BY lang, source, term),
        totals AS (SELECT lang, source, SUM(n) AS total FROM found GROUP BY lang, source),
        groups AS (SELECT g.lang, g.source, COALESCE(v, 0) AS v, COALESCE(total, 0) AS total
                   FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN sizes USING (lang) LEFT JOIN totals USING (lang, source)),
        shares AS (SELECT g.lang, g.source, k.term, COALESCE(n, 0) AS n, {p.format('COALESCE(n, 0)', 'total')} AS p
                   FROM groups g JOIN kept k USING (lang) LEFT JOIN found USING (lang, source, term)),
        whole AS (SELECT lang, term, {p.format('SUM(n)', 'MAX(lang_total)').replace('* v', '* MAX(v)')} AS q
                  FROM found JOIN (SELECT lang, SUM(total) AS lang_total, MAX(v) AS v FROM groups GROUP BY lang) USING (lang) GROUP BY lang, term),
        gaps AS (SELECT a.lang, a.source, b.source AS item, SUM(abs(a.p - b.p)) AS value
                 FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        parts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, COALESCE(value, 0) AS value
                  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
                       LEFT JOIN gaps g ON g.lang = a.lang AND g.source = a.source AND g.item = b.source
                  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR rank <= {TOP}"""
