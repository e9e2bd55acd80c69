"""Fill-in-the-middle: texts cut at two code points and put back in the order prefix, suffix, middle.

The code point boundaries of a text are byte offsets of its UTF-8 form, kept as a set of containers: each covers
65,536 offsets and is an array, a bitmap or a list of runs, whichever is smallest. The k-th boundary is found by a
search over the cumulative cardinalities of the containers and a select inside one of them, so a cut costs no walk
over the text, and the text itself is never decoded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1:"
PLAIN, SPM, PSM = "plain", "spm", "psm"
FIM_PERCENT, SPM_PERCENT = 90, 20

CHUNK = 1 << 16  # offsets of a container
ARRAY_MOST = 4096  # members up to which an array is smaller than the bitmap


class ArrayContainer:
    """Sorted members, two bytes each."""

    def __init__(self, members: np.ndarray):
        self.members = members.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.members[k])


class BitmapContainer:
    """One bit for every offset, with the number of members before each 64-bit word."""

    def __init__(self, members: np.ndarray):
        bits = np.zeros(CHUNK, np.uint8)
        bits[members] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        word, left = int(self.words[at]), k - int(self.before[at])
        for _ in range(left):
            word &= word - 1  # drops the lowest member
        return at * 64 + (word & -word).bit_length() - 1


class RunContainer:
    """Runs of members that follow one another, with the number of members before each run."""

    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        self.starts = starts.astype(np.uint16)
        self.before = np.concatenate([[0], np.cumsum(lengths)])

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.starts[at]) + k - int(self.before[at])


def container(members: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest form of sorted, distinct offsets below CHUNK: 4 bytes a run, 2 a member, or 8,192 in all."""
    breaks = np.flatnonzero(np.diff(members) != 1) + 1
    first = np.concatenate([[0], breaks])
    if 4 * len(first) <= min(2 * len(members), CHUNK // 8):
        return RunContainer(members[first], np.diff(np.concatenate([first, [len(members)]])))
    return ArrayContainer(members) if len(members) <= ARRAY_MOST else BitmapContainer(members)


class BoundarySet:
    """Byte offsets at which a code point starts, and the end of the text."""

    def __init__(self, data: np.ndarray):
        self.containers, self.at, counts = [], [], []
        for low in range(0, len(data) + 1, CHUNK):
            chunk = data[low : low + CHUNK]
            members = np.flatnonzero((chunk & 0xC0) != 0x80)
            if low + len(chunk) == len(data) and len(chunk) < CHUNK:
                members = np.append(members, len(chunk))
            if len(members):
                self.containers.append(container(members))
                self.at.append(low)
                counts.append(len(members))
        self.before = np.concatenate([[0], np.cumsum(counts)])

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """Byte offset of the k-th boundary, from 0."""
        i = int(np.searchsorted(self.before, k, side="right")) - 1
        return self.at[i] + self.containers[i].select(k - int(self.before[i]))


def restore(output: bytes, form: str) -> bytes:
    """The text that an output was made from. Exact, because a text that holds a marker is left plain."""
    if form == PLAIN:
        return output
    first, second = (PREFIX, SUFFIX) if form == PSM else (SUFFIX, PREFIX)
    second_at = output.index(second.encode())
    middle_at = output.index(MIDDLE.encode(), second_at)
    one, two = output[len(first) : second_at], output[second_at + len(second) : middle_at]
    prefix, suffix = (one, two) if form == PSM else (two, one)
    return prefix + output[middle_at + len(MIDDLE) :] + suffix


def draws(doc_id: Column, seed: str = SEED) -> list[Column]:
    """The first four groups of eight hexadecimal digits of the hash of a document's id, as numbers."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, seed: str = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output for every row; n counts code points.

    A NULL text is an empty one, and an empty text is plain. A NULL doc_id draws as the empty id, rows that share a
    doc_id draw alike, and repeated rows are all returned. An empty table gives no rows. Only doc_id and text are
    read, so further columns may have any names. A text of any length is cut whole; its set takes at most an eighth
    of its bytes.
    """
    markers = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            drawn = zip(*(batch[f"h{i}"].to_pylist() for i in range(1, 5)))
            for value, (h1, h2, h3, h4) in zip(batch["text"], drawn):
                text = value.as_buffer().to_pybytes() if value.is_valid else b""
                boundaries = BoundarySet(np.frombuffer(text, np.uint8))
                n = len(boundaries) - 1
                if not text or h3 % 100 >= fim_percent or any(m in text for m in markers):
                    out.append((n, PLAIN, None, None, text))
                    continue
                low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                a, b = boundaries.select(low), boundaries.select(high)
                form = SPM if h4 % 100 < spm_percent else PSM
                parts = (SUFFIX, text[b:], PREFIX, text[:a]) if form == SPM else (PREFIX, text[:a], SUFFIX, text[b:])
                cut_up = b"".join(p if isinstance(p, bytes) else p.encode() for p in (*parts, MIDDLE, text[a:b]))
                out.append((n, form, low, high - low, cut_up))
            n, form, prefix, middle, output = zip(*out) if out else ((),) * 5
            yield pa.record_batch(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    drawn = [h.alias(f"h{i}") for i, h in enumerate(draws(F.col("doc_id"), seed), 1)]
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"), *drawn)
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"
    return slim.mapInArrow(cut, schema).withColumn("output", F.col("output").cast("string"))


def digest(docs: DataFrame) -> DataFrame:
    """transform() with the hash of every output, and of the text that output and form give back."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            outputs = [v.as_buffer().to_pybytes() for v in batch["output"]]
            back = [restore(o, form) for o, form in zip(outputs, batch["form"].to_pylist())]
            sums = [pa.array([hashlib.sha256(x).hexdigest() for x in xs], pa.string()) for xs in (outputs, back)]
            kept = [batch[c] for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars")]
            yield pa.record_batch([*kept, *sums], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"])

    cut = transform(docs).withColumn("output", F.col("output").cast("binary"))
    return cut.mapInArrow(
        hashed, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    )


def digest_sql() -> str:
    markers = " OR ".join(f"contains(t, '{m}')" for m in (PREFIX, SUFFIX, MIDDLE))
    group = "CAST(CAST('0x' || substr(d, {0}, 8) AS UBIGINT) AS BIGINT)"
    h1, h2, h3, h4 = (group.format(8 * i + 1) for i in range(4))
    return f"""
        WITH drawn AS (SELECT doc_id, COALESCE(text, '') AS t, sha256('{SEED}' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS d
                       FROM documents),
        formed AS (SELECT doc_id, t, length(t) AS n, {h1} % (length(t) + 1) AS c1, {h2} % (length(t) + 1) AS c2,
                          CASE WHEN t = '' OR {markers} OR {h3} % 100 >= {FIM_PERCENT} THEN '{PLAIN}'
                               WHEN {h4} % 100 < {SPM_PERCENT} THEN '{SPM}' ELSE '{PSM}' END AS form
                   FROM drawn),
        cut AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b, substr(t, 1, least(c1, c2)) AS p,
                       substr(t, greatest(c1, c2) + 1) AS s,
                       substr(t, least(c1, c2) + 1, abs(c1 - c2)) AS m FROM formed)
        SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> '{PLAIN}' THEN CAST(a AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> '{PLAIN}' THEN CAST(b - a AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN '{PLAIN}' THEN t WHEN '{PSM}' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
                      ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM cut"""
