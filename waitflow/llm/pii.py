"""Personal data: expressions propose spans, checksums confirm them, nearby words adjust the score."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ["email", "ip", "card", "phone", "iban", "ssn", "secret"]
BASE_KINDS = KINDS[:4]
WINDOW = 40  # code points before a span that are searched for context words
THRESHOLD = 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits is entered at its first digit only: a later start could match only if the first one does.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){11,}+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_TOKEN_END = re.compile(r"[A-Z0-9](?![A-Za-z0-9])")
# Characters of an IBAN per country.
IBAN_LENGTH = {
    country: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}+=*")
_DIGIT = re.compile("[0-9]")

# Score of a proposed span before its context is read, and the words that raise it.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3, "secret": 0.3}
CONTEXT = {
    "email": re.compile("mail|contact|write", re.I),
    "ip": re.compile(r"\bip\b|host|server|address", re.I),
    "card": re.compile("card|visa|credit|payment|debit", re.I),
    "phone": re.compile("phone|tel|call|mobile|fax", re.I),
    "iban": re.compile("iban|account|bank|konto|cuenta|compte", re.I),
    "ssn": re.compile("ssn|social security|tax id", re.I),
    "secret": re.compile("token|secret|passw|api.?key|access.?key", re.I),
}
RAISE = 0.4


@dataclass(frozen=True, order=True)
class Span:
    start: int
    order: int
    end: int
    kind: str
    score: float

    def text(self) -> str:
        return f"{self.kind}:{self.start}:{self.end}"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the part before an @ reaches back over all it may hold, up to the last match."""
    done = 0
    for m in _DOMAIN.finditer(text):
        at = start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            done = m.end()
            yield start, done


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Spans that mod-97 confirms, cut where the country's length ends, or else at the last token end that fits.

    Upper-case tokens and numbers after an IBAN are proposed with it, so every token end is a possible end. A start
    that fails does not use up the text after it.
    """
    at = 0
    while head := _IBAN_HEAD.search(text, at):
        start, at = head.start(), head.end()
        m = _IBAN.match(text, start)
        if not m:
            continue
        ends = {len(text[start : e.end()].replace(" ", "")): e.end() for e in _TOKEN_END.finditer(text, start, m.end())}
        # The whole proposal is tried last, also where its length is not the country's.
        named = IBAN_LENGTH.get(head[0][:2])
        tried = [n for n in sorted(ends, reverse=True) if 15 <= n <= 34]
        for n in tried if named is None else [n for n in tried if n == named] + tried[:1]:
            if mod97(text[start : ends[n]].replace(" ", "")):
                at = ends[n]
                yield start, at
                break


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    if "@" in text:
        for a, b in _emails(text):
            yield "email", a, b
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                yield "phone", m.start(), m.end()
    for start, end in _ibans(text):
        yield "iban", start, end
    if "-" in text:
        for m in _SSN.finditer(text):
            area, group, serial = m[0].split("-")
            if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
                yield "ssn", m.start(), m.end()
    for m in _SECRET.finditer(text):
        if _DIGIT.search(m[0]):
            yield "secret", m.start(), m.end()


def find_spans(text: str | None, threshold: float = THRESHOLD) -> list[Span]:
    """All spans of a whole text by start, then kind; offsets are code points, the end is exclusive."""
    spans = []
    for kind, start, end in _proposed(text or ""):
        near = CONTEXT[kind].search(text, max(0, start - WINDOW), start)
        score = min(1.0, PRIOR[kind] + (RAISE if near else 0.0))
        if score >= threshold:
            spans.append(Span(start, KINDS.index(kind), end, kind, score))
    return sorted(spans)


SPAN_SCHEMA = "doc_id long, kind string, start int, end int, score double, text string"


def spans(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per span: doc_id, kind, start, end, score and the text itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {"doc_id": i, "kind": s.kind, "start": s.start, "end": s.end, "score": s.score, "text": t[s.start : s.end]}
                for i, t in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist())
                for s in find_spans(t, threshold)
            ]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("doc_id", pa.int64()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("text", pa.string())]))

    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(run, SPAN_SCHEMA)


DIGEST_SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_other long"
_DIGEST = pa.schema(
    [("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in BASE_KINDS], ("base_sha256", pa.string()), ("spans", pa.string()), ("n_other", pa.int64())]
)


def digest_row(doc_id: int | None, text: str | None) -> dict:
    found = find_spans(text)
    base = [s for s in found if s.kind in BASE_KINDS]
    counts = {f"n_{k}": sum(s.kind == k for s in base) for k in BASE_KINDS}
    return {
        "doc_id": doc_id,
        **counts,
        "base_sha256": hashlib.sha256(",".join(s.text() for s in base).encode()).hexdigest(),
        "spans": ",".join(s.text() for s in found),
        "n_other": len(found) - len(base),
    }


def digest(docs: DataFrame) -> DataFrame:
    """One row per row of docs, with counts, a hash of the base spans and all spans as text.

    A NULL or empty text has no spans; repeated rows are all kept; a text of any length is read whole, in time
    linear in its length; columns other than doc_id and text are not read. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [digest_row(i, t) for i, t in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist())]
            yield pa.RecordBatch.from_pylist(rows, _DIGEST)

    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(run, DIGEST_SCHEMA)
