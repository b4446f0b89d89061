"""Personal data: patterns propose spans, checks confirm them, nearby words move the score."""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import map_batches, with_id

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "local_phone", "ssn")
KINDS = BASE_KINDS + ADDED_KINDS

# A run of local-part characters is tried from its start only: if it fails there it fails
# further on too.  That keeps long runs linear.
_LOCAL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_EMAIL_HERE = re.compile(_LOCAL)
_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])" + _LOCAL)
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(])\([2-9][0-9]{2}\) ?[2-9][0-9]{2}[-.][0-9]{4}(?![0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[a-z]+")

# Score of a confirmed span before its surroundings count.
START = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "local_phone": 0.6, "ssn": 0.4}
HINTS = {
    "email": {"mail", "email", "contact", "write"},
    "ip": {"ip", "address", "host", "server", "login"},
    "card": {"card", "credit", "visa", "mastercard", "payment", "cvv", "expires"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "telefon", "telefono"},
    "iban": {"iban", "account", "bank", "konto", "transfer"},
    "local_phone": {"phone", "tel", "call", "mobile", "fax"},
    "ssn": {"ssn", "social", "security", "taxpayer"},
}
AGAINST = {"version", "release", "isbn", "order", "invoice", "tracking", "serial", "example"}


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Luhn check of a string of digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064 mod 97-10 check of an IBAN without spaces."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _emails(text: str):
    pos = 0
    while (found := _EMAIL_HERE.match(text, pos) if pos else None) or (found := _EMAIL.search(text, pos)):
        yield found.start(), found.end()
        pos = found.end()


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Confirmed email, ip, card and phone spans, by kind, then start; leftmost, not overlapping within a kind."""
    out = []
    if "@" in text:
        out += [("email", s, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_octet, m.group().split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text)
                    if 9 <= sum(map(str.isdigit, m.group())) <= 15]
    return out


def _added(text: str) -> list[tuple[str, int, int]]:
    if not _DIGIT.search(text):
        return []
    out = []
    m = _IBAN.search(text)
    while m:
        code = m.group().replace(" ", "")
        # A following capital word may have been taken in: shorter cuts at a space are tried too.
        cut = m.end()
        while 15 <= len(code) and not (len(code) <= 34 and mod97(code)):
            cut = text.rfind(" ", m.start(), cut)
            if cut < 0:
                break
            code = text[m.start():cut].replace(" ", "")
        found = cut > 0 and 15 <= len(code) <= 34 and mod97(code)
        if found:
            out.append(("iban", m.start(), cut))
        # What the match took in beyond the cut, or after a code that fails, may hold another.
        m = _IBAN.search(text, cut if found else m.start() + 1)
    if "(" in text:
        out += [("local_phone", *m.span()) for m in _LOCAL_PHONE.finditer(text)]
    if "-" in text:
        out += [("ssn", *m.span()) for m in _SSN.finditer(text)
                if m.group()[:3] not in ("000", "666") and m.group()[0] != "9"
                and m.group()[4:6] != "00" and m.group()[7:] != "0000"]
    return out


def scored(text: str, kind: str, start: int, end: int, reach: int = 40) -> float:
    """Score of a span: its kind's start value, up for hint words and down for contrary words within ``reach``."""
    near = set(_WORD.findall(text[max(0, start - reach):start].lower()))
    near |= set(_WORD.findall(text[end:end + reach // 2].lower()))
    score = START[kind] + (0.3 if near & HINTS[kind] else 0.0) - (0.2 if near & AGAINST else 0.0)
    return round(min(1.0, max(0.0, score)), 2)


def find_spans(text: str | None, threshold: float = 0.5) -> list[Span]:
    """All spans of a text by kind, then start.

    Base kinds stay whatever their score.  Added kinds stay from ``threshold``
    on, and only where they do not lie on a base span; an iban, whose own check
    holds, stays beside one.
    """
    if not text:
        return []
    base = base_spans(text)
    out = [Span(k, s, e, scored(text, k, s, e)) for k, s, e in base]
    taken = [(s, e) for _, s, e in base]
    for kind, s, e in _added(text):
        if kind != "iban" and any(s < y and x < e for x, y in taken):
            continue
        score = scored(text, kind, s, e)
        if score >= threshold:
            out.append(Span(kind, s, e, score))
    return sorted(out, key=lambda x: (KINDS.index(x.kind), x.start))


def mask(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the longest counts."""
    if not text or not spans:
        return text
    chosen: list[Span] = []
    for s in sorted(spans, key=lambda x: (x.start, -x.end)):
        if chosen and s.start < chosen[-1].end:
            if s.end > chosen[-1].end:
                chosen[-1] = Span(chosen[-1].kind, chosen[-1].start, s.end, s.score)
            continue
        chosen.append(s)
    parts, at = [], 0
    for s in chosen:
        parts += [text[at:s.start], "<" + s.kind.upper() + ">"]
        at = s.end
    return "".join(parts) + text[at:]


SPANS = "array<struct<kind:string,start:int,end:int,score:double,text:string>>"


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(id, spans, masked) for every row of ``docs``; offsets count code points, end exclusive.

    One pass without a shuffle; whole texts are read.  A null text has no
    spans and stays null when masked; null or repeated ids keep one result row
    per input row; an empty table gives an empty result.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        spans = [find_spans(t, threshold) for t in texts]
        rows = [[{"kind": s.kind, "start": s.start, "end": s.end, "score": s.score, "text": t[s.start:s.end]}
                 for s in found] for t, found in zip(texts, spans)]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                   ("score", pa.float64()), ("text", pa.string())]))
        masked = [mask(t, found) for t, found in zip(texts, spans)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(rows, kind), pa.array(masked, pa.string())], ["id", "spans", "masked"])

    named = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return map_batches(named, run, with_id(named, f"spans {SPANS}, masked string"))


def digest(found: DataFrame) -> DataFrame:
    """The contract columns from ``pii_spans``: counts per base kind, hash of the base spans, all spans as text."""
    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(F.col("id").alias("doc_id"), *[count(k) for k in BASE_KINDS],
                        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
