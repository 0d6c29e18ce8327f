"""Personal data in texts: patterns propose, checks confirm, context scores.

Four kinds (email, ip, card, phone) are found by pattern and check alone. Two
more come from the method: IBANs confirmed by mod-97, and social-security
numbers, whose shape has no check digit, so that only near context words lift
them over the threshold. Every scan takes time linear in the text, also for
texts that are one endless word or number.

Defined results: a null text counts as empty, an empty text has no spans; a row
is kept whatever its other columns hold or are named; repeated rows each get their
own spans; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import mapped, quoted

KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn")
SPANS_TYPE = "array<struct<kind:string,start:int,end:int,text:string,score:double,base:boolean>>"

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

#: How sure a span is: by its pattern alone, by a passed check, and what a context word adds.
PATTERN_SCORE, CHECKED_SCORE, CONTEXT_GAIN, THRESHOLD, CONTEXT_CHARS = 0.4, 0.8, 0.2, 0.5, 48
CONTEXT = {
    "email": ("mail", "contact", "write", "address"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "debit", "payment", "pay"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "contact"),
    "iban": ("iban", "account", "bank", "transfer", "konto", "compte"),
    "ssn": ("ssn", "social security", "taxpayer"),
}


def luhn(digits: str) -> bool:
    """Luhn's check over ASCII digits."""
    total = sum(map(int, digits[-1::-2]))
    for c in digits[-2::-2]:
        total += sum(divmod(2 * int(c), 10))
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 13616: the first four characters last, letters as 10..35, remainder 1."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the e-mail pattern: a match holds one "@", its local
    part is all that can stand before it since the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        head = text[done:at]
        start = done + len(head.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        done = found.end() if found else at + 1
        at = text.find("@", done)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) < 4 and int(p or 0) < 256 for part in m.groups()):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= sum(map(str.isdigit, m[0])) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        if 15 <= len(plain := m[0].replace(" ", "")) <= 34 and mod97(plain):
            yield m.span()


def _ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def score(kind: str, text: str, start: int, end: int) -> float:
    """The check's share plus a gain if a context word is near the span."""
    near = (text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]).lower()
    gain = CONTEXT_GAIN if any(w in near for w in CONTEXT[kind]) else 0.0
    return (CHECKED_SCORE if kind in ("card", "iban", "ip") else PATTERN_SCORE) + gain


def spans(text: str | None) -> list[dict]:
    """All spans of one text, by start, then by kind as listed."""
    if not text:
        return []
    found = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for kind, scan in (("ip", _ips), ("card", _cards), ("phone", _phones), ("iban", _ibans), ("ssn", _ssns)):
            found += [(kind, s, e) for s, e in scan(text)]
    order = {k: i for i, k in enumerate(KINDS + ADDED_KINDS)}
    rows = [{"kind": k, "start": s, "end": e, "text": text[s:e], "score": score(k, text, s, e), "base": k in KINDS} for k, s, e in found]
    return sorted((r for r in rows if r["base"] or r["score"] >= THRESHOLD), key=lambda r: (r["start"], order[r["kind"]]))


def redacted(text: str | None, found: list[dict]) -> str | None:
    """The text with every run of overlapping spans replaced by ``<KIND>`` of its first."""
    if not found:
        return text
    out, at = [], 0
    for r in found:
        if r["start"] >= at:
            out += [text[at : r["start"]], f"<{r['kind'].upper()}>"]
        at = max(at, r["end"])
    return "".join(out) + text[at:]


def detect(df: DataFrame, text: str = "text", out: str = "spans", redact_to: str | None = None) -> DataFrame:
    """``df`` with the spans of ``text`` in a new column ``out``, and the redacted
    text in ``redact_to`` if named. Columns of these names are replaced."""
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("text", pa.string()), ("score", pa.float64()), ("base", pa.bool_())]))
    new = [(out, SPANS_TYPE)] + ([(redact_to, "string")] if redact_to else [])

    def run(batches: Iterator) -> Iterator:
        for (column,), rest in batches:
            texts = column.to_pylist()
            found = [spans(t) for t in texts]
            made = [pa.array(found, span_type)]
            if redact_to:
                made.append(pa.array([redacted(t, f) for t, f in zip(texts, found, strict=True)], pa.string()))
            yield made, rest

    return mapped(df, [quoted(text)], run, new)


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans and the list of all spans."""

    def joined(c):
        return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def counted(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *(counted(k) for k in KINDS),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )
