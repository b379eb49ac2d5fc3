"""Personal data: patterns propose spans, checks confirm them, words nearby weigh them.

A proposal starts with the score of its pattern. A checksum or range check that passes
adds to it, one that fails ends it, and context words within a few words of the span
raise or lower it. E-mail addresses, IP numbers, payment cards and international phone
numbers are base kinds, which stay whatever their score; other kinds need the least score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "short_card", "social_number", "local_phone")
LEAST = 0.5
NEAR = 48  # characters on each side in which context words count

# --- fixed values ----------------------------------------------------------------------
# Length of an IBAN by country, as registered.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20,
    "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27,
    "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24,
    "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26, "UA": 29,
}
CONTEXT = {
    "email": "email e-mail mail contact correo courriel kontakt",
    "ip": "ip ipv4 host server address adresse dirección",
    "card": "card cards visa mastercard credit debit karte carte tarjeta",
    "phone": "phone telephone tel call mobile cell fax telefon téléphone teléfono",
    "iban": "iban account bank konto compte cuenta transfer",
    "short_card": "card cards amex visa diners credit debit karte carte tarjeta",
    "social_number": "ssn social security",
    "local_phone": "phone telephone tel call mobile cell fax telefon téléphone teléfono",
}
AGAINST = "order invoice isbn issn serial version part sku article ticket bestellung facture pedido"

# --- patterns: every one is linear in the text, as no run of characters is begun twice ---
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CHAIN = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[\x20-]?[A-Z0-9])")
_IBAN_REST = {n: re.compile(r"(?:[\x20-]?[A-Z0-9]){%d}(?![A-Za-z0-9])" % (n - 4)) for n in {*IBAN_LENGTH.values()}}
_IBAN_OTHER = re.compile(r"(?:[\x20-]?[A-Z0-9]){11,30}+(?![A-Za-z0-9])")
_SOCIAL = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_LOCAL_PHONE = re.compile(
    r"(?<![0-9+.-])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9.-])"
)
_POINTS = {kind: re.compile(r"(?<!\w)(?:" + "|".join(words.split()) + r")(?!\w)") for kind, words in CONTEXT.items()}
_AGAINST = re.compile(r"(?<!\w)(?:" + "|".join(AGAINST.split()) + r")(?!\w)")
_NOT_DIGIT = re.compile(r"[^0-9]")


class Span(NamedTuple):
    """Code points from ``start`` up to, but not with, ``end``."""

    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """From the right, every second digit doubled and its own digits added: a multiple of ten."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(account: str) -> bool:
    """First four characters to the end, letters as 10 to 35: the number leaves 1."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From every @: the local part to its left, as far as the last match; the domain to its right."""
    begin, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > begin and text[start - 1] in _LOCAL:
                start -= 1
        if start < at:
            yield start, domain.end()
            begin = domain.end()
        at = text.find("@", max(at + 1, begin))


def _ibans(text: str) -> Iterator[tuple[int, int, float]]:
    end = 0
    for head in _IBAN_HEAD.finditer(text):
        if head.start() < end:
            continue
        length = IBAN_LENGTH.get(head.group()[:2])
        rest = (_IBAN_REST[length] if length else _IBAN_OTHER).match(text, head.end())
        if rest and mod97(re.sub(r"[\x20-]", "", text[head.start() : rest.end()])):
            end = rest.end()
            yield head.start(), end, 0.75 if length else 0.4


def _weighed(text: str, kind: str, start: int, end: int, score: float) -> Span:
    before, after = text[max(0, start - NEAR) : start], text[end : end + NEAR]
    around = f"{before} \n {after}".lower()
    if _POINTS[kind].search(around):
        score += 0.25
    if _AGAINST.search(around):
        score -= 0.25
    return Span(kind, start, end, round(min(1.0, max(0.0, score)), 2))


def find_spans(text: str | None, least: float = LEAST) -> list[Span]:
    """Spans by kind in the order of ``KINDS``, then by start. None and "" have none.

    Base kinds do not overlap among their own, and each is found without regard to the
    other kinds. Spans of the other kinds do not overlap any span before them.
    """
    if not text:
        return []
    found = [_weighed(text, "email", a, b, 0.8) for a, b in _emails(text)]
    chains = []
    if _CHAIN.search(text):
        for m in _IP.finditer(text):
            parts = [part.lstrip("0") or "0" for part in m.group().split(".")]
            if all(len(part) <= 3 and int(part) <= 255 for part in parts):
                found.append(_weighed(text, "ip", m.start(), m.end(), 0.6))
        for m in _CHAIN.finditer(text):
            if m.end() - m.start() < 13:
                continue
            digits = _NOT_DIGIT.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(_weighed(text, "card", m.start(), m.end(), 0.7))
            elif 13 <= len(digits) <= 15 and luhn(digits):
                known = (len(digits), digits[:1]) == (13, "4") or (len(digits), digits[:2]) in ((14, "36"), (14, "38"))
                american = len(digits) == 15 and digits[:2] in ("34", "37")
                chains.append((m.start(), m.end(), 0.55 if american else 0.4 if known else 0.2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                    found.append(_weighed(text, "phone", m.start(), m.end(), 0.6))
        proposed = [("iban", a, b, s) for a, b, s in _ibans(text)]
        proposed += [("short_card", a, b, s) for a, b, s in chains]
        for m in _SOCIAL.finditer(text):
            area, group, serial = m.groups()
            if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
                proposed.append(("social_number", m.start(), m.end(), 0.55))
        for m in _LOCAL_PHONE.finditer(text):
            if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 11:
                proposed.append(("local_phone", m.start(), m.end(), 0.45 if m.group().startswith("(") else 0.3))
        taken = [(s.start, s.end) for s in found]
        for kind, start, end, score in proposed:
            span = _weighed(text, kind, start, end, score)
            if span.score >= least and all(end <= a or start >= b for a, b in taken):
                found.append(span)
                taken.append((start, end))
    return sorted(found, key=lambda s: (KINDS.index(s.kind), s.start))


SPANS = "array<struct<kind:string,start:long,end:long,score:double,value:string>>"
_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("value", pa.string())])
)


def find(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """Per row of ``docs``: doc_id and spans (kind, start, end, score, value).

    Null and empty texts have no spans, and an empty table gives no rows. Each row is
    read on its own and whole, however long: rows with equal ids or texts give equal
    rows, and further columns are not read. There are no ties, as spans of a kind do not
    overlap. ``least`` is what spans of the kinds that are not base need as score.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{**s._asdict(), "value": text[s.start : s.end]} for s in find_spans(text, least)]
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, _ARROW_SPANS)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, spans {SPANS}")


def redact_text(text: str | None, least: float = LEAST) -> str | None:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    if not text:
        return text
    out, at = [], 0
    for span in sorted(find_spans(text, least), key=lambda s: (s.start, -s.end)):
        if span.start >= at:
            out += [text[at : span.start], f"[{span.kind}]"]
        at = max(at, span.end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows with personal data in ``text`` replaced; other columns, n_chars too, as they are."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [redact_text(t, least) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.names[at], pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Per row of ``find``: the number of spans of each base kind, and the spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, kind)) for kind in BASE]
    counts = [(F.size("spans") - left).cast("long").alias(f"n_{kind}") for kind, left in zip(BASE, counts)]
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))
