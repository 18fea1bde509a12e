"""Personal data in texts: patterns propose, checksums confirm, nearby words adjust.

Every kind has a pattern, a validator and words that make it likelier when they stand near.
A proposal starts from its kind's score, loses out at once if the validator refuses it, and
gains `NEARBY` if one of the words is within `window` code points. It is reported if it
reaches `threshold`. The kinds email, ip, card and phone start above any sensible threshold,
so they are reported whenever they are valid; an IBAN is vouched for by its check digits; a
bare nine-digit number in groups only counts next to a word that says what it is.

All scans take time in proportion to the text, whatever it holds: no pattern here is tried
anew from every place of a long run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import arrow_batches, text_of

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]

# Where a proposal of a kind starts from, and what a word nearby adds.
SCORES = {"email": 0.8, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.7, "ssn": 0.3}
NEARBY = 0.2
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "server", "host"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "mobil"),
    "iban": ("iban", "account", "konto", "compte", "cuenta", "bank"),
    "ssn": ("ssn", "social security", "taxpayer"),
}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_IBAN_REST = re.compile(r"(?:\x20?[A-Z0-9]){11,30}")
_WORD_END = re.compile(r"(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

# Characters of an IBAN, by country.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


class Span(NamedTuple):
    """Code points [start, end) of a text."""

    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern local@domain from the left, but by looking back from each @ once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers of at most 255, taken in fours from each dotted row of numbers."""
    for row in _DOTTED.finditer(text):
        parts = row.group().split(".")
        start = row.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end
            start = end + 1


def cards(text: str) -> Iterator[tuple[int, int]]:
    for match in _DIGITS.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield match.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for match in _PHONE.finditer(text):
        if 9 <= len(_digits(match.group())) <= 15:
            yield match.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """From each place that may begin one, as long as its country prescribes; for a country
    not known here up to the last word end where the check digits agree."""
    done = 0
    for head in _IBAN_HEAD.finditer(text):
        start = head.start()
        rest = _IBAN_REST.match(text, head.end()) if start >= done else None
        if not rest:
            continue
        ends = [i + 1 for i in range(start, rest.end()) if text[i] != " "]
        length = IBAN_LENGTHS.get(head.group()[:2])
        for n in [length] if length else range(len(ends), 14, -1):
            if n > len(ends) or not _WORD_END.match(text, ends[n - 1]):
                continue
            if mod97(text[start : ends[n - 1]].replace(" ", "")):
                done = ends[n - 1]
                yield start, done
                break


def ssns(text: str) -> Iterator[tuple[int, int]]:
    for match in _SSN.finditer(text):
        area, group, serial = match.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield match.span()


_FINDERS = dict(zip(KINDS, (emails, ips, cards, phones, ibans, ssns), strict=True))
_ANY = re.compile(r"[0-9@]")


def spans_of(text: str, window: int = 40, threshold: float = 0.5) -> list[Span]:
    """All spans by start, then by kind in the order of KINDS."""
    if not _ANY.search(text):
        return []
    found = []
    for kind, finder in _FINDERS.items():
        for start, end in finder(text):
            near = text[max(0, start - window) : start] + " " + text[end : end + window]
            near = near.lower()
            score = SCORES[kind] + NEARBY * any(word in near for word in CONTEXT[kind])
            if score >= threshold:
                found.append(Span(kind, start, end, score))
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


def find_pii(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 40,
    threshold: float = 0.5,
) -> DataFrame:
    """id and spans, an array of (kind, start, end, score), for every row.

    A null or empty text has no spans. Rows are judged one by one: repeated rows repeat, and
    null ids stay null. Other columns are ignored. Spans of different kinds may overlap.
    """
    schema = "id {}, spans ARRAY<STRUCT<kind: STRING, start: BIGINT, `end`: BIGINT, score: DOUBLE>>"

    def judge(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [
            [span._asdict() for span in spans_of(text.as_py(), window, threshold)]
            for text in batch.column(1)
        ]
        fields = [
            ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
            ("score", pa.float64()),
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.list_(pa.struct(fields)))], names=["id", "spans"]
        )

    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return source.mapInArrow(arrow_batches(judge), schema.format(kind)).withColumnRenamed("id", id_col)
