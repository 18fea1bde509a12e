from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starload.llm.pii import BASE, KINDS, find_pii, luhn, mod97, spans_of
from tests.conftest import SF_DIR

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def expected(text):
    found = [
        (m.start(), BASE.index(kind), kind, m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text)
        if valid(kind, m.group())
    ]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def base(text):
    return [s[:3] for s in spans_of(text) if s.kind in BASE]


@settings(max_examples=400, deadline=None)
@given(st.text("a.@-+ 0123456789(%é", max_size=60))
def test_base_kinds_equal_their_patterns(text):
    assert base(text) == expected(text)


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c@d.e", "@x.y a@@b.c", "1.2.3.4.5.6.7.8.9", "300.1.1.1 001.002.003.004", "1.2.3", "4111 1111-1111 1111",
        "+1 (988) 555-2485, +12", "tél é +49-30 123456 7", "0" * 400 + ".1.1.1", "79927398713 4539 1488 0343 6467",
    ],
)
def test_base_kinds_in_chosen_texts(text):
    assert base(text) == expected(text)


def test_documents_equal_patterns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    found = 0
    for row in find_pii(docs).collect():
        got = [(s["kind"], s["start"], s["end"]) for s in row["spans"]]
        assert [g for g in got if g[0] in BASE] == expected(texts[row["doc_id"]])
        found += len(got)
    assert found > 50


def test_checksums():
    assert luhn("79927398713") and not luhn("79927398710")
    assert mod97("GB82WEST12345698765432") and not mod97("GB82WEST12345698765431")


def test_further_kinds_need_checks_and_context():
    kinds = lambda text: [s.kind for s in spans_of(text)]
    assert "iban" in kinds("send to GB82 WEST 1234 5698 7654 32 now")
    assert "iban" not in kinds("send to GB82 WEST 1234 5698 7654 31 now")
    assert kinds("his SSN is 123-45-6789.") == ["ssn"]
    assert kinds("part number 123-45-6789.") == []
    assert kinds("ssn 000-45-6789") == []
    plain, told = spans_of("x 10.0.0.1")[0], spans_of("server 10.0.0.1")[0]
    assert told.score > plain.score


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("IBAN GB82 WEST 1234 5698 7654 32 BIC WESTGB2L", ["GB82 WEST 1234 5698 7654 32"]),
        ("pay GB82 WEST 1234 5698 7654 32 EUR 100", ["GB82 WEST 1234 5698 7654 32"]),
        ("GB82WEST12345698765432 DE89370400440532013000 NO9386011117947",
         ["GB82WEST12345698765432", "DE89370400440532013000", "NO9386011117947"]),
        ("AB12 CDEF 1234 DE89 3704 0044 0532 0130 00 A", ["DE89 3704 0044 0532 0130 00"]),
        ("GB82WEST12345698765432X", []),
        ("GB82 WEST 1234 5698 7654 31 BIC WESTGB2L", []),
    ],
)
def test_an_iban_ends_where_its_country_says(text, wanted):
    assert [text[s.start : s.end] for s in spans_of(text) if s.kind == "iban"] == wanted


def test_an_iban_of_an_unknown_country_ends_at_a_word():
    body = "1234567890123456"
    check = next(f"{n:02}" for n in range(2, 99) if mod97(f"ZZ{n:02}{body}"))
    text = f"to ZZ{check} {body} EUR NOW"
    assert [text[s.start : s.end] for s in spans_of(text) if s.kind == "iban"] == [f"ZZ{check} {body}"]


def test_long_runs_take_no_longer_than_their_length():
    assert base("1" * 300_000) == []
    assert base("a" * 300_000 + "@") == []
    assert len(base("a" * 300_000 + "@b.c")) == 1
    assert base("1." * 100_000)[0] == ("ip", 0, 7)


def test_rows_of_every_kind(spark, documents):
    rows = [(1, None), (2, ""), (None, "a@b.c"), (3, "a@b.c"), (3, "a@b.c")]
    found = find_pii(documents(rows, spans="x", id="y", kind="z"))
    assert found.columns == ["doc_id", "spans"]
    assert sorted((str(r["doc_id"]), len(r["spans"])) for r in found.collect()) == [
        ("1", 0), ("2", 0), ("3", 1), ("3", 1), ("None", 1),
    ]
    assert find_pii(documents([])).count() == 0
    assert set(BASE) < set(KINDS)
