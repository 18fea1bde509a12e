"""Typing: exact values, strict failure, quarantine; whatever the ANSI flag says."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starload.operators.reports import first_rows, row_count
from starload.operators.staging import quarantine, to_staging
from starload.schemas import STAGING, names
from tests.conftest import FAILURE, raw, row


@pytest.fixture(params=["true", "false"], ids=["ansi", "not-ansi"])
def session(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_types_and_names(session):
    staged = to_staging(raw(session, row("2024-01-02", "IBM")))
    assert staged.columns == names(STAGING)
    assert [t for _, t in staged.dtypes] == [c.stored_type for c in STAGING]
    assert staged.first().date == dt.date(2024, 1, 2)


@pytest.mark.parametrize(
    ("text", "value"),
    [("1.00005", "1.0001"), ("-1.00005", "-1.0001"), ("7", "7.0000"), ("999999.9999", "999999.9999")],
)
def test_rounding(session, text, value):
    staged = to_staging(raw(session, row("2024-01-02", "IBM", price=text)))
    assert staged.first().open_price == Decimal(value)


def test_missing_values_are_null(session):
    staged = to_staging(raw(session, (None, None, None, None, None, None, "IBM")))
    assert tuple(staged.first()) == (None, None, None, None, None, None, "IBM")


BAD = [
    (row("2024", "A"), "date is not a date"),
    (row("2024-1-2", "A"), "date is not a date"),
    (row("2024-02-30", "A"), "date is not a date"),
    (row("2024-01-02", "A", price="1000000"), "open_price is not a decimal\\(10,4\\)"),
    (row("2024-01-02", "A", price="999999.99995"), "open_price is not a decimal\\(10,4\\)"),
    (row("2024-01-02", "A", price="NaN"), "open_price is not a decimal\\(10,4\\)"),
    (row("2024-01-02", "A", volume="1.5"), "volume is not a bigint"),
    (row("2024-01-02", "A", volume="9223372036854775808"), "volume is not a bigint"),
    (row("2024-01-02", "ABCDEFGHIJK"), "symbol is longer than 10"),
    (row("2024-01-02", None), "symbol is missing"),
]


@pytest.mark.parametrize(("bad", "reason"), BAD)
def test_bad_row_fails_the_job(session, bad, reason):
    with pytest.raises(FAILURE, match=reason):
        to_staging(raw(session, row("2024-01-02", "OK"), bad)).collect()


def test_quarantine_splits(session):
    more = [
        (row(None, "A"), "date is missing"),
        (row("2024-01-09", "TWICE", price="1"), "repeated key"),
        (row("2024-01-09", "TWICE", price="2"), "repeated key"),
    ]
    rows = raw(session, row("2024-01-02", "OK"), *[bad for bad, _ in BAD + more], row("2024-01-09", "OK"))
    good, rejects = quarantine(rows)
    assert sorted((str(r.date), r.symbol) for r in good.collect()) == [("2024-01-02", "OK"), ("2024-01-09", "OK")]
    assert sorted(map(repr, map(tuple, rejects.collect()))) == sorted(
        repr((*bad, reason.replace("\\", ""))) for bad, reason in BAD + more
    )


def test_quarantine_keeps_reasons_that_rows_came_with(session):
    rows = raw(session, row("2024-01-02", "OK"), row("2024-01-02", "B")).withColumn(
        "reason", F.when(F.col("symbol") == "B", "for some reason")
    )
    good, rejects = quarantine(rows)
    assert [r.symbol for r in good.collect()] == ["OK"]
    assert [(r.symbol, r.reason) for r in rejects.collect()] == [("B", "for some reason")]


def test_reports(spark):
    staged = to_staging(raw(spark, *[row(f"2024-01-{d:02}", "A") for d in range(12, 0, -1)]))
    assert row_count(staged).first().row_count == 12
    assert [r.date.day for r in first_rows(staged).collect()] == list(range(1, 11))
    assert "TakeOrderedAndProject" in first_rows(staged)._jdf.queryExecution().toString()
