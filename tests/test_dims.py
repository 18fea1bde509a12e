"""Dimension rows and fact rows."""

import datetime as dt

import pytest

from starload.operators.dims import (
    build_dim_date,
    named_symbols,
    new_dates,
    new_symbols,
    pad_dim_date,
    staged_symbols,
)
from starload.operators.facts import build_fact
from starload.operators.staging import to_staging
from starload.schemas import DIM_DATE, DIM_SYMBOL, FACT, names
from tests.conftest import FAILURE, raw, row, rows_of

NO_SYMBOLS = "symbol_key INT, symbol_code STRING, company_name STRING"


@pytest.fixture
def staging(spark):
    return to_staging(
        raw(spark, row("2024-12-30", "A"), row("2024-12-30", "B"), row("2023-01-01", "A"))
    )


def test_dim_date_has_a_row_per_day_of_any_symbol(staging):
    assert rows_of(build_dim_date(staging)) == {
        (20241230, dt.date(2024, 12, 30), 30, 12, 2024),
        (20230101, dt.date(2023, 1, 1), 1, 1, 2023),
    }


def test_null_day_fails(spark):
    staging = to_staging(raw(spark, (None, "1", "1", "1", "1", "1", "A")))
    with pytest.raises(FAILURE, match="date dimension: NULL"):
        build_dim_date(staging).collect()


def test_calendar_is_null_unless_asked_for(staging):
    days = build_dim_date(staging)
    plain = pad_dim_date(days).filter("date_key = 20241230").first()
    assert plain.asDict() == {
        **dict.fromkeys(names(DIM_DATE)),
        "date_key": 20241230,
        "full_date": dt.date(2024, 12, 30),
        "day_of_month": 30,
        "month_number": 12,
        "year": 2024,
    }
    full = pad_dim_date(days, with_calendar=True)
    assert [t for _, t in full.dtypes] == [c.stored_type for c in DIM_DATE]
    monday = full.filter("date_key = 20241230").first()
    # Monday of the first ISO week of 2025.
    assert (monday.day_of_week, monday.day_name, monday.week_of_year) == (1, "Monday", 1)
    assert (monday.day_of_year, monday.month_name) == (365, "December")
    assert (monday.quarter_number, monday.quarter_name) == (4, "Q4")


def test_new_dates_skip_known_ones(spark, staging):
    known = new_dates(pad_dim_date(build_dim_date(staging)).limit(0), staging)
    more = to_staging(raw(spark, row("2024-12-30", "C"), row("2024-12-31", "C")))
    assert [r.date_key for r in new_dates(known, more).collect()] == [20241231]


def test_known_symbols_keep_key_and_name(spark, staging):
    known = spark.createDataFrame([(5, "A", "Apple pie")], NO_SYMBOLS)
    new = new_symbols(known, staged_symbols(staging))
    assert new.columns == names(DIM_SYMBOL)
    assert rows_of(new) == {(6, "B", "N/A")}


def test_requested_symbols_need_no_rows(spark):
    known = spark.createDataFrame([], NO_SYMBOLS)
    new = new_symbols(known, named_symbols(spark, ["IBM"]))
    assert rows_of(new) == {(1, "IBM", "N/A")}


def test_fact_maps_columns_and_needs_the_day_in_the_dimension(spark, staging):
    days = build_dim_date(staging).filter("date_key > 20240101")
    fact = build_fact(staging, days)
    assert fact.columns == names(FACT)
    assert {(r.date_key, r.symbol_code) for r in fact.collect()} == {
        (20241230, "A"),
        (20241230, "B"),
    }


def test_fact_of_named_symbols(staging):
    fact = build_fact(staging, build_dim_date(staging), symbols=["A"])
    assert {r.symbol_code for r in fact.collect()} == {"A"}
    with pytest.raises(ValueError, match="no symbol"):
        build_fact(staging, build_dim_date(staging), symbols=[])
