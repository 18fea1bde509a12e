"""Shapes of the files and tables.

The column names, types and lengths below are fixed values: they are the data
model that files and tables must keep to be exchangeable.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Column(NamedTuple):
    name: str
    type: str
    required: bool = False

    @property
    def stored_type(self) -> str:
        """The type outside table definitions, where Spark knows no varchar."""
        return "string" if self.type.startswith("varchar") else self.type

    @property
    def max_length(self) -> int | None:
        found = re.fullmatch(r"varchar\((\d+)\)", self.type)
        return int(found[1]) if found else None

    @property
    def max_value(self) -> int | None:
        """Exclusive bound on the size of a decimal, None for other types."""
        found = re.fullmatch(r"decimal\((\d+),(\d+)\)", self.type)
        return 10 ** (int(found[1]) - int(found[2])) if found else None


# One document of the price service: a map of ISO day -> five text fields.
SERIES_KEY = "Time Series (Daily)"
FIELDS = {
    "1. open": "open",
    "2. high": "high",
    "3. low": "low",
    "4. close": "close",
    "5. volume": "volume",
}

# The interchange CSV files; every column is kept as text until it is staged.
CSV_COLUMNS = ("timestamp", "open", "high", "low", "close", "volume", "symbol")
CSV_SCHEMA = ", ".join(f"`{c}` STRING" for c in CSV_COLUMNS)

# CSV column -> staging column, in staging order.
CSV_TO_STAGING = {
    "timestamp": "date",
    "open": "open_price",
    "high": "high",
    "low": "low",
    "close": "close_price",
    "volume": "volume",
    "symbol": "symbol",
}

STAGING = (
    Column("date", "date"),
    Column("open_price", "decimal(10,4)"),
    Column("high", "decimal(10,4)"),
    Column("low", "decimal(10,4)"),
    Column("close_price", "decimal(10,4)"),
    Column("volume", "bigint"),
    Column("symbol", "varchar(10)", True),
)

DIM_DATE = (
    Column("date_key", "int", True),
    Column("full_date", "date", True),
    Column("day_of_week", "int"),
    Column("day_name", "varchar(10)"),
    Column("day_of_month", "int"),
    Column("day_of_year", "int"),
    Column("week_of_year", "int"),
    Column("month_number", "int"),
    Column("month_name", "varchar(10)"),
    Column("quarter_number", "int"),
    Column("quarter_name", "varchar(2)"),
    Column("year", "int"),
)

DIM_SYMBOL = (
    Column("symbol_key", "int"),
    Column("symbol_code", "varchar(10)", True),
    Column("company_name", "varchar(255)"),
)

FACT = (
    Column("date_key", "int", True),
    Column("symbol_code", "varchar(10)", True),
    Column("open_price", "decimal(10,4)"),
    Column("high_price", "decimal(10,4)"),
    Column("low_price", "decimal(10,4)"),
    Column("close_price", "decimal(10,4)"),
    Column("volume", "bigint"),
)

# Staging column -> fact column for the five measures.
STAGING_TO_FACT = {
    "open_price": "open_price",
    "high": "high_price",
    "low": "low_price",
    "close_price": "close_price",
    "volume": "volume",
}

FACT_KEY = ("date_key", "symbol_code")

# What tells versions of a row apart: the landing day of its document and when that landed. It
# is stored in the files of staging and fact, and no column of the tables.
VERSION = (Column("landed", "int"), Column("landed_at", "timestamp"))
UNKNOWN_COMPANY = "N/A"


def names(columns: tuple[Column, ...]) -> list[str]:
    return [c.name for c in columns]


def ddl(columns: tuple[Column, ...]) -> str:
    return ", ".join(f"`{c.name}` {c.type}" for c in columns)


def stored_ddl(columns: tuple[Column, ...]) -> str:
    """Without lengths."""
    return ", ".join(f"`{c.name}` {c.stored_type}" for c in columns)
