"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """The day as the integer yyyymmdd."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_key(key: Column) -> Column:
    """yyyymmdd -> yyyymm, the storage partition of the fact table."""
    return F.call_function("div", key, F.lit(100)).cast("int")


def date_parts(day: Column) -> dict[str, Column]:
    """The calendar columns that the date dimension always fills."""
    return {
        "day_of_month": F.dayofmonth(day),
        "month_number": F.month(day),
        "year": F.year(day),
    }


def calendar_attributes(day: Column) -> dict[str, Column]:
    """The calendar columns that the date dimension leaves NULL unless asked for.

    Weekdays count from Monday = 1, weeks are ISO weeks, names are English.
    """
    return {
        "day_of_week": F.weekday(day) + 1,
        "day_name": F.date_format(day, "EEEE"),
        "day_of_year": F.dayofyear(day),
        "week_of_year": F.weekofyear(day),
        "month_name": F.date_format(day, "MMMM"),
        "quarter_number": F.quarter(day),
        "quarter_name": F.concat(F.lit("Q"), F.quarter(day)),
    }
