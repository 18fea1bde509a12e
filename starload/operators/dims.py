"""Rows of the two dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.checks import require_present
from starload.functions.dates import calendar_attributes, date_key, date_parts
from starload.operators.merge import assign_keys, insert_ignore
from starload.schemas import DIM_DATE, DIM_SYMBOL, UNKNOWN_COMPANY, names
from starload.session import stored


def build_dim_date(staging: DataFrame) -> DataFrame:
    """One row per staged day, of every symbol: key, day and the always filled parts.

    A NULL day fails the job.
    """
    days = staging.select(F.col("date").alias("full_date")).distinct()
    days = require_present(days, ["full_date"], "date dimension")
    day = F.col("full_date")
    parts = [part.alias(name) for name, part in date_parts(day).items()]
    return days.select(date_key(day).alias("date_key"), "full_date", *parts)


def pad_dim_date(dim: DataFrame, with_calendar: bool = False) -> DataFrame:
    """All columns of the table; the calendar attributes are NULL unless asked for."""
    filled = calendar_attributes(F.col("full_date")) if with_calendar else {}
    columns = []
    for column in DIM_DATE:
        if column.name in dim.columns:
            columns.append(F.col(column.name))
        else:
            value = filled.get(column.name, F.lit(None))
            columns.append(value.cast(column.stored_type).alias(column.name))
    return dim.select(*columns)


def new_dates(target: DataFrame, staging: DataFrame, with_calendar: bool = False) -> DataFrame:
    """Date rows to append."""
    days = insert_ignore(target, build_dim_date(staging), ["date_key"])
    return pad_dim_date(days, with_calendar)


def staged_symbols(staging: DataFrame) -> DataFrame:
    """One row per staged symbol. A NULL symbol fails the job."""
    codes = staging.select(F.col("symbol").alias("symbol_code")).distinct()
    return require_present(codes, ["symbol_code"], "symbol dimension")


def named_symbols(spark: SparkSession, symbols: list[str]) -> DataFrame:
    """One row per requested symbol, staged or not."""
    return spark.createDataFrame([(s,) for s in symbols], "symbol_code STRING")


def unknown_symbols(target: DataFrame, codes: DataFrame) -> DataFrame:
    return insert_ignore(target, codes, ["symbol_code"])


def number_symbols(target: DataFrame, unknown: DataFrame) -> DataFrame:
    """Symbol rows to append: the unknown codes get the next keys and no company name yet.

    Reads `unknown` twice, so it should be stored if finding it means reading all of staging.
    """
    keyed = assign_keys(target, unknown, "symbol_key", "symbol_code")
    return keyed.withColumn("company_name", F.lit(UNKNOWN_COMPANY)).select(*names(DIM_SYMBOL))


def new_symbols(target: DataFrame, codes: DataFrame) -> DataFrame:
    """Both steps. Rows the target already has keep their key and name."""
    return number_symbols(target, stored(unknown_symbols(target, codes), "symbol_codes"))
