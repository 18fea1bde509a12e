"""Rows of the price fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.schemas import FACT, STAGING_TO_FACT, VERSION, names


def build_fact(
    staging: DataFrame, dim_date: DataFrame, symbols: list[str] | None = None
) -> DataFrame:
    """Staged rows whose day is in the date dimension, in the columns of the fact, and when they
    landed if staging says so.

    Symbols are bound as literals and reach the scan of the staging files. Without them
    all staged symbols are taken.

    No broadcast is forced: the dimension is a table, so the planner checks its size and
    broadcasts it, or falls back to a sort-merge join with adaptive skew splitting.
    """
    if symbols is not None:
        if not symbols:
            raise ValueError("no symbol to load")
        staging = staging.filter(F.col("symbol").isin(list(symbols)))
    days = dim_date.select("full_date", "date_key")
    joined = staging.join(days, staging["date"] == days["full_date"], "inner")
    version = [name for name in names(VERSION) if name in staging.columns]
    return joined.withColumnRenamed("symbol", "symbol_code").withColumnsRenamed(
        STAGING_TO_FACT
    ).select(*names(FACT), *version)
