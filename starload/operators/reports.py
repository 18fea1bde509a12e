"""The look at the loaded staging table: row count, first rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def first_rows(staging: DataFrame, n: int = 10) -> DataFrame:
    """The first `n` rows by day and symbol, found as a top-n, not by a full sort."""
    return staging.orderBy("date", "symbol").limit(n)
