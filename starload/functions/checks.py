"""Checks that run inside the plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, ok: Column, message: Column) -> DataFrame:
    """All rows of `df`; the job fails at a row for which `ok` is not true.

    The check is a filter, not a column, so no later projection can prune it away,
    and it needs no job of its own.
    """
    return df.filter(F.assert_true(F.coalesce(ok, F.lit(False)), message).isNull())


def require_present(df: DataFrame, columns: list[str], what: str) -> DataFrame:
    """All rows of `df`; the job fails at a row with a NULL in one of `columns`."""
    present = F.lit(True)
    for name in columns:
        present = present & F.col(name).isNotNull()
    return require(df, present, F.lit(f"{what}: NULL in {', '.join(columns)}"))
