"""Constraint audit: what the tables promise but Parquet does not enforce.

Each table is scanned once. Its rows are gathered by key, with a counter for every check, and
what is left, a row per key, meets the dimensions it refers to.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column as Expression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.schemas import DIM_DATE, DIM_SYMBOL, FACT, FACT_KEY, STAGING, Column


FACT_TABLE = "fact_stock_prices"
# The checks of the fact that depend on the dimensions end in this.
KNOWN = " known"


def _row_checks(columns: tuple[Column, ...]) -> dict[str, Expression]:
    """Check name -> whether a row fails it: NULL, text length and decimal range."""
    failures = {}
    for column in columns:
        value = F.col(column.name)
        if column.required:
            failures[f"{column.name} not null"] = value.isNull()
        if column.max_length:
            failures[f"{column.name} length"] = F.length(value) > column.max_length
        if column.max_value:
            failures[f"{column.name} range"] = F.abs(value) >= column.max_value
    return failures


def audit_table(
    df: DataFrame,
    table: str,
    columns: tuple[Column, ...],
    key: tuple[str, ...] = (),
    known: dict[str, DataFrame] | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """check_name, table_name, violations.

    `key` must be unique: rows beyond the first of a key count, but for keys with a NULL.
    `known` gives for a column the table that must hold its values; NULLs need not be held.
    Violations are counted apart for each value of the columns `by`, which come along; all rows
    of a key must agree in them.
    """
    checks = _row_checks(columns)
    counters = [F.count_if(bad).alias(f"c{i}") for i, bad in enumerate(checks.values())]
    names = list(checks)
    if not key:
        totals = df.groupBy(*by).agg(*counters)
    else:
        # Combined before the shuffle, so that a key with many rows arrives as one per task.
        grouped = df.groupBy(*key, *by).agg(*counters, F.count(F.lit(1)).alias("copies"))
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
        sums = [F.sum(f"c{i}").alias(f"c{i}") for i in range(len(names))]
        names.append(f"{', '.join(key)} unique")
        sums.append(F.sum(F.when(whole, F.col("copies") - 1)).alias(f"c{len(names) - 1}"))
        for column, dimension in (known or {}).items():
            held = dimension.select(F.col(column).alias(f"held_{column}")).distinct()
            grouped = grouped.join(held, grouped[column] == F.col(f"held_{column}"), "left")
            orphan = F.col(column).isNotNull() & F.col(f"held_{column}").isNull()
            names.append(f"{column}{KNOWN}")
            sums.append(F.sum(F.when(orphan, F.col("copies"))).alias(f"c{len(names) - 1}"))
        totals = grouped.groupBy(*by).agg(*sums)
    rows = [
        F.struct(F.lit(name).alias("check_name"), F.coalesce(f"c{i}", F.lit(0)).alias("violations"))
        for i, name in enumerate(names)
    ]
    return totals.select(*by, F.explode(F.array(*rows)).alias("c")).select(
        "c.check_name", F.lit(table).alias("table_name"), "c.violations", *by
    )


def audit_fact(
    fact: DataFrame, dim_date: DataFrame, dim_symbol: DataFrame, by: tuple[str, ...] = ()
) -> DataFrame:
    """The promises of the fact, and those it makes to the dimensions."""
    known = {"date_key": dim_date, "symbol_code": dim_symbol}
    return audit_table(fact, FACT_TABLE, FACT, FACT_KEY, known, by)


def audit(
    staging: DataFrame, dim_date: DataFrame, dim_symbol: DataFrame, fact: DataFrame
) -> DataFrame:
    """check_name, table_name, violations: one row per promise of the data model."""
    facts = audit_fact(fact, dim_date, dim_symbol)
    return audit_inputs(staging, dim_date, dim_symbol).unionByName(facts)


def fact_checks() -> list[str]:
    """The names of the checks of the fact."""
    return [*_row_checks(FACT), f"{', '.join(FACT_KEY)} unique", *[f"{key}{KNOWN}" for key in FACT_KEY]]


def audit_inputs(staging: DataFrame, dim_date: DataFrame, dim_symbol: DataFrame) -> DataFrame:
    """The same for all but the fact."""
    parts = [
        audit_table(staging, "stock_prices", STAGING),
        audit_table(dim_date, "dim_date", DIM_DATE, ("date_key",)),
        audit_table(dim_symbol, "dim_symbol", DIM_SYMBOL, ("symbol_code",)),
    ]
    return reduce(DataFrame.unionByName, parts)
