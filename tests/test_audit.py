"""The audit finds every planted violation and nothing in a clean load."""

from pathlib import Path

from starload.operators.audit import audit
from starload.plans.load import audit_tables, load_dimensions, load_fact, load_staging
from starload.plans.warehouse import Warehouse
from tests.conftest import raw, row


def by_check(report):
    return {(r.table_name, r.check_name): r.violations for r in report.collect()}


def test_clean_load_has_no_violations(spark, warehouse):
    load_staging(warehouse, raw(spark, row("2024-01-02", "A"), row("2024-01-03", "B")))
    load_dimensions(warehouse, with_calendar=True)
    load_fact(warehouse)
    violations = by_check(audit_tables(warehouse))
    assert len(violations) == 26
    assert set(violations.values()) == {0}


def test_violations(spark):
    staging = spark.sql(
        "SELECT date'2024-01-02' date, 1000000 open_price, -1000000 high, 1 low, 1 close_price, "
        "1 volume, s symbol FROM VALUES ('A'), (NULL), ('ABCDEFGHIJK') t(s)"
    )
    dim_date = spark.sql(
        "SELECT k date_key, d full_date, 1 day_of_week, 'Wednesdayss' day_name, 1 day_of_month, "
        "1 day_of_year, 1 week_of_year, 1 month_number, 'x' month_name, 1 quarter_number, "
        "'Q10' quarter_name, 2024 year "
        "FROM VALUES (20240102, date'2024-01-02'), (20240102, NULL), (NULL, NULL) t(k, d)"
    )
    dim_symbol = spark.sql("SELECT 1 symbol_key, s symbol_code, 'n' company_name "
                           "FROM VALUES ('A'), ('A'), ('B') t(s)")
    fact = spark.sql(
        "SELECT k date_key, s symbol_code, 1 open_price, 1 high_price, 1 low_price, "
        "1 close_price, 1 volume FROM VALUES (20240102, 'A'), (20240102, 'A'), (20240102, 'A'), "
        "(20240105, 'Z'), (NULL, 'B') t(k, s)"
    )
    violations = {k: v for k, v in by_check(audit(staging, dim_date, dim_symbol, fact)).items() if v}
    assert violations == {
        ("stock_prices", "symbol not null"): 1,
        ("stock_prices", "symbol length"): 1,
        ("stock_prices", "open_price range"): 3,
        ("stock_prices", "high range"): 3,
        ("dim_date", "date_key not null"): 1,
        ("dim_date", "full_date not null"): 2,
        ("dim_date", "day_name length"): 3,
        ("dim_date", "quarter_name length"): 3,
        ("dim_date", "date_key unique"): 1,
        ("dim_symbol", "symbol_code unique"): 1,
        ("fact_stock_prices", "date_key not null"): 1,
        ("fact_stock_prices", "date_key, symbol_code unique"): 2,
        ("fact_stock_prices", "date_key known"): 1,
        ("fact_stock_prices", "symbol_code known"): 1,
    }


def test_kept_counts_equal_the_full_audit(spark, warehouse, monkeypatch):
    """Three loads, with violations in some months; only months that were loaded are read."""
    read = []
    source = Warehouse.fact_source
    monkeypatch.setattr(
        Warehouse, "fact_source", lambda self, months=None: read.append(months) or source(self, months)
    )

    def equal():
        read.clear()
        kept = by_check(audit_tables(warehouse))
        assert kept == by_check(audit_tables(warehouse, full=True))
        return [m for months in read for m in months], {k: v for k, v in kept.items() if v}

    def load(*rows, days=True):
        load_staging(warehouse, raw(spark, *rows))
        if days:
            load_dimensions(warehouse)
        fact = "SELECT date_key, symbol_code, open_price, 0.0 high_price, 0.0 low_price, 0.0 close_price, volume"
        staged = spark.sql(
            f"{fact} FROM (SELECT cast(date_format(date, 'yyyyMMdd') as int) date_key, symbol symbol_code, "
            f"open_price, volume FROM {warehouse.staging})"
        )
        warehouse.upsert_fact(staged)

    load(row("2024-01-02", "A"), row("2024-02-02", "A"))
    assert equal() == ([202401, 202402], {})
    assert equal() == ([], {})
    load(row("2024-03-02", "B"), row("2024-03-03", "B"), days=False)
    months, found = equal()
    assert months == [202403]
    orphans = {("fact_stock_prices", "date_key known"): 2, ("fact_stock_prices", "symbol_code known"): 2}
    assert found == orphans
    assert equal() == ([], orphans)
    load(row("2024-02-03", "A"))
    assert equal() == ([202402, 202403], orphans)
    load_staging(warehouse, raw(spark, row("2024-03-02", "B")))
    load_dimensions(warehouse)
    assert equal() == ([202403], {("fact_stock_prices", "date_key known"): 1})
    # What is kept is only ever a short cut.
    Path(warehouse.root, "storage/fact_files/_audit/months.json").write_text("{")
    assert len(equal()[0]) == 3
