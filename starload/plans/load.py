"""The daily load, step by step, and all steps in order.

Every step can be run again: staging is replaced, dimensions ignore what they know, the
fact is upserted. A failed step stops the load; running it again repairs it.
"""

from __future__ import annotations

import datetime as dt
import logging
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starload.operators.audit import FACT_TABLE, KNOWN, audit, audit_fact, audit_inputs, fact_checks
from starload.operators.dims import (
    named_symbols,
    new_dates,
    number_symbols,
    staged_symbols,
    unknown_symbols,
)
from starload.operators.facts import build_fact
from starload.operators.merge import latest_per_key
from starload.operators.staging import quarantine, to_staging
from starload.plans.warehouse import MONTH, ROWS_PER_FILE, Upserted, Warehouse
from starload.schemas import VERSION, names
from starload.session import observed, stamp, stored
from starload.sources.payloads import (
    explode_series,
    parse_payloads,
    read_landing,
    require_usable,
    split_payloads,
)
from starload.sources.prices_csv import by_symbol_and_day, read_csv, read_csv_judged, write_csv

logger = logging.getLogger(__name__)


class LoadCounts(NamedTuple):
    """How many documents and rows each step took and left, observed while they were written.

    Rows that were read are staged or rejected, staged ones of the symbols become inserted,
    replaced or late. What nobody counted is zero: a stream hands rows on without a CSV file.
    """

    documents: int = 0
    rejected_documents: int = 0
    extracted_rows: int = 0
    read_rows: int = 0
    rejected_rows: int = 0
    staged_rows: int = 0
    inserted_rows: int = 0
    replaced_rows: int = 0
    late_rows: int = 0


class LoadReport(NamedTuple):
    csv_path: str
    staged_rows: int
    fact_rows: int
    counts: LoadCounts = LoadCounts()


class AuditError(ValueError):
    """The load would break promises of the data model; nothing was written to the fact."""


def rejects_path(rejects: str, kind: str, run_date: dt.date, name: str) -> str:
    """Where a run puts what it sets aside: a folder of its own, so that no run overwrites
    what another has found."""
    return f"{rejects.rstrip('/')}/{kind}/run_date={run_date:%Y%m%d}/run={name}"


def last_landed(rows: DataFrame) -> DataFrame:
    """Of each day of a symbol the row of the document that landed last: on the latest landing
    day, and there by the time of its file.

    The rows are laid out for the files by ranges of symbol and day, where all rows of a day
    meet: one shuffle serves both.
    """
    order = [F.col(c) for c in [*names(VERSION), "file"]]
    return latest_per_key(by_symbol_and_day(rows), ["symbol", "timestamp"], order)


def extract(
    spark: SparkSession,
    landing: str,
    csv_root: str,
    run_date: dt.date,
    symbols: list[str] | None = None,
    packed: bool = False,
    rejects: str | None = None,
    name: str | None = None,
) -> str:
    """The documents that landed on the day -> CSV files of this run; returns their folder.

    Where several documents bring a day of a symbol, the last landed wins. One unusable
    document fails the step, unless there is a `rejects` folder: then those documents are
    reported there and the others go on.
    """
    return extract_counted(spark, landing, csv_root, run_date, symbols, packed, rejects, name)[0]


def extract_counted(
    spark: SparkSession,
    landing: str,
    csv_root: str,
    run_date: dt.date,
    symbols: list[str] | None = None,
    packed: bool = False,
    rejects: str | None = None,
    name: str | None = None,
) -> tuple[str, LoadCounts]:
    """The same, with the counts of documents and rows."""
    name = name or stamp()
    parsed = parse_payloads(read_landing(spark, landing, run_date, symbols, packed))
    aside = rejects and rejects_path(rejects, "documents", run_date, name)
    usable, counts = usable_documents(parsed, aside)
    written = Observation()
    rows = last_landed(explode_series(usable))
    path = write_csv(rows, csv_root, run_date, name, laid_out=True, written=written)
    return path, counts._replace(extracted_rows=written.get["rows"])


def usable_documents(
    parsed: DataFrame, aside: str | None, again: bool = False
) -> tuple[DataFrame, LoadCounts]:
    """The usable ones of judged documents, and the counts of documents.

    The others fail the job, or go to the folder `aside`, which must be new, unless this load
    may happen `again`. The documents are written once for that, so each text is parsed once,
    however often its rows are read from then on.
    """
    judged = Observation()
    good, bad = split_payloads(parsed if aside else require_usable(parsed), judged)
    if aside:
        bad.write.mode("overwrite" if again else "errorifexists").parquet(aside)
    found = judged.get
    return good, LoadCounts(documents=found["rows"], rejected_documents=found["rejected"])


def load_staging(
    warehouse: Warehouse, rows: DataFrame, rejects: str | None = None, again: bool = False
) -> int:
    """Replace the staging table by text rows, typed; returns the row count.

    One bad row fails the step and leaves the table as it was, unless there is a folder for
    `rejects`: then the bad rows go there, as text with the reason, and the others are
    staged. The folder must be new, unless this load may happen `again`. A load without
    rows empties the table with a warning.
    """
    return load_staging_counted(warehouse, rows, rejects, again).staged_rows


def load_staging_counted(
    warehouse: Warehouse, rows: DataFrame, rejects: str | None = None, again: bool = False
) -> LoadCounts:
    """The same, returning the counts of rows that were read, rejected and staged."""
    read, rejected = Observation(), Observation()
    if rejects is None:
        typed = to_staging(observed(rows, read), versioned=True)
    else:
        typed, bad = quarantine(rows, read, versioned=True)
        bad = observed(bad, rejected)
        bad.write.mode("overwrite" if again else "errorifexists").parquet(rejects)
    staged = warehouse.replace_staging(typed)
    if staged == 0:
        logger.warning("the input had no rows; %s is now empty", warehouse.staging)
    elif logger.isEnabledFor(logging.DEBUG):
        logger.debug("first staged row: %s", warehouse.read(warehouse.staging).first())
    return LoadCounts(
        read_rows=read.get["rows"], rejected_rows=rejected.get["rows"] if rejects else 0,
        staged_rows=staged,
    )


def load_dimensions(
    warehouse: Warehouse, symbols: list[str] | None = None, with_calendar: bool = False
) -> None:
    """Append unknown days, of all staged symbols, and unknown symbols.

    Named symbols are added whether staged or not; without names all staged ones are. What is
    new is stored first: staging is read once for it, and if there is nothing, no empty file
    is appended.
    """
    staging = warehouse.read(warehouse.staging)
    known_dates = warehouse.read(warehouse.dim_date)
    dates = stored(new_dates(known_dates, staging, with_calendar), "new_dates")
    if not dates.isEmpty():
        warehouse.append(warehouse.dim_date, dates)
    codes = staged_symbols(staging) if symbols is None else named_symbols(warehouse.spark, symbols)
    known = warehouse.read(warehouse.dim_symbol)
    unknown = stored(unknown_symbols(known, codes), "new_symbols")
    if not unknown.isEmpty():
        warehouse.append(warehouse.dim_symbol, number_symbols(known, unknown))


def _staged_fact(warehouse: Warehouse, symbols: list[str] | None) -> DataFrame:
    warehouse.require(warehouse.staging)
    return build_fact(warehouse.staged(), warehouse.read(warehouse.dim_date), symbols)


def load_fact(
    warehouse: Warehouse, symbols: list[str] | None = None, rows_per_file: int = ROWS_PER_FILE
) -> int:
    """Upsert the staged rows of the symbols, or of all; returns how many there were."""
    return load_fact_counted(warehouse, symbols, rows_per_file).rows


def load_fact_counted(
    warehouse: Warehouse, symbols: list[str] | None = None, rows_per_file: int = ROWS_PER_FILE
) -> Upserted:
    """The same, returning what became of the rows."""
    return warehouse.upsert_fact_counted(_staged_fact(warehouse, symbols), rows_per_file)


def audit_tables(warehouse: Warehouse, full: bool = False) -> DataFrame:
    """The violations in the four tables, by check; see starload.operators.audit.

    The fact's violations are counted by month and kept: an audit reads only the months that were
    loaded since the last one. `full` reads all, and keeps nothing.
    """
    inputs = [
        warehouse.read(t) for t in (warehouse.staging, warehouse.dim_date, warehouse.dim_symbol)
    ]
    if full:
        return audit(*inputs, warehouse.read(warehouse.fact))
    return audit_inputs(*inputs).unionByName(_kept_fact_audit(warehouse))


def _kept_fact_audit(warehouse: Warehouse) -> DataFrame:
    """The fact's part of the audit, from kept counts where they hold.

    Those of a month hold as long as the same load holds the month. Values that a dimension does
    not know may have come to be known since, so such a month is read again once the dimensions
    have grown; if they have shrunk, which no load does, all are.
    """
    dim_date, dim_symbol = warehouse.read(warehouse.dim_date), warehouse.read(warehouse.dim_symbol)
    sizes = [dim_date.count(), dim_symbol.count()]
    live, kept = warehouse.live_months(), warehouse.kept_audit()
    before = kept.get("dimensions", sizes)
    shrunk = any(now < then for now, then in zip(sizes, before, strict=True))

    def holds(month: int) -> bool:
        own = kept.get("months", {}).get(str(month))
        if own is None or own["load"] != live[month].load or shrunk:
            return False
        orphans = any(n for check, n in own["violations"].items() if check.endswith(KNOWN))
        return sizes == before or not orphans

    months = {str(m): kept["months"][str(m)] for m in live if holds(m)}
    changed = [m for m in sorted(live) if str(m) not in months]
    if changed:
        found = audit_fact(warehouse.fact_source(changed), dim_date, dim_symbol, (MONTH,))
        for row in found.collect():
            own = months.setdefault(str(row[MONTH]), {"load": live[row[MONTH]].load, "violations": {}})
            own["violations"][row["check_name"]] = row["violations"]
    if changed or sizes != before or len(months) != len(kept.get("months", {})):
        warehouse.keep_audit({"dimensions": sizes, "months": months})
    totals = [
        (check, FACT_TABLE, sum(m["violations"][check] for m in months.values()))
        for check in fact_checks()
    ]
    return warehouse.spark.createDataFrame(
        totals, "check_name STRING, table_name STRING, violations BIGINT"
    )


def require_sound(warehouse: Warehouse, symbols: list[str] | None = None) -> None:
    """Fail if staging, the dimensions or the fact rows about to be loaded break a promise.

    The fact itself is not read: it has passed this gate load by load.
    """
    tables = [warehouse.read(t) for t in (warehouse.staging, warehouse.dim_date, warehouse.dim_symbol)]
    found = audit(*tables, _staged_fact(warehouse, symbols)).filter("violations > 0")
    broken = [f"{r.table_name}: {r.check_name} ({r.violations})" for r in found.collect()]
    if broken:
        raise AuditError("; ".join(broken))


def run(
    spark: SparkSession,
    landing: str,
    csv_root: str,
    warehouse: Warehouse,
    run_date: dt.date,
    symbols: list[str] | None = None,
    packed: bool = False,
    rejects: str | None = None,
    with_calendar: bool = False,
    check: bool = True,
    rows_per_file: int = ROWS_PER_FILE,
    keep: dt.timedelta = dt.timedelta(days=7),
) -> LoadReport:
    """Documents of the day -> CSV -> staging -> dimensions -> fact, for the named symbols or
    for all.

    Exactly what this run extracted is staged. Its rows count as landed on the day of the run, at
    the time of the run: running an old day again changes nothing that later days brought.
    `check` audits the load before the fact is written. Versions of staging and fact that were
    replaced longer than `keep` ago go.
    """
    if symbols is not None and not symbols:
        raise ValueError("no symbol to load")
    name, started = stamp(), dt.datetime.now(dt.UTC)
    csv_path, extracted = extract_counted(
        spark, landing, csv_root, run_date, symbols, packed, rejects, name
    )
    warehouse.create()
    aside = rejects and rejects_path(rejects, "rows", run_date, name)
    rows = read_csv_judged(spark, csv_path) if rejects else read_csv(spark, csv_path)
    day = run_date.year * 10000 + run_date.month * 100 + run_date.day
    rows = rows.withColumns({"landed": F.lit(day), "landed_at": F.lit(started)})
    staged = load_staging_counted(warehouse, rows, aside)
    load_dimensions(warehouse, symbols, with_calendar)
    if check:
        require_sound(warehouse, symbols)
    loaded = load_fact_counted(warehouse, symbols, rows_per_file)
    warehouse.remove_old(keep)
    counts = all_counts(extracted, staged, loaded)
    logger.info("%s", counts)
    return LoadReport(csv_path, staged.staged_rows, loaded.rows, counts)


def all_counts(documents: LoadCounts, staged: LoadCounts, loaded: Upserted) -> LoadCounts:
    """What the steps counted, put together."""
    return LoadCounts(
        *[a + b for a, b in zip(documents, staged, strict=True)][:-3], *loaded
    )
