"""The interchange CSV files: `<path>/extract_date=YYYYMMDD/run=<run>/*.csv`.

A run writes a folder of its own, which is handed on to the load and never changes again. A
reader of a whole day takes, for each symbol, the rows of the latest run that wrote it.
"""

from __future__ import annotations

import csv
import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starload.schemas import CSV_COLUMNS, CSV_SCHEMA
from starload.session import first_line, observed, stamp

# Quotes are doubled, as most writers do, and blanks are kept: text arrives as it was.
_FORMAT = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
RAGGED = "ragged line"
_HEADERS_AT_ONCE = 32


def day_path(path: str, run_date: dt.date) -> str:
    return f"{path.rstrip('/')}/extract_date={run_date:%Y%m%d}"


def by_symbol_and_day(rows: DataFrame) -> DataFrame:
    """Rows laid out by ranges of symbol and day: few symbols in a file, and a symbol that
    holds a large share of all rows cut into several ranges."""
    return rows.repartitionByRange("symbol", "timestamp")


def write_csv(
    rows: DataFrame,
    path: str,
    run_date: dt.date,
    run: str | None = None,
    laid_out: bool = False,
    written: Observation | None = None,
) -> str:
    """Write the files of one run and return their folder, for the load that follows.

    Files ascend by symbol and day. Their number follows from the size of the data, not from
    the number of symbols. Rows that are `laid_out` already are not shuffled again. `written`
    observes how many `rows` there are.
    """
    target = f"{day_path(path, run_date)}/run={run or stamp()}"
    rows = rows if laid_out else by_symbol_and_day(rows)
    files = rows.select(*CSV_COLUMNS).sortWithinPartitions("symbol", "timestamp")
    observed(files, written).write.csv(target, **_FORMAT)
    return target


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Files that write_csv wrote. A different header or a ragged line fails the job."""
    return (
        spark.read.schema(CSV_SCHEMA)
        .csv(path, mode="FAILFAST", enforceSchema=False, **_FORMAT)
        .select(*CSV_COLUMNS)
    )


def read_csv_judged(spark: SparkSession, path: str) -> DataFrame:
    """The same, but ragged lines come along: `reason` says so, their text is `timestamp`."""
    rows = spark.read.schema(f"{CSV_SCHEMA}, `_broken` STRING").csv(
        path, mode="PERMISSIVE", enforceSchema=False, columnNameOfCorruptRecord="_broken", **_FORMAT
    )
    ragged = F.col("_broken").isNotNull()
    columns = [F.when(~ragged, F.col(c)).alias(c) for c in CSV_COLUMNS[1:]]
    return rows.select(
        F.coalesce("_broken", "timestamp").alias("timestamp"), *columns,
        F.when(ragged, RAGGED).alias("reason"),
    )


def read_csv_day(spark: SparkSession, path: str, run_date: dt.date) -> DataFrame:
    """All runs of a day: of each symbol what its latest run wrote."""
    rows = spark.read.schema(f"{CSV_SCHEMA}, run STRING").csv(
        day_path(path, run_date), mode="FAILFAST", enforceSchema=False, **_FORMAT
    )
    # A row for each symbol; the planner sees how many there are.
    latest = rows.groupBy(F.col("symbol").alias("its_symbol")).agg(F.max("run").alias("its_run"))
    same = F.col("symbol").eqNullSafe(F.col("its_symbol")) & (F.col("run") == F.col("its_run"))
    return rows.join(latest, same, "left_semi").select(*CSV_COLUMNS)


def header_of(line: str | None, path: str) -> tuple[str, ...]:
    """The column names of a header line, which must hold all of ours, once each."""
    if line is None:
        raise ValueError(f"{path} has no header")
    names = tuple(next(csv.reader([line.removeprefix("\ufeff")]), ()))
    missing = [c for c in CSV_COLUMNS if c not in names]
    repeated = [c for c in CSV_COLUMNS if names.count(c) > 1]
    if missing or repeated:
        found = f"has no column {missing[0]}" if missing else f"has two columns {repeated[0]}"
        raise ValueError(f"{path} {found}")
    return names


def files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files below a path, listed as Spark does, by their header lines.

    Only the first line of each file is read, by many threads of the driver, as reading all text
    for it would cost as much as the load. The driver holds a name for each file, as it does in
    any scan.
    """
    files = sorted(spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(_HEADERS_AT_ONCE) as threads:
        lines = list(threads.map(lambda file: first_line(spark, file), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines, strict=True):
        groups.setdefault(header_of(line, file), []).append(file)
    return groups


def read_foreign_csv(spark: SparkSession, path: str) -> DataFrame:
    """Files from elsewhere: in each one columns are found by its own header, in any order.

    More columns are ignored. A file without a header or without one of our columns fails before
    anything is read, a line that has not as many fields as its file's header fails the job. Files
    with equal headers are read together. A header must not go on over a line break. A folder
    without files has no rows.
    """
    found = None
    for header, files in files_by_header(spark, path).items():
        # What is not ours may have any name, also twice; all fields are read, so that lines that
        # are too short or too long are seen.
        names = [c if c in CSV_COLUMNS else f"_other{i}" for i, c in enumerate(header)]
        schema = ", ".join(f"`{name}` STRING" for name in names)
        reader = spark.read.schema(schema).option("columnPruning", False)
        rows = reader.csv(files, mode="FAILFAST", enforceSchema=True, **_FORMAT)
        rows = rows.select(*CSV_COLUMNS)
        found = rows if found is None else found.unionByName(rows)
    return spark.createDataFrame([], CSV_SCHEMA) if found is None else found
