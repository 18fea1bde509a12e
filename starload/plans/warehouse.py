"""The tables, and how their contents are replaced without a moment of half-written data.

Parquet tables of the session catalog. Three rules make loads safe:

* Staging lies in a folder that is new for every load; the catalog is pointed at it when the
  job has ended.
* The fact is a view over the files of all loads. A month with more rows than fit one file is cut
  into slices by symbol. A load writes the slices it touches, whole, to a folder of its own,
  lists for every slice which load holds it, and then replaces the view by one over that list.
  This one statement publishes all of them at once: whoever reads sees all of a load or nothing,
  and files that a running query has planned on stay.
* The dimensions only ever grow by appended rows.

A load that dies, at any moment, leaves everything as it was but for files that nobody reads.
`remove_old` deletes those and replaced versions after a while.

One load at a time should run against a warehouse. Loads that run together nevertheless write
to folders of their own, and only the first of them is published: the others end in a
`LoadConflict` and can be run again.

Rows carry when their documents landed, in columns that only the files have. A load keeps the
later of two versions of a fact row, so old documents that come late, or once more, do no harm.
"""

from __future__ import annotations

import datetime as dt
import json
import math
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from starload.functions.dates import month_key
from starload.operators.merge import merge_tagged, tag_union
from starload.schemas import (
    DIM_DATE,
    DIM_SYMBOL,
    FACT,
    FACT_KEY,
    STAGING,
    VERSION,
    ddl,
    names,
    stored_ddl,
)
from starload.session import (
    claim,
    delete,
    folder_ages,
    observed,
    read_text,
    stamp,
    write_text,
)

MONTH = "month_key"
SLICE = "slice"
LOAD = "load"
# A month has no more slices, so that neither list nor view grow with the rows, and is written
# whole again once so many loads hold parts of it.
MAX_SLICES = 16
GROWTH = 1.5
MAX_LOADS = 8
# How large files get: a month is cut into so many that none has more rows. Only the layout
# depends on it, never a result; every load can set it.
ROWS_PER_FILE = 8_000_000
# How long a load may take over its last statement before it counts as dead.
PUBLISHING = dt.timedelta(minutes=10)
# What becomes of a key that a load brings.
FATE = "fate"


class LoadConflict(RuntimeError):
    """Another load was published meanwhile. Nothing has changed; run the load again."""


class Upserted(NamedTuple):
    """What became of the rows of a load: `late` ones were older than those they met."""

    inserted: int = 0
    replaced: int = 0
    late: int = 0

    @property
    def rows(self) -> int:
        return sum(self)


class MonthLayout(NamedTuple):
    """Where the rows of a month go: its parts, files that are numbered through all months, are
    dealt to its slices evenly. Of some months only some slices are written, of others all."""

    key: int
    parts: int
    first_part: int
    slices: int = 1
    written: tuple[int, ...] | None = None

    @property
    def pieces(self) -> int:
        """Parts of a slice."""
        return self.parts // (self.slices if self.written is None else len(self.written))


class LiveMonth(NamedTuple):
    """For each slice of a month the load that holds it, and how many rows it has."""

    slices: tuple[tuple[int, int], ...]

    @property
    def load(self) -> int:
        """The last load that changed the month."""
        return max(load for load, _ in self.slices)

    @property
    def rows(self) -> int:
        return sum(rows for _, rows in self.slices)

    def of_load(self) -> dict[int, list[int]]:
        """Load -> the slices that it holds."""
        found: dict[int, list[int]] = {}
        for number, (load, _) in enumerate(self.slices):
            found.setdefault(load, []).append(number)
        return found


class _Slices(NamedTuple):
    """Slices of a month that are to be written, of so many, and their rows."""

    slices: int
    written: tuple[int, ...]
    rows: int


def plan_layout(
    months: Sequence[tuple[int, int]],
    rows_per_file: int,
    parallelism: int,
    some: dict[int, _Slices] | None = None,
) -> tuple[list[MonthLayout], int]:
    """The layout of (month, rows) entries, and the number of tasks. Of the months in `some` only
    some slices are written, and `rows` are theirs.

    A month has as many parts as it needs files, so one with most of the rows becomes many
    tasks. Parts are numbered from the largest down and dealt to the tasks in turn; tasks
    that are fewer than the parts take several small ones.
    """
    some = some or {}
    parts, slices, written = {}, {}, {}
    for month, rows in months:
        own = some.get(month)
        # Slices are never quite even, and may grow by half before they are cut anew.
        files = math.ceil(rows / (GROWTH * rows_per_file if own else rows_per_file))
        slices[month] = own.slices if own else min(files, MAX_SLICES)
        written[month] = own.written if own else None
        least = len(own.written) if own else slices[month]
        parts[month] = math.ceil(files / least) * least
    layout = []
    first = 0
    for month, _ in sorted(months, key=lambda m: -m[1] / parts[m[0]]):
        layout.append(MonthLayout(month, parts[month], first, slices[month], written[month]))
        first += parts[month]
    enough = max(math.ceil(sum(rows for _, rows in months) / rows_per_file), parallelism)
    return layout, min(first, enough)


class Warehouse:
    """The table names below `root`; `prefix` tells several warehouses of a catalog apart."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        # Catalog and writer resolve a relative path against different folders.
        if not root.startswith("/") and ":/" not in root:
            raise ValueError(f"the root must be an absolute path, not {root}")
        if "'" in root:
            raise ValueError("the root must not hold a quote")
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self.staging = f"{prefix}staging.stock_prices"
        self.dim_date = f"{prefix}public.dim_date"
        self.dim_symbol = f"{prefix}public.dim_symbol"
        self.fact = f"{prefix}public.fact_stock_prices"
        self.fact_files = f"{prefix}storage.fact_files"

    def on(self, spark: SparkSession) -> Warehouse:
        """The same warehouse seen from another session, such as that of a micro-batch."""
        return Warehouse(spark, self.root, self.prefix)

    # -- definitions

    def create(self) -> None:
        """Create what is missing. Keys are not declared: Parquet tables enforce none.

        Only the catalog knows which copy of a month is live, so fact files of a table that
        is not in the catalog stop this instead of being taken for empty and overwritten.
        """
        for schema in ("staging", "public", "storage"):
            self.spark.sql(
                f"CREATE SCHEMA IF NOT EXISTS {self.prefix}{schema} "
                f"LOCATION '{self.root}/{schema}'"
            )
        if not self.spark.catalog.tableExists(self.fact):
            if folder_ages(self.spark, self._folder(self.fact_files)):
                raise ValueError(
                    f"{self._folder(self.fact_files)} holds a fact table that this catalog does "
                    "not know; use the catalog it was loaded with, or another root"
                )
        self._create_table(self.staging, ddl(STAGING), self._folder(self.staging, "load=0"))
        self._create_table(self.dim_date, ddl(DIM_DATE), self._folder(self.dim_date))
        self._create_table(self.dim_symbol, ddl(DIM_SYMBOL), self._folder(self.dim_symbol))
        # Without lengths: a view over varchar columns casts them, and no filter passes a cast.
        older = self.spark.catalog.tableExists(self.fact_files) and not {SLICE, *names(VERSION)} <= set(
            self.spark.table(self.fact_files).columns
        )
        if older:
            # From before there were versions and slices: its rows count as older than any others,
            # and a month as one slice, wherever its files lie.
            self.spark.sql(f"DROP TABLE {self.fact_files}")
        self._create_table(
            self.fact_files,
            f"{stored_ddl(FACT + VERSION)}, `{LOAD}` bigint, `{MONTH}` int, `{SLICE}` int",
            self._folder(self.fact_files), f"`{LOAD}`, `{MONTH}`, `{SLICE}`",
        )
        if not self.spark.catalog.tableExists(self.fact):
            self._publish(0, {})
        elif older:
            self._add_partitions(
                (own.load, month, 0, self._folder(self.fact_files, f"{LOAD}={own.load}", f"{MONTH}={month}"))
                for month, own in self.live_months().items()
            )
            self._publish(self._published(), self.live_months())

    def drop(self) -> None:
        """Take the tables out of the catalog; files stay."""
        for schema in ("public", "storage", "staging"):
            self.spark.sql(f"DROP SCHEMA IF EXISTS {self.prefix}{schema} CASCADE")

    def _create_table(self, table: str, columns: str, folder: str, partition: str = "") -> None:
        partitioned = f"PARTITIONED BY ({partition})" if partition else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING PARQUET "
            f"{partitioned} LOCATION '{folder}'"
        )

    def _folder(self, table: str, *parts: str) -> str:
        schema, name = table.removeprefix(self.prefix).split(".")
        return "/".join([self.root, schema, name, *parts])

    def tables(self, schema: str) -> list[str]:
        return sorted(t.name for t in self.spark.catalog.listTables(f"{self.prefix}{schema}"))

    def missing(self, table: str) -> str | None:
        """Why a table cannot be used, or nothing if it can."""
        if not self.spark.catalog.tableExists(table):
            return f"table {table} does not exist; create the warehouse first"
        return None

    def require(self, table: str) -> None:
        reason = self.missing(table)
        if reason:
            raise AnalysisException(reason)

    # -- reading

    def read(self, table: str) -> DataFrame:
        return self.spark.table(table).drop(MONTH)

    def read_fact(
        self,
        first_day: dt.date | None = None,
        last_day: dt.date | None = None,
        symbols: list[str] | None = None,
    ) -> DataFrame:
        """The fact rows of the days, both included, and of the symbols; by default of all.

        Days select the months whose files are opened at all; days and symbols, by which the
        files are sorted, the row groups that are read.
        """
        rows = self.spark.table(self.fact)
        for day, holds in ((first_day, "__ge__"), (last_day, "__le__")):
            if day is not None:
                key = day.year * 10000 + day.month * 100 + day.day
                rows = rows.filter(getattr(F.col(MONTH), holds)(key // 100))
                rows = rows.filter(getattr(F.col("date_key"), holds)(key))
        if symbols is not None:
            rows = rows.filter(F.col("symbol_code").isin(list(symbols)))
        return rows.drop(MONTH)

    def staged(self) -> DataFrame:
        """The staging table's rows with their versions."""
        folder = self._staging_folder()
        schema = stored_ddl(STAGING + VERSION)
        if not folder_ages(self.spark, folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder)

    def _staging_folder(self) -> str:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.staging}")
        return described.filter("col_name = 'Location'").first()["data_type"].rstrip("/")

    def count_fact(self) -> DataFrame:
        """month_key, row_count: from the list of live months, no file is read."""
        counted = [(month, own.rows) for month, own in sorted(self.live_months().items())]
        return self.spark.createDataFrame(counted, f"{MONTH} int, row_count bigint")

    def require_counts(self) -> None:
        """Fail if the live files do not hold as many rows as the list says. Only the files'
        footers are read."""
        months = self.live_months().items()
        listed = {(month, n): rows for month, own in months for n, (_, rows) in enumerate(own.slices) if rows}
        if self._footer_counts(self.fact_source()) != listed:
            raise ValueError(f"the files of {self.fact} do not hold the rows that were loaded")

    def kept_audit(self) -> dict:
        """What `keep_audit` was given last; nothing if that cannot be read."""
        folder = self._folder(self.fact_files, "_audit")
        if not folder_ages(self.spark, folder):
            return {}
        try:
            return json.loads(read_text(self.spark, f"{folder}/months.json"))
        except (Py4JJavaError, ValueError):
            return {}

    def keep_audit(self, found: dict) -> None:
        """Keep the violations of the live months: an entry for each month, at most twelve for
        each year of the calendar."""
        write_text(self.spark, self._folder(self.fact_files, "_audit", "months.json"), json.dumps(found))

    @staticmethod
    def _footer_counts(files: DataFrame) -> dict[tuple[int, int], int]:
        """Rows by month and slice: no column is read."""
        counts = files.groupBy(MONTH, SLICE).count().collect()
        return {(r[MONTH], r[SLICE]): r["count"] for r in counts}

    def fact_source(self, months: Sequence[int] | None = None) -> DataFrame:
        """The live files' rows, of the months or of all, with their versions and the columns
        `load`, `month_key` and `_metadata`."""
        live = self.live_months()
        return self._files_of(live if months is None else {m: live[m] for m in months if m in live})

    def _files_of(
        self, live: dict[int, LiveMonth], some: dict[int, _Slices] | None = None
    ) -> DataFrame:
        return self.spark.table(self.fact_files).filter(_live_filter(live, some))

    def live_months(self) -> dict[int, LiveMonth]:
        """Which load holds which slices of a month: at most twelve months for each year of the
        calendar, of `MAX_SLICES`."""
        load = self._published()
        if not load:
            return {}
        listed = json.loads(read_text(self.spark, self._list_of(load)))
        return {int(month): LiveMonth(_slices_of(own)) for month, own in listed.items()}

    def _list_of(self, load: int) -> str:
        return self._folder(self.fact_files, "_live", f"{load}.json")

    def _claim_load(self) -> int:
        """A number above those of all loads that there were, for one load alone."""
        known = [self._published()]
        for name, _ in folder_ages(self.spark, self._folder(self.fact_files)):
            if name.startswith(f"{LOAD}="):
                known.append(int(name.removeprefix(f"{LOAD}=")))
        load = max(known) + 1
        while not claim(self.spark, self._list_of(load)):
            load += 1
        return load

    @contextmanager
    def _publishing_after(self, base: int) -> Iterator[None]:
        """Let one load publish on top of `base`, and only if that is still what the fact shows.

        A mark that is there for as long as the statement takes keeps out others. If a driver
        dies just then, the mark counts no more after a while.
        """
        folder, name = self._folder(self.fact_files, "_live"), f"after-{base}"
        mark = f"{folder}/{name}"
        if not claim(self.spark, mark):
            age = dict(folder_ages(self.spark, folder)).get(name, PUBLISHING)
            if age < PUBLISHING:
                raise LoadConflict(f"another load of {self.fact} is being published")
            write_text(self.spark, mark, "")
        try:
            if self._published() != base:
                raise LoadConflict(f"another load of {self.fact} was published after load {base}")
            yield
        finally:
            delete(self.spark, mark)

    def _published(self) -> int:
        """The number of the load that the fact shows; 0 before the first."""
        properties = self.spark.sql(f"SHOW TBLPROPERTIES {self.fact}").collect()
        return int({r["key"]: r["value"] for r in properties}[f"starload.{LOAD}"])

    # -- writing

    def replace_staging(self, rows: DataFrame) -> int:
        """Full refresh; returns the row count, observed while writing. When rows landed, if they
        say so, is written beside the table's columns."""
        self.require(self.staging)
        target = self._folder(self.staging, f"{LOAD}={stamp()}")
        loaded = Observation()
        observed(rows.select(*names(STAGING), *_versions(rows)), loaded).write.parquet(target)
        self.spark.sql(f"ALTER TABLE {self.staging} SET LOCATION '{target}'")
        return loaded.get["rows"]

    def append(self, table: str, rows: DataFrame) -> None:
        """Append to a dimension."""
        self.require(table)
        rows.select(*self.spark.table(table).columns).write.insertInto(table)

    def upsert_fact(self, incoming: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> int:
        """Insert or replace fact rows by key, all or none; only the slices of months that
        `incoming` touches are read and written. Returns the number of incoming rows.

        A row that landed before the one it would replace is left out as late. Rows that do not
        say when they landed replace whatever they meet, and are replaced by whatever comes.
        """
        return self.upsert_fact_counted(incoming, rows_per_file).rows

    def upsert_fact_counted(
        self, incoming: DataFrame, rows_per_file: int = ROWS_PER_FILE
    ) -> Upserted:
        """The same, returning what became of the rows, observed while writing."""
        self.require(self.fact)
        incoming = incoming.withColumn(MONTH, month_key(F.col("date_key")))
        touched = _month_counts(incoming)
        if not touched:
            return Upserted()
        base, live, load = self._published(), self.live_months(), self._claim_load()
        some = self._touched_slices(incoming, touched, live, rows_per_file)
        sizes = [
            (m, some[m].rows if m in some else rows + (live[m].rows if m in live else 0))
            for m, rows in touched.items()
        ]
        layout, tasks = plan_layout(
            sizes, rows_per_file, self.spark.sparkContext.defaultParallelism, some
        )
        existing = self._files_of({m: live[m] for m in touched if m in live}, some).drop(LOAD, SLICE)
        outcome = Observation()
        merged = merge_months(existing, incoming, layout, tasks).observe(
            outcome, *[F.count_if(F.col(FATE) == fate).alias(fate) for fate in Upserted._fields]
        )
        written = self._write_load(load, merged.drop(FATE))
        months = dict(live)
        for month in layout:
            own = dict(enumerate(live[month.key].slices)) if month.written is not None else {}
            for number in range(month.slices) if month.written is None else month.written:
                own[number] = (load, written.get((month.key, number), 0))
            months[month.key] = LiveMonth(tuple(own[n] for n in range(month.slices)))
        with self._publishing_after(base):
            self._publish(load, months)
        return Upserted(**outcome.get)

    def _touched_slices(
        self, incoming: DataFrame, touched: dict[int, int], live: dict[int, LiveMonth], rows_per_file: int
    ) -> dict[int, _Slices]:
        """The months of which only some slices have to be written, and which.

        Such a month has several slices and room for the new rows in their files, and few loads
        hold it. All other months are written whole.
        """
        cut = {
            m: len(live[m].slices)
            for m, rows in touched.items()
            if m in live and len(live[m].slices) > 1 and len(live[m].of_load()) < MAX_LOADS
            and (live[m].rows + rows <= GROWTH * rows_per_file * len(live[m].slices) or len(live[m].slices) == MAX_SLICES)
        }
        if not cut:
            return {}
        # As many rows as there are months, and at most that times MAX_SLICES come back.
        known = self.spark.createDataFrame(list(cut.items()), f"{MONTH} INT, slices INT")
        met = incoming.join(F.broadcast(known), MONTH)
        counts = met.groupBy(MONTH, slice_of(F.col("slices")).alias(SLICE)).count().collect()
        found: dict[int, dict[int, int]] = {}
        for row in counts:
            found.setdefault(row[MONTH], {})[row[SLICE]] = row["count"]
        return {
            m: _Slices(
                cut[m], tuple(sorted(new)), sum(n + live[m].slices[s][1] for s, n in new.items())
            )
            for m, new in found.items()
            if len(new) < cut[m]
        }

    def _write_load(self, load: int, merged: DataFrame) -> dict[tuple[int, int], int]:
        """Write slices of months to the folder of the load, over what a load that died has left
        there, and tell the catalog; returns the rows of each."""
        folder = self._folder(self.fact_files, f"{LOAD}={load}")
        merged.write.partitionBy(MONTH, SLICE).mode("overwrite").parquet(folder)
        written = self._footer_counts(self.spark.read.schema(merged.schema).parquet(folder))
        self._add_partitions(
            (load, m, s, f"{folder}/{MONTH}={m}/{SLICE}={s}") for m, s in sorted(written)
        )
        return written

    def _add_partitions(self, places: Iterable[tuple[int, int, int, str]]) -> None:
        partitions = " ".join(
            f"PARTITION ({LOAD}={load}, {MONTH}={month}, {SLICE}={number}) LOCATION '{place}'"
            for load, month, number, place in places
        )
        if partitions:
            self.spark.sql(f"ALTER TABLE {self.fact_files} ADD IF NOT EXISTS {partitions}")

    def _publish(self, load: int, live: dict[int, LiveMonth]) -> None:
        """Show these months as the fact: the list is written, then one statement counts."""
        if load:
            listed = {month: own.slices for month, own in live.items()}
            write_text(self.spark, self._list_of(load), json.dumps(listed))
        columns = ", ".join(f"`{name}`" for name in [*names(FACT), MONTH])
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.fact} TBLPROPERTIES ('starload.{LOAD}' = '{load}') "
            f"AS SELECT {columns} FROM {self.fact_files} WHERE {_live_filter(live)}"
        )

    def remove_old(self, keep: dt.timedelta) -> int:
        """Delete versions of staging and fact, also such as a load that died has left, if they
        were replaced longer than `keep` ago; returns how many.

        A query that was planned on a version must end, or begin anew, within that time.
        """
        staging, fact = self._staging_folder(), self._folder(self.fact_files)
        needed = {load for own in self.live_months().values() for load in own.of_load()}
        needed.add(self._published())
        gone = 0
        for folder in (self._folder(self.staging), fact):
            live = {staging.rsplit("/", 1)[1], *[f"{LOAD}={load}" for load in needed]}
            for name, age in folder_ages(self.spark, folder):
                if name.startswith(f"{LOAD}=") and name not in live and age > keep:
                    if folder == fact:
                        number = name.removeprefix(f"{LOAD}=")
                        self.spark.sql(
                            f"ALTER TABLE {self.fact_files} DROP IF EXISTS PARTITION ({LOAD}={number})"
                        )
                        delete(self.spark, self._list_of(int(number)))
                    delete(self.spark, f"{folder}/{name}")
                    gone += 1
        lists = {f"{load}.json" for load in needed}
        for name, age in folder_ages(self.spark, f"{fact}/_live"):
            # Lists that were replaced, and claims of loads that died before they wrote anything.
            if name.endswith(".json") and name not in lists and age > max(keep, PUBLISHING):
                delete(self.spark, f"{fact}/_live/{name}")
        return gone


def _versions(rows: DataFrame) -> list[Column]:
    """The version columns of rows, null if they have none."""
    return [
        F.col(c.name) if c.name in rows.columns else F.lit(None).cast(c.type).alias(c.name)
        for c in VERSION
    ]


def _slices_of(listed: list) -> tuple[tuple[int, int], ...]:
    """The slices of a month in a list; before there were any it said load and rows."""
    if listed and isinstance(listed[0], int):
        listed = [listed]
    return tuple((load, rows) for load, rows in listed)


def slice_of(slices: Column) -> Column:
    """The slice of a row: a symbol has a handful of rows in a month, so slices are even."""
    return F.pmod(F.xxhash64("symbol_code"), slices).cast("int")


def _live_filter(live: dict[int, LiveMonth], some: dict[int, _Slices] | None = None) -> str:
    """The partitions of the files that count, as SQL; of the months in `some` only some slices.

    A month that one load holds is a number in a list, others have a clause for each load.
    """
    some = some or {}
    whole: dict[int, list[int]] = {}
    clauses = []
    for month, own in sorted(live.items()):
        held = own.of_load()
        if len(held) == 1 and month not in some:
            whole.setdefault(own.load, []).append(month)
            continue
        wanted = set(some[month].written) if month in some else set(range(len(own.slices)))
        for load, numbers in sorted(held.items()):
            if kept := [str(n) for n in numbers if n in wanted]:
                clauses.append(f"({LOAD} = {load} AND {MONTH} = {month} AND {SLICE} IN ({', '.join(kept)}))")
    for load, months in sorted(whole.items()):
        clauses.append(f"({LOAD} = {load} AND {MONTH} IN ({', '.join(map(str, months))}))")
    return " OR ".join(clauses) or "false"


def merge_months(
    existing: DataFrame, incoming: DataFrame, layout: Sequence[MonthLayout], tasks: int
) -> DataFrame:
    """Old and new rows of the touched slices, merged and laid out to be written, with the `fate`
    of each key.

    Rows are spread once, each to the part that its symbol is given, and merged where they
    land, as old and new row of a key meet there. Merging sorts the rows by symbol and day,
    and so the files stay: a reader of one symbol skips row groups.
    """
    plan = existing.sparkSession.createDataFrame(
        [(m.key, m.slices, m.pieces, m.first_part, m.written and list(m.written)) for m in layout],
        f"{MONTH} INT, slices INT, pieces INT, first_part INT, written ARRAY<INT>",
    )
    piece = F.pmod(F.xxhash64("symbol_code", F.lit(1)), F.col("pieces"))
    # The place of a slice among those that are written.
    place = F.when(F.col("written").isNull(), F.col(SLICE)).otherwise(
        F.array_position("written", F.col(SLICE)) - 1
    )
    part = F.col("first_part") + place * F.col("pieces") + piece
    old, new = (df.select(*names(FACT), *_versions(df), MONTH) for df in (existing, incoming))
    # The list has a row per calendar month, twelve for each year of a four-digit calendar
    # at most, however many rows the months have: safe to broadcast.
    spread = (
        tag_union(old, new)
        .join(F.broadcast(plan), MONTH)
        .withColumn(SLICE, slice_of(F.col("slices")))
        .withColumn("part", part.cast("int"))
        .drop("slices", "pieces", "first_part", "written")
        .repartitionById(tasks, "part")
    )
    by_symbol = [MONTH, SLICE, "part", "symbol_code", "date_key"]
    merged = merge_tagged(spread, by_symbol, names(VERSION), FATE).sortWithinPartitions(*by_symbol)
    return merged.select(*names(FACT + VERSION), MONTH, SLICE, FATE)


def _month_counts(incoming: DataFrame) -> dict[int, int]:
    """Month -> rows: at most twelve entries for each year of the calendar."""
    return {r[MONTH]: r["count"] for r in incoming.groupBy(MONTH).count().collect()}


def save_distributed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """Store `df` hashed by the first of the keys and sorted by all: tables with equal buckets
    join on the keys without a shuffle."""
    first, *_ = keys
    df.write.bucketBy(buckets, first).sortBy(*keys).mode("overwrite").saveAsTable(table)
