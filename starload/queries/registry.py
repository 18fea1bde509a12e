"""name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.dates import calendar_attributes
from starload.operators.audit import audit
from starload.operators.dims import (
    build_dim_date,
    named_symbols,
    new_symbols,
    pad_dim_date,
    staged_symbols,
)
from starload.operators.facts import build_fact
from starload.operators.merge import duplicate_keys, insert_ignore, upsert
from starload.operators.reports import first_rows, row_count
from starload.operators.staging import quarantine, to_staging
from starload.plans.load import load_dimensions, load_fact, load_staging, run
from starload.plans.warehouse import Warehouse, save_distributed
from starload.queries.bars import (
    bars,
    first_batch,
    land,
    payloads,
    raw_bars,
    second_batch,
)
from starload.schemas import CSV_COLUMNS, DIM_SYMBOL, FACT_KEY, names
from starload.session import scratch_dir, stored
from starload.sources.payloads import (
    explode_series,
    landed_documents,
    parse_payloads,
    read_landing,
    require_usable,
    split_payloads,
)
from starload.sources.prices_csv import (
    read_csv,
    read_csv_day,
    read_csv_judged,
    read_foreign_csv,
    write_csv,
)
from starload.streaming.ingest import ingest

RUN_DATE = dt.date(2024, 1, 5)
Query = Callable[[SparkSession, str], DataFrame]


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(bars(spark, sf_dir), "staging")


def _star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Staging and date dimension as tables, as the fact load finds them."""
    staging = _staged(spark, sf_dir)
    return staging, stored(build_dim_date(staging), "dim_date")


@contextmanager
def scratch_warehouse(spark: SparkSession) -> Iterator[Warehouse]:
    """A warehouse of its own for one query run, taken out of the catalog at the end."""
    root = scratch_dir(spark, "warehouse")
    warehouse = Warehouse(spark, root, prefix=f"w{root[-12:]}_")
    warehouse.create()
    try:
        yield warehouse
    finally:
        warehouse.drop()


def _load(warehouse: Warehouse, *batches: DataFrame) -> None:
    """Load staging-shaped batches in turn."""
    for batch in batches:
        load_staging(warehouse, raw_bars(batch))
        load_dimensions(warehouse)
        load_fact(warehouse)


# -- sources and staging


def staging_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_staging(raw_bars(bars(spark, sf_dir)))


def payload_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    stale = F.col("timestamp").startswith("1999")
    path = land(payloads(bars(spark, sf_dir), stale), scratch_dir(spark, "landing"), RUN_DATE)
    return to_staging(explode_series(require_usable(parse_payloads(read_landing(spark, path)))))


def payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of some symbols and years are spoilt, or joined with another document, a copy,
    or text that does not belong to them; the rejects are counted by reason."""
    payload = F.col("payload")
    spoilt = (
        F.when(F.col("year") == "1996", '{"Note": "call limit reached"}')
        .when(F.col("symbol") == "Brand#13", "<html></html>")
        .when(F.col("year") == "1998", '{"Time Series (Daily)": {}}')
        .when(F.col("symbol") == "Brand#22", F.expr("left(payload, length(payload) - 1)"))
        .when(F.col("symbol") == "Brand#23", F.concat(payload, payload))
        .when(F.col("symbol") == "Brand#24", F.concat(payload, F.lit("\n"), payload))
        .when(F.col("symbol") == "Brand#25", F.concat(payload, F.lit(", "), payload))
        .when(F.col("symbol") == "Brand#11", F.concat(payload, F.lit(" trailing")))
        .when(F.col("symbol") == "Brand#12", F.concat(payload, F.lit("], [1")))
        .otherwise(F.concat(payload, F.lit(" \n ")))
    )
    documents = payloads(bars(spark, sf_dir)).withColumn("payload", spoilt)
    path = land(documents, scratch_dir(spark, "landing"), RUN_DATE)
    _, rejects = split_payloads(parse_payloads(read_landing(spark, path)))
    return rejects.groupBy("symbol", "reason").agg(F.count(F.lit(1)).alias("payloads"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_bars(bars(spark, sf_dir))
    return to_staging(read_csv(spark, write_csv(rows, scratch_dir(spark, "csv"), RUN_DATE)))


def csv_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day's files, then a later run of the day that brings some symbols again, with the
    second batch only: a reader of the day takes those from it and the others from before."""
    staging, root = _staged(spark, sf_dir), scratch_dir(spark, "csv")
    write_csv(raw_bars(staging), root, RUN_DATE)
    write_csv(raw_bars(second_batch(staging).filter(F.col("symbol") < "Brand#2")), root, RUN_DATE)
    return to_staging(read_csv_day(spark, root, RUN_DATE))


def csv_ragged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of some symbols have lost or won a field; what is set aside, by reason."""
    path, rejects = scratch_dir(spark, "ragged"), scratch_dir(spark, "rejects")
    fields = F.concat_ws(",", *CSV_COLUMNS)
    line = (
        F.when(F.col("symbol") == "Brand#11", F.substring_index(fields, ",", 4))
        .when(F.col("symbol") == "Brand#12", F.concat(fields, F.lit(",more")))
        .otherwise(fields)
    )
    # A file for each symbol, as its service would send it; a symbol has a line for each day.
    lines = raw_bars(bars(spark, sf_dir)).groupBy("symbol").agg(F.collect_list(line).alias("lines"))
    header = F.lit(",".join(CSV_COLUMNS))
    files = lines.select(F.concat_ws("\n", header, F.array_join("lines", "\n")).alias("file"))
    files.write.option("maxRecordsPerFile", 1).text(path)
    with scratch_warehouse(spark) as warehouse:
        load_staging(warehouse, read_csv_judged(spark, path), rejects)
        kept = row_count(warehouse.read(warehouse.staging)).select(
            F.lit("staged").alias("reason"), F.col("row_count").alias("lines")
        )
        aside = spark.read.parquet(rejects).groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))
        return stored(kept.unionByName(aside), "ragged")


def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of three writers in one folder, with other orders of columns and columns more."""
    path = scratch_dir(spark, "mixed_csv")
    rows = raw_bars(bars(spark, sf_dir)).withColumns({"currency": F.lit("USD"), "venue": F.lit("a,b")})
    symbol = F.col("symbol")
    writers = [
        (symbol < "Brand#14", CSV_COLUMNS, None),
        (symbol.between("Brand#14", "Brand#2"), sorted(rows.columns), "gzip"),
        (symbol > "Brand#2", ("venue", *reversed(CSV_COLUMNS)), None),
    ]
    for own, columns, compression in writers:
        rows.filter(own).select(*columns).write.csv(path, mode="append", header=True, compression=compression)
    return to_staging(read_foreign_csv(spark, path))


def csv_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of another writer: other column order, one column more."""
    path = scratch_dir(spark, "foreign_csv")
    rows = raw_bars(bars(spark, sf_dir)).withColumn("currency", F.lit("USD"))
    rows.select(*sorted(rows.columns)).write.csv(path, header=True)
    return to_staging(read_foreign_csv(spark, path))


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of some symbols are spoilt, and the days of one symbol come twice; the bad rows
    come back as text with the reason."""
    symbol = F.col("symbol")
    rows = raw_bars(bars(spark, sf_dir))
    rows = rows.unionByName(rows.filter(symbol == "Brand#22"))
    spoilt = rows.select(
        F.when(symbol == "Brand#11", F.substring("timestamp", 1, 4))
        .when(symbol != "Brand#21", F.col("timestamp"))
        .alias("timestamp"),
        F.when(symbol == "Brand#12", "1e").otherwise(F.col("open")).alias("open"),
        F.when(symbol == "Brand#13", "999999.99995").otherwise(F.col("high")).alias("high"),
        "low",
        "close",
        F.when(symbol == "Brand#14", F.concat("volume", F.lit(".5")))
        .otherwise(F.col("volume"))
        .alias("volume"),
        F.when(symbol == "Brand#15", "Brand#15-long")
        .when(symbol != "Brand#16", symbol)
        .alias("symbol"),
    )
    return quarantine(spoilt)[1]


def quarantine_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that stay when one symbol has unreadable volumes and another none at all."""
    volume = (
        F.when(F.col("symbol") == "Brand#14", "n/a")
        .when(F.col("symbol") != "Brand#15", F.col("volume"))
    )
    return quarantine(raw_bars(bars(spark, sf_dir)).withColumn("volume", volume))[0]


def staging_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging table after two loads holds the second."""
    staging = _staged(spark, sf_dir)
    with scratch_warehouse(spark) as warehouse:
        for batch in (first_batch(staging), second_batch(staging)):
            load_staging(warehouse, raw_bars(batch))
        return stored(warehouse.read(warehouse.staging), "refreshed")


def empty_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows staging has after a load, and after another one without rows."""
    staging = bars(spark, sf_dir)
    with scratch_warehouse(spark) as warehouse:
        counts = []
        for step, batch in enumerate((staging, staging.filter("symbol = 'none'"))):
            load_staging(warehouse, raw_bars(batch))
            rows = row_count(warehouse.read(warehouse.staging))
            counts.append(stored(rows.withColumn("step", F.lit(step)), "count"))
        return counts[0].unionByName(counts[1])


def _from_staging(spark: SparkSession, sf_dir: str, report: Callable) -> DataFrame:
    """A report on the staging table after a load."""
    with scratch_warehouse(spark) as warehouse:
        load_staging(warehouse, raw_bars(bars(spark, sf_dir)))
        return stored(report(warehouse.read(warehouse.staging)), "report")


def staging_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_staging(spark, sf_dir, row_count)


def staging_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_staging(spark, sf_dir, first_rows)


def table_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables that the catalog lists after a load, each with its number of rows."""
    with scratch_warehouse(spark) as warehouse:
        _load(warehouse, bars(spark, sf_dir))
        counted = [
            warehouse.read(f"{warehouse.prefix}{schema}.{name}").select(
                F.lit(schema).alias("schema_name"), F.lit(name).alias("table_name")
            )
            for schema in ("staging", "public")
            for name in warehouse.tables(schema)
        ]
        rows = reduce(DataFrame.unionByName, counted).groupBy("schema_name", "table_name").count()
        return stored(rows.withColumnRenamed("count", "row_count"), "tables")


def table_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load finds of its tables when one was dropped and one never was: their rows, or why
    they cannot be used."""
    with scratch_warehouse(spark) as warehouse:
        _load(warehouse, bars(spark, sf_dir))
        spark.sql(f"DROP TABLE {warehouse.dim_symbol}")
        tables = [warehouse.staging, warehouse.dim_date, warehouse.dim_symbol, warehouse.fact]
        found = []
        for table in [*tables, f"{warehouse.prefix}public.dim_company"]:
            name, reason = table.removeprefix(warehouse.prefix), warehouse.missing(table)
            told = F.lit(reason and reason.replace(warehouse.prefix, "")).cast("string")
            rows = spark.range(0) if reason else warehouse.read(table)
            found.append(row_count(rows).select(F.lit(name).alias("table_name"), told.alias("reason"), "row_count"))
        return stored(reduce(DataFrame.unionByName, found), "tables")


def distributed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and symbols that both batches have: two tables hashed by symbol, joined on it and
    on the day without a shuffle."""
    staging = _staged(spark, sf_dir)
    with scratch_warehouse(spark) as warehouse:
        sides = []
        for name, batch in (("first", first_batch(staging)), ("second", second_batch(staging))):
            table = f"{warehouse.prefix}storage.{name}_batch"
            save_distributed(batch, table, ["symbol", "date"], 8)
            sides.append(spark.table(table))
        first, second = sides
        joined = first.join(second, ["symbol", "date"]).select(
            "symbol", "date", first["open_price"].alias("first_price"),
            second["open_price"].alias("second_price"),
        )
        return stored(joined, "joined")


# -- dimensions


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim_date(bars(spark, sf_dir))


def dim_date_full_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pad_dim_date(build_dim_date(bars(spark, sf_dir)))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributes = calendar_attributes(F.col("full_date"))
    days = build_dim_date(bars(spark, sf_dir))
    return days.select("date_key", *[c.alias(name) for name, c in attributes.items()])


def dim_date_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping loads; `batch` tells which one brought the row."""
    staging = _staged(spark, sf_dir)
    known = build_dim_date(first_batch(staging)).withColumn("batch", F.lit(1))
    new = build_dim_date(second_batch(staging)).withColumn("batch", F.lit(2))
    return known.unionByName(insert_ignore(known, new, ["date_key"]))


def _no_symbols(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "symbol_key INT, symbol_code STRING, company_name STRING")


def dim_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_symbols(_no_symbols(spark), staged_symbols(bars(spark, sf_dir)))


def dim_symbol_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols up to Brand#19 first, then all; known rows keep key and edited name."""
    staging = _staged(spark, sf_dir)
    early = staging.filter(F.col("symbol") < "Brand#2")
    known = new_symbols(_no_symbols(spark), staged_symbols(early))
    edited = F.when(F.col("symbol_code") == "Brand#12", "Twelve Ltd")
    known = known.withColumn("company_name", F.coalesce(edited, "company_name"))
    known = stored(known, "dim_symbol")
    return known.unionByName(new_symbols(known, staged_symbols(staging)))


def dim_symbol_requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two requested symbols, one of which no bar has; the rows of the others stay."""
    known = stored(dim_symbol(spark, sf_dir), "dim_symbol")
    requested = named_symbols(spark, ["Brand#12", "UNSEEN"])
    return known.unionByName(new_symbols(known, requested)).select(*names(DIM_SYMBOL))


def symbol_key_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What keys must be, whatever their order: unique, without gaps, new ones behind the old
    ones, and those unchanged."""
    staging = _staged(spark, sf_dir)
    early = staging.filter(F.col("symbol") < "Brand#2")
    known = stored(new_symbols(_no_symbols(spark), staged_symbols(early)), "dim_symbol")
    new = stored(new_symbols(known, staged_symbols(staging)), "new_symbols")
    all_keys = known.unionByName(new)
    old = known.alias("k").join(all_keys.alias("a"), "symbol_code")
    counts = all_keys.agg(
        F.count(F.lit(1)).alias("symbols"),
        F.count_distinct("symbol_code").alias("codes"),
        F.count_distinct("symbol_key").alias("keys"),
        F.min("symbol_key").alias("first_key"),
        F.max("symbol_key").alias("last_key"),
    )
    one = F.lit(1)
    return counts.select(
        "*",
        known.agg(F.max("symbol_key")).scalar().alias("last_known_key"),
        new.agg(F.min("symbol_key")).scalar().alias("first_new_key"),
        old.filter(F.col("k.symbol_key") == F.col("a.symbol_key")).agg(F.count(one)).scalar()
        .alias("unchanged"),
    )


# -- fact


def fact_one_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact(*_star(spark, sf_dir), symbols=["Brand#12"])


def fact_all_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact(*_star(spark, sf_dir))


def fact_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging, days = _star(spark, sf_dir)
    existing = build_fact(first_batch(staging), days)
    return upsert(existing, build_fact(second_batch(staging), days), FACT_KEY)


def fact_upsert_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads into warehouse tables; the second has no volume for the shared year."""
    staging = _staged(spark, sf_dir)
    year = F.year("date")
    second = second_batch(staging).withColumn("volume", F.when(year != 1999, F.col("volume")))
    with scratch_warehouse(spark) as warehouse:
        _load(warehouse, first_batch(staging), second)
        return stored(warehouse.read(warehouse.fact), "fact")


def fact_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some days of some symbols, read from a fact of two loads."""
    staging = _staged(spark, sf_dir)
    with scratch_warehouse(spark) as warehouse:
        _load(warehouse, first_batch(staging), second_batch(staging))
        days = dt.date(1998, 12, 15), dt.date(1999, 1, 14)
        return stored(warehouse.read_fact(*days, ["Brand#12", "Brand#21", "none"]), "range")


def fact_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of each month after two loads, without reading a file of the fact."""
    staging = _staged(spark, sf_dir)
    with scratch_warehouse(spark) as warehouse:
        _load(warehouse, first_batch(staging), second_batch(staging))
        warehouse.require_counts()
        return warehouse.count_fact()


def fact_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conflict report for a batch that brings 1999 twice."""
    staging, days = _star(spark, sf_dir)
    fact = build_fact(staging, days)
    again = fact.filter(F.col("date_key").between(19990101, 19991231))
    return duplicate_keys(fact.unionByName(again), FACT_KEY)


def constraint_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit over tables with planted violations of every kind."""
    staging, days = _star(spark, sf_dir)
    fact = build_fact(staging, days)
    symbol, code, month = F.col("symbol"), F.col("symbol_code"), F.col("month_number")

    def too_large(price: str, where: Column) -> Column:
        return F.col(price).cast("decimal(12,4)") + F.when(where, 1000000).otherwise(0)

    bad_staging = staging.select(
        "date",
        too_large("open_price", symbol == "Brand#15").alias("open_price"),
        too_large("high", symbol == "Brand#21").alias("high"),
        too_large("low", symbol == "Brand#22").alias("low"),
        too_large("close_price", symbol == "Brand#23").alias("close_price"),
        "volume",
        F.when(symbol == "Brand#14", "Brand#14-long").when(symbol != "Brand#13", symbol).alias("symbol"),
    )
    padded = pad_dim_date(days.filter(month != 12).unionByName(days.filter(month == 1)))
    bad_days = (
        padded.withColumn("full_date", F.when(month != 2, F.col("full_date")))
        .withColumn("date_key", F.when(month != 3, F.col("date_key")))
        .withColumn("day_name", F.when(month == 4, "a long day name"))
        .withColumn("month_name", F.when(month == 5, "a long month name"))
        .withColumn("quarter_name", F.when(month == 6, "Q12"))
    )
    symbols = staged_symbols(staging).filter(code != "Brand#25")
    long_name = F.repeat(F.lit("x"), F.when(code == "Brand#12", 256).otherwise(255))
    bad_symbols = symbols.unionByName(symbols.filter(code == "Brand#11")).select(
        F.lit(1).alias("symbol_key"),
        F.when(code == "Brand#16", "Brand#16-long").when(code != "Brand#17", code).alias("symbol_code"),
        long_name.alias("company_name"),
    )
    year = F.call_function("div", F.col("date_key"), F.lit(10000))
    again = fact.unionByName(fact.filter(year == 1999))
    bad_fact = again.select(
        F.when(~((year == 1997) & (code == "Brand#18")), F.col("date_key")).alias("date_key"),
        F.when((year == 1996) & (code == "Brand#19"), "Brand#19-long")
        .when(~((year == 1996) & (code == "Brand#20")), code).alias("symbol_code"),
        too_large("open_price", code == "Brand#1").alias("open_price"),
        too_large("high_price", code == "Brand#2").alias("high_price"),
        too_large("low_price", code == "Brand#3").alias("low_price"),
        too_large("close_price", code == "Brand#4").alias("close_price"),
        "volume",
    )
    return audit(bad_staging, bad_days, bad_symbols, bad_fact)


# -- whole loads


def load_all_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents -> CSV -> staging -> dimensions -> fact, for all symbols in one run."""
    landing = land(payloads(bars(spark, sf_dir)), scratch_dir(spark, "landing"), RUN_DATE)
    with scratch_warehouse(spark) as warehouse:
        run(spark, landing, scratch_dir(spark, "csv"), warehouse, RUN_DATE)
        return stored(warehouse.read(warehouse.fact), "fact")


def load_two_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days in ordinary use: the documents of the second bring a year again, and all of
    its first document is repeated by another that landed before it."""
    staging = _staged(spark, sf_dir)
    landing, csv = scratch_dir(spark, "landing"), scratch_dir(spark, "csv")
    next_day = RUN_DATE + dt.timedelta(days=1)
    with scratch_warehouse(spark) as warehouse:
        land(payloads(first_batch(staging)), landing, RUN_DATE)
        run(spark, landing, csv, warehouse, RUN_DATE)
        land(payloads(staging.filter(F.year("date") == 1999)), landing, next_day)
        land(payloads(second_batch(staging)), landing, next_day)
        run(spark, landing, csv, warehouse, next_day)
        return stored(warehouse.read(warehouse.fact), "fact")


def load_old_day_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days, then the first once more: what the second brought stays."""
    staging = _staged(spark, sf_dir)
    landing, csv = scratch_dir(spark, "landing"), scratch_dir(spark, "csv")
    next_day = RUN_DATE + dt.timedelta(days=1)
    land(payloads(first_batch(staging)), landing, RUN_DATE)
    land(payloads(second_batch(staging)), landing, next_day)
    with scratch_warehouse(spark) as warehouse:
        for day in (RUN_DATE, next_day, RUN_DATE):
            run(spark, landing, csv, warehouse, day)
        return stored(warehouse.read(warehouse.fact), "fact")


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the steps of three runs counted: of the first days, of the days from 1999 on, and of
    1999 once more for a landing day before both. One symbol sends bad documents, another has too
    long a name."""
    staging = _staged(spark, sf_dir)
    landing, csv, rejects = (scratch_dir(spark, name) for name in ("landing", "csv", "rejects"))
    symbol = F.col("symbol")
    batches = [first_batch(staging), second_batch(staging), staging.filter(F.year("date") == 1999)]
    found = []
    with scratch_warehouse(spark) as warehouse:
        for load, (days, batch) in enumerate(zip((0, 1, -1), batches, strict=True)):
            documents = payloads(batch).select(
                F.when(symbol == "Brand#15", "Brand#15-long").otherwise(symbol).alias("symbol"),
                F.when(symbol == "Brand#13", "<html></html>").otherwise(F.col("payload")).alias("payload"),
            )
            day = RUN_DATE + dt.timedelta(days=days)
            land(documents, landing, day)
            counts = run(spark, landing, csv, warehouse, day, rejects=rejects).counts
            found += [(load, step, number) for step, number in counts._asdict().items()]
    return spark.createDataFrame(found, "load INT, step STRING, number BIGINT")


def input_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What has landed on three days, of which the last has no folder."""
    staging, landing = _staged(spark, sf_dir), scratch_dir(spark, "landing")
    days = [RUN_DATE + dt.timedelta(days=n) for n in range(3)]
    for day, batch in zip(days, (first_batch(staging), second_batch(staging)), strict=False):
        land(payloads(batch), landing, day)
    return landed_documents(spark, landing, days).drop("bytes")


def load_symbols_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two symbols in turn on one day; what staging holds after the second run."""
    landing = land(payloads(bars(spark, sf_dir)), scratch_dir(spark, "landing"), RUN_DATE)
    csv = scratch_dir(spark, "csv")
    with scratch_warehouse(spark) as warehouse:
        for symbol in ("Brand#12", "Brand#21"):
            run(spark, landing, csv, warehouse, RUN_DATE, [symbol])
        return stored(warehouse.read(warehouse.staging), "staging")


def incremental_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of documents, each picked up by one run of the stream."""
    staging = _staged(spark, sf_dir)
    landing, checkpoint = scratch_dir(spark, "landing"), scratch_dir(spark, "checkpoint")
    with scratch_warehouse(spark) as warehouse:
        for batch in (first_batch(staging), second_batch(staging)):
            land(payloads(batch), landing, RUN_DATE)
            ingest(spark, landing, warehouse, checkpoint).awaitTermination()
        return stored(warehouse.read(warehouse.fact), "fact")


def stream_late_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream finds the documents of a later landing day first. Those of the day before, which
    come late, bring what is missing, and win against nothing that landed after them."""
    staging = _staged(spark, sf_dir)
    landing, checkpoint = scratch_dir(spark, "landing"), scratch_dir(spark, "checkpoint")
    next_day = RUN_DATE + dt.timedelta(days=1)
    with scratch_warehouse(spark) as warehouse:
        for batch, day in ((second_batch(staging), next_day), (first_batch(staging), RUN_DATE)):
            land(payloads(batch), landing, day)
            ingest(spark, landing, warehouse, checkpoint).awaitTermination()
        return stored(warehouse.read(warehouse.fact), "fact")


def packed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many documents in a file, picked up by the stream."""
    landing, checkpoint = scratch_dir(spark, "landing"), scratch_dir(spark, "checkpoint")
    with scratch_warehouse(spark) as warehouse:
        land(payloads(bars(spark, sf_dir)), landing, RUN_DATE, packed=True)
        ingest(spark, landing, warehouse, checkpoint, packed=True).awaitTermination()
        return stored(warehouse.read(warehouse.fact), "fact")


def stream_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad documents of some symbols come first, good ones after them; what is loaded and what
    is set aside, by symbol."""
    documents = payloads(bars(spark, sf_dir))
    bad = documents.filter(F.col("symbol") < "Brand#2").withColumn("payload", F.lit("<html></html>"))
    landing, checkpoint = scratch_dir(spark, "landing"), scratch_dir(spark, "checkpoint")
    rejects = scratch_dir(spark, "rejects")
    with scratch_warehouse(spark) as warehouse:
        for drop in (bad, documents.filter(F.col("symbol") >= "Brand#2")):
            land(drop, landing, RUN_DATE)
            ingest(spark, landing, warehouse, checkpoint, rejects=rejects).awaitTermination()
        loaded = warehouse.read(warehouse.fact).groupBy(F.col("symbol_code").alias("symbol")).agg(
            F.count(F.lit(1)).alias("number")
        )
        aside = spark.read.parquet(f"{rejects}/documents").groupBy("symbol").agg(
            F.count(F.lit(1)).alias("number")
        )
        both = loaded.withColumn("kind", F.lit("fact rows")).unionByName(
            aside.withColumn("kind", F.lit("rejected documents"))
        )
        return stored(both, "loaded_and_rejected")


QUERIES: dict[str, Query] = {
    "staging_load": staging_load,
    "payload_roundtrip": payload_roundtrip,
    "payload_rejects": payload_rejects,
    "csv_roundtrip": csv_roundtrip,
    "csv_replace": csv_replace,
    "csv_by_name": csv_by_name,
    "csv_mixed_headers": csv_mixed_headers,
    "csv_ragged_lines": csv_ragged_lines,
    "quarantine_rows": quarantine_rows,
    "quarantine_kept": quarantine_kept,
    "staging_refresh": staging_refresh,
    "empty_refresh": empty_refresh,
    "staging_count": staging_count,
    "staging_peek": staging_peek,
    "table_list": table_list,
    "table_exists": table_exists,
    "input_exists": input_exists,
    "distributed_join": distributed_join,
    "dim_date": dim_date,
    "dim_date_full_ddl": dim_date_full_ddl,
    "dim_date_incremental": dim_date_incremental,
    "calendar_attributes": calendar,
    "dim_symbol": dim_symbol,
    "dim_symbol_incremental": dim_symbol_incremental,
    "dim_symbol_requested": dim_symbol_requested,
    "symbol_key_properties": symbol_key_properties,
    "fact_one_symbol": fact_one_symbol,
    "fact_all_symbols": fact_all_symbols,
    "fact_upsert": fact_upsert,
    "fact_upsert_nulls": fact_upsert_nulls,
    "fact_date_range": fact_date_range,
    "fact_count": fact_count,
    "fact_duplicate_keys": fact_duplicate_keys,
    "constraint_audit": constraint_audit,
    "load_all_steps": load_all_steps,
    "load_two_days": load_two_days,
    "load_old_day_again": load_old_day_again,
    "load_counts": load_counts,
    "load_symbols_apart": load_symbols_apart,
    "incremental_stream": incremental_stream,
    "stream_late_document": stream_late_document,
    "packed_stream": packed_stream,
    "stream_with_rejects": stream_with_rejects,
}
