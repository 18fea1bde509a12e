"""Input of the registered queries, derived from the given tables.

A bar is one day of one brand: brands stand for symbols, extended prices for prices,
quantities for volumes.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.dates import date_key
from starload.schemas import CSV_TO_STAGING, FIELDS, SERIES_KEY, STAGING, names


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging-shaped rows, one per day and brand.

    First and last price are those of the least and the greatest sale, packed into one number
    of order, line and price: it is aggregated by hash and combined before the shuffle, so a
    brand with most of the rows arrives as one row per task and day.
    """
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    price = F.col("l_extendedprice").cast("decimal(10,4)")
    packed = (
        F.col("l_orderkey").cast("decimal(17,0)") * F.lit(Decimal(10**20))
        + F.col("l_linenumber").cast("decimal(10,0)") * F.lit(Decimal(10**10))
        + (price * 10000).cast("decimal(10,0)")
    )
    sales = lineitem.join(part, lineitem["l_partkey"] == part["p_partkey"]).select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("p_brand").alias("symbol"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        "l_extendedprice",
        packed.cast("decimal(38,0)").alias("sale"),
    )

    def price_of(sale: Column) -> Column:
        return F.pmod(sale, F.lit(Decimal(10**10))) / 10000

    bar = {
        "open_price": price_of(F.min("sale")),
        "high": F.max("l_extendedprice"),
        "low": F.min("l_extendedprice"),
        "close_price": price_of(F.max("sale")),
        "volume": F.sum("quantity"),
    }
    # The casts come last, on one row per bar instead of on every sale.
    bar = {c.name: bar[c.name].cast(c.type) for c in STAGING if c.name in bar}
    return (
        sales.groupBy("date", "symbol")
        .agg(*[value.alias(name) for name, value in bar.items()])
        .select(*names(STAGING))
    )


def raw_bars(staging: DataFrame) -> DataFrame:
    """The bars as the text rows of a CSV file."""
    return staging.select(
        *[F.col(to).cast("string").alias(name) for name, to in CSV_TO_STAGING.items()]
    )


def before(year: int) -> Column:
    return date_key(F.col("date")) < year * 10000


def first_batch(staging: DataFrame) -> DataFrame:
    """Days before 2000."""
    return staging.filter(before(2000))


def second_batch(staging: DataFrame) -> DataFrame:
    """Days from 1999 on with other opening prices: overlaps the first batch by a year."""
    raised = (F.col("open_price") + 1).cast("decimal(10,4)")
    return staging.filter(~before(1999)).withColumn("open_price", raised)


def payloads(staging: DataFrame, stale: Column | None = None) -> DataFrame:
    """One document per symbol and year: symbol, year, payload.

    Days are unique within a symbol, so a group has 366 rows at most. Days for which `stale`
    holds are written twice, first with wrong values, as readers must take the last one.
    """
    fields = F.struct(
        *[F.col(name).alias(field) for field, name in FIELDS.items()]
    )
    day = F.concat(F.lit('"'), F.col("timestamp"), F.lit('": '))
    entry = F.concat(day, F.to_json(fields))
    if stale is not None:
        wrong = F.concat(day, F.lit('{"1. open": "0", "5. volume": "0"}, '))
        entry = F.concat(F.when(stale, wrong).otherwise(""), entry)
    documents = (
        raw_bars(staging)
        .withColumn("year", F.substring("timestamp", 1, 4))
        .groupBy("symbol", "year")
        .agg(F.array_join(F.collect_list(entry), ", ").alias("days"))
    )
    text = F.concat(F.lit(f'{{"{SERIES_KEY}": {{'), "days", F.lit("}}"))
    return documents.select("symbol", "year", text.alias("payload"))


def land(documents: DataFrame, path: str, run_date: dt.date, packed: bool = False) -> str:
    """Write the documents of a day below the folders of their symbols: a file for each, or
    `packed` on the lines of few files."""
    landed = documents.select("payload", F.lit(f"{run_date:%Y%m%d}").alias("landed"), "symbol")
    writer = landed.write.partitionBy("landed", "symbol").mode("append")
    (writer if packed else writer.option("maxRecordsPerFile", 1)).text(path)
    return path
