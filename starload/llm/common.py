"""What several of these operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def parallelism(spark: SparkSession) -> int:
    """Partitions that a shuffle of this session has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def power_of_two(at_least: int) -> int:
    return 1 << max(0, at_least - 1).bit_length()


def hash_share(*columns: str) -> Column:
    """A number from 0 to 1 that follows from the columns' hash, as if drawn evenly."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def arrow_batches(
    rows: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], at_once: int = 1000
) -> Callable[[Batches], Batches]:
    """A mapInArrow function from one of single batches, which get `at_once` rows at most;
    empty ones are left out. What a task has used is given back at its end, as workers live on.
    """

    def over(batches: Batches) -> Batches:
        for batch in batches:
            for first in range(0, batch.num_rows, at_once):
                yield from rows(batch.slice(first, at_once))
        pa.default_memory_pool().release_unused()

    return over


def extended(df: DataFrame, **columns) -> StructType:
    """The schema of `df` with nullable columns after its own."""
    return StructType([*df.schema.fields, *[StructField(n, t) for n, t in columns.items()]])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them as long as `df` has such columns."""
    found = []
    for name in names:
        while name in df.columns or name in found:
            name = f"_{name}"
        found.append(name)
    return found
