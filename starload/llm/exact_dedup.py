"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition becomes a run: its digests in ascending order, each once, with how often
it occurred and with the identifier to keep. Runs are cut by digest range into shards, so that
no task ever holds a whole run. In every round the runs whose numbers agree but for the last
digit travel to one place, where they are put in digest order and walked through once: equal
entries follow each other and become one, with their counts added and the better identifier
kept. After as many rounds as the tree is deep, each shard has one run, and the documents read
their fate from it. Each round is written, in order, before the next begins.

Putting in order is Spark's sort, which spills; the walk holds a batch and the entry before it,
however long the runs are.

A digest of 64 bits orders the runs. Two entries are merged only if the SHA-256 of their
texts agrees too, so a digest collision never joins different texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm.common import Batches, parallelism, power_of_two, text_of
from starload.session import stored

_RUN = ["shard", "run", "digest", "sha256"]


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, digest and sha256 (binary)."""
    text = text_of(text_col)
    return docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text).alias("digest"),
        F.unhex(F.sha2(text, 256)).alias("sha256"),
    )


def _one_of_equals(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Of neighbours with one digest the first, with the sizes of all."""
    starts = np.zeros(batch.num_rows, bool)
    starts[0] = True
    for name in _RUN:
        column = batch.column(batch.schema.get_field_index(name))
        differ = pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1))
        starts[1:] |= differ.to_numpy(zero_copy_only=False)
    first = np.flatnonzero(starts)
    place = batch.schema.get_field_index("size")
    sizes = np.add.reduceat(batch.column(place).to_numpy(zero_copy_only=False), first)
    columns = batch.take(pa.array(first)).columns
    columns[place] = pa.array(sizes)
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def _merge_along(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Entries in order, equal ones made one; the last of a batch waits for the next batch."""
    waiting = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if waiting is not None:
            batch = pa.concat_batches([waiting, batch])
        merged = _one_of_equals(batch)
        waiting = merged.slice(merged.num_rows - 1)
        if merged.num_rows > 1:
            yield merged.slice(0, merged.num_rows - 1)
    if waiting is not None:
        yield waiting


def merged_runs(entries: DataFrame, better: Column) -> DataFrame:
    """The runs that lie together in partitions, each in order and with every digest once. Of
    equal entries the one that is first by `better` gives the identifier."""
    ordered = entries.select(*_RUN, "best", "size").sortWithinPartitions(*_RUN, better)
    return ordered.mapInArrow(_merge_along, ordered.schema)


def first_runs(entries: DataFrame, shards: int, better: Column) -> DataFrame:
    """The run of every partition, cut into `shards` (a power of two) digest ranges."""
    bits = shards.bit_length() - 1
    shard = F.shiftrightunsigned("digest", 64 - bits).cast("int") if bits else F.lit(0)
    alone = entries.select(
        shard.alias("shard"), F.spark_partition_id().alias("run"), "digest", "sha256",
        F.col("id").alias("best"), F.lit(1).cast("long").alias("size"),
    )
    return merged_runs(alone, better)


def merge_round(runs: DataFrame, fan_in: int, better: Column) -> DataFrame:
    """`fan_in` neighbouring runs of each shard become one."""
    together = runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
    return merged_runs(together.repartition("shard", "run"), better)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    fan_in: int = 8,
    rows_per_shard: int = 250_000,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256 (lowercase hex).

    Texts are equal if they are identical; a null text counts as empty. Of equal texts the
    document with the smallest (`keep="largest"`: largest) identifier stays. Rows that share
    identifier and text share their fate and all count in `group_size`. A null identifier
    never wins against another; a group of only null identifiers keeps them (`keep_id` is
    null). An empty table gives an empty result; other columns are ignored.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be smallest or largest")
    if fan_in < 2 or fan_in & (fan_in - 1):
        raise ValueError("fan_in must be a power of two")
    better = F.asc_nulls_last("best") if keep == "smallest" else F.desc_nulls_last("best")
    entries = stored(digests(docs, id_col, text_col), "digests")
    shards = power_of_two(max(parallelism(docs.sparkSession), -(-entries.count() // rows_per_shard)))
    runs = stored(first_runs(entries, shards, better), "runs")
    left = (runs.agg(F.max("run")).first()[0] or 0) + 1
    while left > 1:
        runs = stored(merge_round(runs, fan_in, better), "runs")
        left = -(-left // fan_in)
    # One row per distinct text on this side; a frequent text is a skewed join key on the
    # other, which adaptive execution splits.
    fate = runs.select("digest", "sha256", F.col("best").alias("keep_id"), "size")
    return entries.join(fate, ["digest", "sha256"]).select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("size").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"),
    )
