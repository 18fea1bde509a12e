"""Merge semantics: insert-ignore, stable surrogate keys, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_INCOMING = "_incoming"


def insert_ignore(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of `new` to append to `target`: unknown keys only, one row per key.

    Known rows are never touched. The distinct step combines on the map side before it
    shuffles, so a key that fills a third of the input still arrives as one row per task.
    """
    keys = list(keys)
    return new.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti")


def assign_keys(target: DataFrame, new: DataFrame, key: str, code: str) -> DataFrame:
    """`new` with an integer column `key` that goes on after the largest key of `target`.

    `code` must be unique in `new`. Keys are dense and follow the order of md5(code): the
    first three hex digits cut the codes into 4096 even buckets, each bucket is numbered by
    itself and starts where the buckets before it end. So no task sees all the codes, and a
    task that is run again gives the same numbers.
    """
    digest = F.md5(F.col(code))
    bucketed = new.withColumn("_digest", digest).withColumn("_bucket", F.substring("_digest", 1, 3))
    # At most 4096 rows whatever the input, so one task and a broadcast are safe.
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    largest = F.coalesce(target.select(F.max(key)).scalar(), F.lit(0))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", code))
    return (
        bucketed.withColumn("_rank", within)
        .join(F.broadcast(starts), "_bucket")
        .withColumn(key, (largest + F.col("_start") + F.col("_rank")).cast("int"))
        .drop("_digest", "_bucket", "_rank", "_start")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with the number of their rows."""
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return copies.filter(F.col("copies") > 1)


def tag_union(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Old and new rows together, told apart by a marker column; input of merge_tagged."""
    old = existing.withColumn(_INCOMING, F.lit(0))
    return old.unionByName(incoming.withColumn(_INCOMING, F.lit(1)))


def newer(version: Sequence[str]) -> list[Column]:
    """An order in which new and old rows of a key come by `version`, the latest first. A new row
    that has none comes before all old ones, an old one after all; of equals the new one wins."""
    first, *_ = version
    unversioned = (F.col(_INCOMING) == 1) & F.col(first).isNull()
    return [F.desc(unversioned), *[F.desc(c) for c in version], F.desc(_INCOMING)]


def merge_tagged(
    both: DataFrame, keys: Sequence[str], version: Sequence[str] = (), fate: str | None = None
) -> DataFrame:
    """One row per key: the new row if there is one, else the old row. With a `version`, whichever
    of the two is the later one.

    All measures come from that row, so a NULL of a new row replaces the old value. Two new
    rows with one key are a conflict and fail the job, as does a NULL in a key. A column `fate`
    tells what has become of the key: inserted, replaced, late (a new row that was older than
    the old one) or kept.

    Rows are sorted by key, new before old, and walked once: at most one shuffle, none where
    the rows already lie together by some of the keys, and nothing that has to fit in memory.
    The result is in key order.
    """
    present = F.lit(True)
    for name in keys:
        present = present & F.col(name).isNotNull()
    order = newer(version) if version else [F.desc(_INCOMING)]
    walk = Window.partitionBy(*keys).orderBy(*order)
    incoming, other = F.col(_INCOMING) == 1, F.lead(_INCOMING).over(walk)
    outcome = (
        F.when(incoming & other.isNull(), "inserted").when(incoming, "replaced")
        .when(other == 1, "late").otherwise("kept")
    )
    message = F.concat(F.lit("NULL or repeated key in one load: "), F.to_json(F.struct(*keys)))
    # One CASE, not two filters: a plain "position = 1" would let the planner drop all
    # other rows of a key before the conflict could be seen.
    one_is_old = (F.col(_INCOMING) == 0) | (F.col("_previous") == 0)
    keep = (
        F.when((F.col("_position") == 1) & present, F.lit(True))
        .when((F.col("_position") == 2) & one_is_old, F.lit(False))
        .otherwise(F.raise_error(message).cast("boolean"))
    )
    told = {"_position": F.row_number().over(walk), "_previous": F.lag(_INCOMING).over(walk)}
    if fate:
        told[fate] = outcome
    return both.withColumns(told).filter(keep).drop("_position", "_previous", _INCOMING)


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`existing` after inserting or replacing the rows of `incoming`; see merge_tagged."""
    return merge_tagged(tag_union(existing, incoming), keys).select(*existing.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the one with the largest `order`.

    The planner cuts each task's rows to one per key before it shuffles them.
    """
    ranking = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    ranked = df.withColumn("_position", F.row_number().over(ranking))
    return ranked.filter(F.col("_position") == 1).drop("_position")
