"""A Merkle manifest of a dataset, by slot pivot.

Every row is a leaf: the digest of its columns. The leaves of a group, in the order of their
ids, are the lowest level of a tree, in which every run of `fanout` nodes has a parent. The
pivot spreads the children of a parent into `fanout` columns, one for each slot, by conditional
aggregates; the columns put together are hashed to the parent's digest, and without the column of
a node's own slot they are its siblings. The groups' apexes, in the order of the groups, are
the leaves of one more tree of the same kind, which ends in the root.

Trees are built upwards and proofs handed downwards, a level at a time: a node's proof is its
own siblings and then its parent's proof. A level is a table of an eighth of the rows of the
level below, so all of them together cost less than the leaves.

Places in the order come from ranges: rows are laid out and sorted by group and id, numbered as
they stream by, and a range starts where those before it end. A group with most of the rows is
cut into many ranges; parents have `fanout` children whatever the group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from starload.llm.common import Batches, extended
from starload.session import stored

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_SIBLINGS = "array<struct<before:string,after:string>>"


# -- digests and proofs, as column functions


def leaf_digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the values, each `-` if null, else its length in UTF-8 bytes, a
    colon and the value itself; numbers are written in decimal."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof lead to."""
    return F.aggregate(
        proof, digest, lambda own, level: F.sha2(F.concat(level["before"], own, level["after"]), 256)
    )


def siblings(proof: Column) -> Column:
    """All digests of a proof in one text: level by level from the leaf on, left to right."""
    return F.array_join(F.transform(proof, lambda p: F.concat(p["before"], p["after"])), "")


# -- places


def _count_along(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, each with its range and its place among the range's rows of its key."""
    part = TaskContext.get().partitionId()
    last, held = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        runs = pc.run_end_encode(batch.column(batch.schema.get_field_index("key")))
        ends = np.asarray(runs.run_ends, np.int64)
        starts = np.concatenate([[0], ends[:-1]])
        place = np.arange(batch.num_rows) - np.repeat(starts, ends - starts)
        if runs.values[0].as_py() == last:
            place[: ends[0]] += held
        last, held = runs.values[-1].as_py(), int(place[-1]) + 1
        columns = [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(place)]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "part", "place"])


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """`rows` (`key` and others) with `at`, the place among the rows of the key in the order, from
    zero, and `n`, how many the key has. Equal rows get their places in any order."""
    by = ["key", *order]
    ranges = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    schema = extended(rows, part=IntegerType(), place=LongType())
    numbered = stored(ranges.mapInArrow(_count_along, schema), "placed")
    sizes = numbered.groupBy("key", "part").agg((F.max("place") + 1).alias("size"))
    # A row for each range, and one more for each key: no key has more rows than there are ranges.
    own = Window.partitionBy("key")
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(
        sizes.select(
            "key", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"),
            F.sum("size").over(own).alias("n"),
        ),
        "starts",
    )
    return numbered.join(starts, ["key", "part"]).select(
        *rows.columns, (F.col("start") + F.col("place")).alias("at"), "n"
    )


# -- trees


def _slots(fanout: int) -> list[str]:
    return [f"c{slot}" for slot in range(fanout)]


def _parent(fanout: int) -> Column:
    return F.call_function("div", F.col("at"), F.lit(fanout))


def pivot(nodes: DataFrame, fanout: int) -> DataFrame:
    """The parents of the nodes (key, at, n, digest) of keys that have more than one: the same
    columns of theirs, and their children by slot."""
    slot = F.pmod("at", F.lit(fanout))
    children = [F.max(F.when(slot == s, F.col("digest"))).alias(c) for s, c in enumerate(_slots(fanout))]
    grouped = nodes.filter("n > 1").groupBy("key", _parent(fanout).alias("at"))
    return grouped.agg(F.max("n").alias("n"), *children).select(
        "key", "at", F.ceil(F.col("n") / fanout).alias("n"),
        F.sha2(F.concat_ws("", *_slots(fanout)), 256).alias("digest"), *_slots(fanout),
    )


def levels(leaves: DataFrame, fanout: int) -> list[DataFrame]:
    """The tables of parents, from the lowest on, up to where every key has one node."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    found, nodes = [], leaves
    while most > 1:
        found.append(stored(pivot(nodes, fanout), "level"))
        nodes, most = found[-1], -(-most // fanout)
    return found


def apexes(leaves: DataFrame, above: Sequence[DataFrame]) -> DataFrame:
    """key and digest of the one node that a key ends in."""
    found = leaves.filter("n = 1").select("key", "digest")
    for level in above:
        found = found.unionByName(level.filter("n = 1").select("key", "digest"))
    return found


def _hung(nodes: DataFrame, over: DataFrame, given: Sequence[str], fanout: int) -> DataFrame:
    """`nodes` with their proof and what else is `given` from above: by the parents, or for the
    only node of a key by the roots. `over` holds both, the roots in place -1."""
    slot = F.pmod("at", F.lit(fanout))
    before = [F.when(slot > s, F.col(f"_{c}")) for s, c in enumerate(_slots(fanout))]
    after = [F.when(slot < s, F.col(f"_{c}")) for s, c in enumerate(_slots(fanout))]
    own = F.array(
        F.struct(F.concat_ws("", *before).alias("before"), F.concat_ws("", *after).alias("after"))
    )
    named = over.withColumnsRenamed({c: f"_{c}" for c in ("key", "at", *_slots(fanout))})
    up = F.when(F.col("n") > 1, _parent(fanout)).otherwise(-1)
    met = nodes.join(named, (nodes["key"] == named["_key"]) & (up == named["_at"]))
    proof = F.when(F.col("n") > 1, F.concat(own, "proof")).otherwise(F.col("proof"))
    return met.select(*nodes.columns, proof.alias("proof"), *given)


def proofs(
    leaves: DataFrame, above: Sequence[DataFrame], roots: DataFrame, fanout: int
) -> DataFrame:
    """`leaves` with `proof`, from their own siblings up to and with the roots' proof, and the
    other columns that `roots` (a row for each key) has."""
    given = [c for c in roots.columns if c not in ("key", "proof")]
    nothing = {c: F.lit(None).cast("string") for c in _slots(fanout)}
    hanging = roots.withColumns({"at": F.lit(-1).cast("long"), **nothing})
    over = hanging
    for level in reversed(above):
        hung = _hung(level, over, given, fanout)
        columns = ["key", "at", *_slots(fanout), "proof", *given]
        over = stored(hung.select(*columns), "proofs").unionByName(hanging.select(*columns))
    return _hung(leaves, over, given, fanout)


def merkle_manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    columns: Sequence[str] = COLUMNS,
    fanout: int = 8,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of `docs`: id, `leaf`, `subroot` of its group, `root`, `proof`, and what is
    to `carry` along, columns computed from `docs`.

    `proof` has an entry for every level from the leaf up to the root: the siblings `before` and
    `after`, their digests put together, both empty where the node is the only one of its run.
    See `leaf_digest`, `fold` and `siblings`. Only `columns` go into a leaf, others are ignored;
    a null and an empty value differ.

    Null is a group like any other, and the first. Within a group rows with a null id come
    first; rows of one id follow each other by leaf, and rows that are equal in all of it have
    places, and so proofs, of their own. A group of one row has its leaf for a subroot; a single
    group's subroot is the root. An empty table gives an empty result.
    """
    if fanout < 2:
        raise ValueError("fanout must be 2 at least")
    group = F.col(group_col).cast("string")
    carry = carry or {}
    # What sorts as the group does, with null first, and is never null.
    key = F.coalesce(F.concat(F.lit("="), group), F.lit("-"))
    own = {f"carried{i}": column for i, column in enumerate(carry.values())}
    leaves = docs.select(
        key.alias("key"), F.col(id_col).alias("id"),
        leaf_digest(*map(F.col, columns)).alias("digest"),
        F.monotonically_increasing_id().alias("row"), *[c.alias(n) for n, c in own.items()],
    )
    # `row` lets ranges cut even rows that are equal in all else; stored, it stays what it is.
    leaves = stored(placed(stored(leaves, "leaves"), "id", "digest", "row"), "leaves")
    above = levels(leaves, fanout)
    groups = apexes(leaves, above).select(F.lit("").alias("key"), F.col("key").alias("own"), "digest")
    groups = stored(placed(groups, "own"), "groups")
    over_groups = levels(groups, fanout)
    end = apexes(groups, over_groups).select(
        "key", F.array().cast(_SIBLINGS).alias("proof"), F.col("digest").alias("root")
    )
    roots = proofs(groups, over_groups, end, fanout).select(
        F.col("own").alias("key"), "proof", F.col("digest").alias("subroot"), "root"
    )
    found = proofs(leaves, above, stored(roots, "roots"), fanout)
    return found.select(
        F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", "proof",
        *[F.col(n).alias(c) for n, c in zip(own, carry, strict=True)],
    )
