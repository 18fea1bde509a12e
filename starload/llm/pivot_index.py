"""Near duplicates among vectors, found by the order of their nearest pivots.

Pivots are reference points spread over the data: a bounded sample of it, thinned so that no
two are close. A vector is described by its `near` nearest pivots in order of distance.
Every pivot has an inverted list of the vectors it is near to; two vectors become a
candidate pair if they share at least `shared` pivots, and their cosine, in double
precision, decides. Sharing that many of `near` pivots means sharing one of the
`near - shared + 1` rarest of them, so only those lists are built.

Pivots have two levels: each belongs to the nearest of some roots, and a vector opens its
nearest roots until they hold `looked_at` pivots. So their number can grow with the data.

Lists of pivots that lie together make a cell of about `block_rows` entries. A vector is sent once
to each cell that its lists are in, however many of them; there the lists are put together,
and a pair is judged in the first cell, and there in the first list, that both are in: once.
A cell with more vectors than a block is cut into chunks, and every two of them meet. What
leaves a block is, for each vector, how many it is linked to there and a link to the smallest
vector it reaches: never the pairs.

Equal vectors are one node with a count. Labels and dimensions are never mixed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.llm.common import Batches, arrow_batches, extended, hash_share, parallelism
from starload.llm.components import connected_components
from starload.llm.simhash_dedup import merge_labels
from starload.session import stored

_ROWS_AT_ONCE = 1024
# Blocks up to this size are compared at once, not list by list.
_ROWS_TOGETHER = 256
_TILE = 2048
_BLOCK_BYTES = 32 << 20
_PIVOT_BYTES = 32 << 20


def _nodes(vectors: DataFrame) -> DataFrame:
    """label, vec (unit length), least (smallest id), size: one row per distinct vector."""
    finite = F.forall(
        "vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    usable = vectors.filter(F.col("label").isNotNull() & F.col("vec").isNotNull() & finite).filter(
        F.exists("vec", lambda x: x != 0)
    )
    return usable.groupBy("label", "vec").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("size")
    )


def _digest(vec: str) -> Column:
    """The same for equal vectors only, as far as they are compared: zeros have no sign."""
    shown = F.transform(vec, lambda x: F.when(x == 0, F.abs(x)).otherwise(x)).cast("string")
    return F.unhex(F.sha2(shown, 256))


def _unit(batch_column: pa.Array, dimension: int) -> np.ndarray:
    """Rows of equal dimension, scaled to length one; large values do not overflow."""
    flat = batch_column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(-1, dimension)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


class Pivots(NamedTuple):
    """Pivots of one dimension, those of a root side by side; `starts` has where each root's begin,
    and their number."""

    roots: np.ndarray
    starts: np.ndarray
    points: np.ndarray

    def nearest(self, unit: np.ndarray, near: int, looked_at: int) -> np.ndarray:
        """The numbers of each row's nearest pivots, nearest first.

        The roots nearest to a row are opened until they hold `looked_at` pivots.
        """
        if len(self.points) <= looked_at:
            return np.argsort(-(unit @ self.points.T), axis=1, kind="stable")[:, :near]
        by_root = np.argsort(-(unit @ self.roots.T), axis=1, kind="stable")
        held = np.cumsum(np.diff(self.starts)[by_root], axis=1)
        opened = 1 + (held < looked_at).sum(axis=1)
        place = np.full(by_root.shape, -1)
        np.put_along_axis(place, by_root, np.arange(by_root.shape[1])[None, :], axis=1)
        best = np.full((len(unit), opened.max(), near), -np.inf, np.float32)
        which = np.zeros(best.shape, np.int64)
        for root in range(len(self.roots)):
            rows = np.flatnonzero(place[:, root] < opened)
            first, end = self.starts[root], self.starts[root + 1]
            if not len(rows) or first == end:
                continue
            similar = unit[rows] @ self.points[first:end].T
            top = np.argsort(-similar, axis=1, kind="stable")[:, :near]
            at = place[rows, root]
            best[rows, at, : top.shape[1]] = np.take_along_axis(similar, top, axis=1)
            which[rows, at, : top.shape[1]] = top + first
        best, which = best.reshape(len(unit), -1), which.reshape(len(unit), -1)
        top = np.argsort(-best, axis=1, kind="stable")[:, :near]
        return np.take_along_axis(which, top, axis=1)


def _apart(unit: np.ndarray, most: int, apart: float) -> np.ndarray:
    """At most `most` of the rows, the first ones of which no two have a cosine over `apart`."""
    kept: list[int] = []
    for i in range(len(unit)):
        if len(kept) == most:
            break
        if not kept or (unit[kept] @ unit[i]).max() <= apart:
            kept.append(i)
    return np.array(kept, np.int64)


def _two_levels(unit: np.ndarray, pivots: int, apart: float) -> Pivots:
    """Roots are the first rows that are apart, about the root of the number of pivots; all rows go to
    the nearest of them and are thinned there."""
    roots = unit[_apart(unit, max(1, math.isqrt(pivots)), apart)]
    parts = range(0, len(unit), _ROWS_AT_ONCE)
    home = np.concatenate([(unit[i : i + _ROWS_AT_ONCE] @ roots.T).argmax(axis=1) for i in parts])
    by_home = np.split(np.argsort(home, kind="stable"), np.searchsorted(np.sort(home), np.arange(1, len(roots))))
    kept = [own[_apart(unit[own], pivots, apart)] for own in by_home]
    share = min(1.0, pivots / sum(len(k) for k in kept))
    kept = [k[: max(1, int(len(k) * share))] for k in kept]
    starts = np.concatenate([[0], np.cumsum([len(k) for k in kept])])
    return Pivots(roots, starts, unit[np.concatenate(kept)])


def choose_pivots(nodes: DataFrame, pivots: int, apart: float = 0.7) -> dict[int, Pivots]:
    """For every dimension at most `pivots` rows; of those of a root no two with a cosine over `apart`.

    Which vectors are considered follows from their hash: at most twice as many, whatever
    the size of the data.
    """
    sizes = nodes.groupBy("dimension").agg(F.count(F.lit(1)).alias("n"))
    few = (
        nodes.join(sizes, "dimension")
        .filter(hash_share("vec") * F.col("n") < 1.5 * pivots)
        .select("dimension", "vec", F.xxhash64("vec").alias("order"))
    )
    found = few.orderBy("order").limit(2 * pivots).toArrow()
    dimensions = found["dimension"].to_numpy()
    result = {}
    for dimension in np.unique(dimensions).tolist():
        rows = found["vec"].filter(pa.array(dimensions == dimension)).combine_chunks()
        unit = _unit(rows, dimension).astype(np.float32)
        result[dimension] = _two_levels(unit, pivots, apart)
    return result


def describe(nodes: DataFrame, pivots: dict[int, Pivots], near: int, looked_at: int) -> DataFrame:
    """`nodes` with `order`, the numbers of the `near` nearest pivots, nearest first.

    A vector of a dimension without pivots, which can only be rare, gets pivot 0.
    """
    known = nodes.sparkSession.sparkContext.broadcast(pivots)
    columns = ["node", "group", "dimension", "size", "vec"]

    def nearest(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        dimensions = batch.column(2).to_numpy()
        for dimension in np.unique(dimensions):
            own = batch.filter(pa.array(dimensions == dimension))
            points = known.value.get(int(dimension))
            if points is None:
                order = np.zeros((own.num_rows, 1), np.int64)
            else:
                unit = _unit(own.column(4), int(dimension)).astype(np.float32)
                order = points.nearest(unit, near, looked_at)
            lists = pa.array(list(order.astype(np.int32)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*own.columns, lists], names=[*columns, "order"])

    own = nodes.select(*columns)
    order = T.ArrayType(T.IntegerType())
    return own.mapInArrow(arrow_batches(nearest), extended(own, order=order))


_BLOCK = ["group", "dimension", "cell", "a", "b"]


def _whole_blocks(batches: Batches) -> Iterator[pa.Table]:
    """Rows that come sorted by _BLOCK, their first columns, as a table for each block."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([c.to_numpy() for c in batch.columns[: len(_BLOCK)]], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for first, end in zip(cuts, cuts[1:], strict=False):
            key = keys[first].tolist()
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(first, end - first))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _compare(threshold: float, shared: int, shares: Broadcast):
    """Blocks of rows -> node, links, reach: how many vectors a node is linked to in a block,
    and the smallest node it reaches there. Blocks without a link give no row."""

    def over(batches: Batches) -> Batches:
        for block in _whole_blocks(batches):
            found = _compare_block(block, threshold, shared, shares.value)
            if found is not None:
                yield found
        pa.default_memory_pool().release_unused()

    return over


def _common(x: np.ndarray, x_counts: np.ndarray, y: np.ndarray, y_counts: np.ndarray) -> np.ndarray:
    """How many pivots the lists of rows `x` and `y` share, at the places that count."""
    known = np.unique(x[x_counts])
    if not len(known):
        return np.zeros((len(x), len(y)), np.float32)

    def table(lists: np.ndarray, counts: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(known, lists), len(known) - 1)
        who, at = np.nonzero((known[place] == lists) & counts)
        found = np.zeros((len(lists), len(known)), np.float32)
        found[who, place[who, at]] = 1
        return found

    return table(x, x_counts) @ table(y, y_counts).T


def _lists(order: np.ndarray, here: np.ndarray, side: np.ndarray, across: bool):
    """(left, right, pivot) for each list of a block; for a small block all its rows at once,
    without a pivot."""
    if len(order) <= _ROWS_TOGETHER:
        every = np.arange(len(order))
        yield every[side == 0], every[side == 1] if across else every[side == 0], None
        return
    who, place = np.nonzero(here)
    pivot = order[who, place]
    sort = np.argsort(pivot, kind="stable")
    who, pivot = who[sort], pivot[sort]
    cuts = [0, *(np.flatnonzero(pivot[1:] != pivot[:-1]) + 1).tolist(), len(pivot)]
    for first, end in zip(cuts, cuts[1:], strict=False):
        if end - first > 1:
            rows = who[first:end]
            left = rows[side[rows] == 0]
            yield left, rows[side[rows] == 1] if across else left, pivot[first]


def _compare_block(
    block: pa.Table, threshold: float, shared: int, shares: dict[int, np.ndarray]
) -> pa.RecordBatch | None:
    """Compare all rows of one chunk with each other, or those of two chunks across, where they
    are in a list together."""
    cell, dimension, a, b, cells = (
        block[c][0].as_py() for c in ("cell", "dimension", "a", "b", "cells")
    )
    side, node, size = (block[c].to_numpy() for c in ("side", "node", "size"))
    if len(node) < 2 or (a != b and side.min() == side.max()):
        return None
    vectors = _unit(block["vec"].combine_chunks(), dimension)
    order = block["order"].combine_chunks().flatten().to_numpy().reshape(len(node), -1)
    needed = min(shared, order.shape[1])
    prefix = np.arange(order.shape[1]) <= order.shape[1] - needed
    cell_of = _cells_of(shares[dimension][order], cells)
    here, before = (cell_of == cell) & prefix, (cell_of < cell) & prefix
    links = np.zeros(len(node), np.int64)
    label = np.arange(len(node))
    every = np.ones(order.shape, bool)
    for left, right, pivot in _lists(order, here, side, a != b):
        for first in range(0, len(left), _ROWS_AT_ONCE):
            part = left[first : first + _ROWS_AT_ONCE]
            # Rows of one chunk meet those behind them; what is held at once is a tile.
            for start in range(first if a == b else 0, len(right), _TILE):
                tile = right[start : start + _TILE]

                def common(counts: np.ndarray, rows=part, others=tile) -> np.ndarray:
                    return _common(order[rows], counts[rows], order[others], counts[others])

                candidate = common(every) >= needed
                candidate &= common(before) == 0
                if pivot is None:
                    candidate &= common(here) > 0
                else:
                    x, y = (here[rows] & (order[rows] < pivot) for rows in (part, tile))
                    candidate &= _common(order[part], x, order[tile], y) == 0
                if a == b:
                    candidate &= tile[None, :] > part[:, None]
                near = candidate & (vectors[part] @ vectors[tile].T >= threshold)
                x, y = np.nonzero(near)
                if len(x):
                    links[part] += near @ size[tile]
                    links[tile] += near.T @ size[part]
                    merge_labels(label, part[x], tile[y])
    linked = np.flatnonzero(links)
    if not len(linked):
        return None
    return pa.RecordBatch.from_arrays(
        [pa.array(node[linked]), pa.array(links[linked]), pa.array(node[label[linked]])],
        names=["node", "links", "reach"],
    )


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.93,
    pivots: int | None = None,
    near: int = 8,
    shared: int = 2,
    block_rows: int | None = None,
    looked_at: int = 4096,
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Vectors of equal, non-null label (and equal dimension) are linked if their cosine is at
    least `threshold`. A vector that is null, zero or holds null or non-finite components
    links with nothing: no links, a component of its own, kept. Every pair reported is
    verified; a pair is found if it shares `shared` of `near` pivots. By default there are
    about four times the square root of the number of vectors, beyond four millions one for 512,
    as many as 32 MB hold at most. A vector looks for its nearest in the roots that are
    nearest to it, until it has seen `looked_at`. Blocks are of `block_rows`, or of 32 MB.
    `component_id` is the smallest id reachable by links, `kept` whether it is the vector's
    own. Repeated vectors are linked with each other; repeated rows repeat. Null ids never
    name a component that has others. An empty table gives an empty result.
    """
    if not 1 <= shared <= near:
        raise ValueError("shared must be between 1 and near")
    spark = vectors.sparkSession
    single = vectors.schema[vec_col].dataType.simpleString() == "array<float>"
    rows = vectors.select(
        F.col(id_col).alias("id"),
        F.col(label_col).alias("label"),
        F.col(vec_col).cast("array<float>" if single else "array<double>").alias("vec"),
    )
    # Numbered once and written: a lost executor does not number them anew.
    nodes = stored(
        _nodes(rows).select(
            F.monotonically_increasing_id().alias("node"), "label", "vec",
            F.xxhash64("label").alias("group"), F.size("vec").alias("dimension"), "least", "size",
            _digest("vec").alias("digest"),
        ),
        "nodes",
    )
    many, widest = nodes.agg(F.count(F.lit(1)), F.max("dimension")).first()
    wanted = max(32, 4 * math.isqrt(many), many // 512)
    points = choose_pivots(nodes, pivots or min(wanted, max(32, _PIVOT_BYTES // (4 * (widest or 1)))))
    described = stored(describe(nodes, points, near, max(near, looked_at)), "described")
    known = _order_pivots(described)
    postings = _postings(described, known, shared, block_rows)
    found = stored(
        postings.repartition(parallelism(spark), *_BLOCK)
        .sortWithinPartitions(*_BLOCK)
        .mapInArrow(_compare(threshold, shared, known.shares), "node BIGINT, links BIGINT, reach BIGINT"),
        "links",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    reached = connected_components(
        found.select(F.col("node").alias("a"), F.col("reach").alias("b"))
    )
    numbered = (
        nodes.join(links, "node", "left")
        .join(reached, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .withColumn("links", F.coalesce("links", F.lit(0)) + F.col("size") - 1)
    )
    names = numbered.groupBy("component").agg(F.min("least").alias("component_id"))
    named = numbered.join(names, "component").select("label", "digest", "links", "component_id")
    component = F.when(F.col("links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return (
        rows.select("id", "label", _digest("vec").alias("digest"))
        .join(named, ["label", "digest"], "left")
        .select("id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
        .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
        .withColumnRenamed("id", id_col)
    )


def _cells_of(shares: np.ndarray, cells: np.ndarray | int) -> np.ndarray:
    """The cells of pivots by the share of all entries that lists before theirs hold."""
    return (shares * cells).astype(np.int32)


class _Order(NamedTuple):
    """By dimension: the ranks of pivots, rarest first, so that equal sets are compared alike everywhere;
    and by rank the share of all entries that is in lists of pivots before it, in their own order."""

    ranks: Broadcast
    shares: Broadcast


def _order_pivots(described: DataFrame) -> _Order:
    lengths = described.select("dimension", F.explode("order").alias("pivot")).groupBy("dimension", "pivot")
    # A row for each pivot; their number is bounded.
    counted = lengths.count().orderBy("dimension", "pivot").toArrow()
    dimensions, pivots, counts = (counted[c].to_numpy() for c in ("dimension", "pivot", "count"))
    ranks, shares = {}, {}
    for dimension in np.unique(dimensions).tolist():
        own, n = pivots[dimensions == dimension], counts[dimensions == dimension]
        rarest = np.lexsort((own, n))
        ranks[dimension] = np.zeros(own.max() + 1, np.int32)
        ranks[dimension][own[rarest]] = np.arange(len(rarest))
        shares[dimension] = ((np.cumsum(n) - n) / n.sum())[rarest]
    context = described.sparkSession.sparkContext
    return _Order(context.broadcast(ranks), context.broadcast(shares))


def _in_cells(described: DataFrame, known: _Order, shared: int) -> DataFrame:
    """`described` (with `cells`, the number of cells in a group) with pivots as ranks in `order`,
    and `cell`, the cells that its lists are in."""
    dimension_at, cells_at, order_at = (
        described.columns.index(c) for c in ("dimension", "cells", "order")
    )

    def place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        read = [batch.column(i).to_pylist() for i in (dimension_at, cells_at, order_at)]
        orders, meant = [], []
        for dimension, cells, order in zip(*read, strict=True):
            ranks = np.sort(known.ranks.value[dimension][order])
            lists = ranks[: len(ranks) - min(shared, len(ranks)) + 1]
            orders.append(ranks)
            meant.append(np.unique(_cells_of(known.shares.value[dimension][lists], cells)))
        kind = pa.list_(pa.int32())
        ranked = batch.set_column(order_at, "order", pa.array(orders, kind))
        yield ranked.append_column("cell", pa.array(meant, kind))

    several = T.ArrayType(T.IntegerType())
    return described.mapInArrow(arrow_batches(place), extended(described, cell=several)).withColumn(
        "cell", F.explode("cell")
    )


def _postings(described: DataFrame, known: _Order, shared: int, block_rows: int | None) -> DataFrame:
    """A row for each block that a node takes part in, with everything to compare it by.

    Vectors stay where they are until they go to their blocks: what they are joined with is a
    row for each group that fills more than a cell, and for each cell that fills more than a
    block. Both are written first, so that the planner knows their sizes.
    """
    group = ["group", "dimension"]
    rows_in_block = F.lit(block_rows) if block_rows else F.greatest(
        F.lit(_ROWS_AT_ONCE), F.floor(F.lit(_BLOCK_BYTES) / (8 * F.col("dimension")))
    )
    lists = F.size("order") - F.least(F.size("order"), F.lit(shared)) + 1
    split = stored(
        described.groupBy(*group).agg(F.sum(lists).alias("entries"))
        .select(*group, F.ceil(F.col("entries") / rows_in_block).cast("int").alias("cells"))
        .filter("cells > 1"),
        "cells",
    )
    one = F.lit(1)
    placed = described.join(split, group, "left").withColumn("cells", F.coalesce("cells", one))
    key = [*group, "cell"]
    full = stored(
        _in_cells(placed.select(*group, "cells", "order"), known, shared).groupBy(*key).count()
        .select(*key, F.ceil(F.col("count") / rows_in_block).cast("int").alias("chunks"))
        .filter("chunks > 1"),
        "chunks",
    )
    listed = _in_cells(placed, known, shared).join(full, key, "left")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.struct(
            F.least(F.col("own"), other).alias("a"),
            F.greatest(F.col("own"), other).alias("b"),
            (other < F.col("own")).cast("int").alias("side"),
        ),
    )
    return (
        listed.withColumn("chunks", F.coalesce("chunks", one))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        .withColumn("meet", F.explode(meets))
        .select(*key, "meet.a", "meet.b", "meet.side", "cells", "node", "size", "vec", "order")
    )
