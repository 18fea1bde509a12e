"""Near duplicates by SimHash, found with BK-trees.

Equal fingerprints are one node. Nodes are cut into shards, and a shard is a BK-tree: children are
keyed by their Hamming distance to the parent, and a search follows only the edges within
`radius` of the distance to the node it stands on.

Up to a number of nodes that bounds their size, shards are drawn by hash, their packed trees are
broadcast, and every node searches all of them. That makes every node meet every tree, so
beyond it shards are drawn by bands instead: nodes that differ in at most `radius` bits agree
exactly in one of `radius + 1` bands of bits, so of the shards by (band, value of the band) every
linked pair meets in one at least, and nodes search the trees of their own shards only. A shard
with more nodes than a tree may hold becomes several trees, each searched by all nodes of the
shard. Both ways find the same links.

Trees are built and searched level by level over arrays. What leaves a task are not the
links but a spanning forest of them: at most one link a node.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from starload.llm.common import arrow_batches, extended, fresh, parallelism
from starload.llm.components import connected_components
from starload.session import stored

SEED = 42
_HASHES_AT_ONCE = 1 << 16
_TREES_SEARCHING = 4  # trees whose nodes search a tree at a time
_PAIRS_AT_ONCE = 1 << 18
_SEARCHING = 4096  # nodes that search a broadcast tree at a time
# What a tree consists of, with the types that it is broadcast in.
_PACKED = {"values": np.uint64, "children": np.int32, "start": np.int32, "count": np.int32, "edge": np.int8}


def fingerprint(text: str, shingle: int = 3) -> int:
    """A bit is 1 if it is set in over half the shingles' hashes; no words: zero."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _HASHES_AT_ONCE):
        part = hashes[i : i + _HASHES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(
    docs: DataFrame,
    text_col: str = "text",
    shingle: int = 3,
    into: str = "fingerprint",
    keep_text: bool = True,
) -> DataFrame:
    """`docs` with the fingerprint as a signed 64-bit number, in place of a column of that name.

    Words are runs of anything but ASCII white space, A-Z lower-cased. A text with fewer
    words than a shingle is one shingle; null, empty or blank texts have fingerprint zero.
    """
    source = docs.select(*[c for c in docs.columns if c != into])
    place = source.columns.index(text_col)
    kept = [c for c in source.columns if keep_text or c != text_col]

    def append(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column(place)
        values = np.array([fingerprint(t.as_py() or "", shingle) for t in texts], np.uint64)
        own = [batch.column(batch.schema.get_field_index(c)) for c in kept]
        yield pa.RecordBatch.from_arrays([*own, pa.array(values.view(np.int64))], names=[*kept, into])

    return source.mapInArrow(arrow_batches(append), extended(source.select(*kept), **{into: LongType()}))


class Forest:
    """BK-trees over 64-bit numbers, one for each distinct key, as arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        """Nodes are taken in their order, as by inserting one after the other."""
        self.values = values
        n = len(values)
        self.parent = np.full(n, -1, np.int64)
        self.edge = np.zeros(n, np.int64)
        _, first, group = np.unique(keys, return_index=True, return_inverse=True)
        self.roots = first
        here = first[group]  # the node that each unplaced node has come to
        waiting = np.flatnonzero(here != np.arange(n))
        while len(waiting):
            at = here[waiting]
            distance = np.bitwise_count(values[waiting] ^ values[at]).astype(np.int64)
            _, first, group = np.unique(at * 65 + distance, return_index=True, return_inverse=True)
            child = waiting[first]
            self.parent[child], self.edge[child] = at[first], distance[first]
            here[waiting] = child[group]
            waiting = waiting[here[waiting] != waiting]
        order = np.argsort(self.parent, kind="stable")
        self.children = order[np.searchsorted(self.parent[order], 0) :]
        self.start = np.searchsorted(self.parent[self.children], np.arange(n))
        self.count = np.bincount(self.parent[self.children], minlength=n)

    def packed(self) -> dict[str, bytes]:
        """The tree of a single key, 21 bytes a node."""
        return {name: np.ascontiguousarray(getattr(self, name).astype(kind)).tobytes() for name, kind in _PACKED.items()}

    @classmethod
    def unpacked(cls, saved) -> Forest:
        tree = cls.__new__(cls)
        for name, kind in _PACKED.items():
            setattr(tree, name, np.frombuffer(saved[name], kind).astype(np.uint64 if name == "values" else np.int64))
        return tree

    def search(
        self, queries: np.ndarray, roots: np.ndarray, radius: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query number, node) pairs within the radius, from the given root for each query."""
        stack = [(np.arange(len(queries)), roots)]
        while stack:
            who, node = stack.pop()
            if len(who) > _PAIRS_AT_ONCE:
                half = len(who) // 2
                stack += [(who[:half], node[:half]), (who[half:], node[half:])]
                continue
            distance = np.bitwise_count(queries[who] ^ self.values[node]).astype(np.int64)
            near = distance <= radius
            if near.any():
                yield who[near], node[near]
            many = self.count[node]
            which = np.repeat(np.arange(len(who)), many)
            ahead = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
            child = self.children[self.start[node[which]] + ahead]
            follow = np.abs(self.edge[child] - distance[which]) <= radius
            if follow.any():
                stack.append((who[which[follow]], child[follow]))


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a and b for each pair; `label` leads every node to its smallest."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _links_in_shards(radius: int):
    """Rows (tree, role, value) of whole trees -> a spanning forest of their links.

    `role` 0 is a node of the tree, which also searches it; 1 only searches it; 2 is a node of
    a further copy of the tree, which others search.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, role, values in _whole_trees(batches):
            nodes, searching = role != 1, role == 1
            forest = Forest(tree[nodes], values[nodes])
            keys = tree[nodes][forest.roots]
            if not len(keys):
                continue
            root = np.minimum(np.searchsorted(keys, tree), len(keys) - 1)
            place = np.concatenate([np.flatnonzero(nodes), np.flatnonzero(searching)])
            known = np.zeros(len(values), np.int64)
            known[place] = np.arange(len(values))  # numbers: nodes first, then the others
            label = np.arange(len(values))
            # By chance a tree may have got no node.
            asking = np.flatnonzero((role[place] != 2) & (keys[root[place]] == tree[place]))
            asked = place[asking]
            for who, node in forest.search(values[asked], forest.roots[root[asked]], radius):
                merge_labels(label, asking[who], node)
            linked = np.flatnonzero(label != np.arange(len(label)))
            own = values[place].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[linked]), pa.array(own[label[linked]])], names=["a", "b"]
            )

    return over


def _whole_trees(batches, at_least: int = 50_000):
    """Arrays of rows that come sorted by tree, cut only between trees."""
    held: list[tuple[np.ndarray, ...]] = []
    rows = 0
    for batch in batches:
        held.append(
            (
                batch.column(0).to_numpy(),
                batch.column(1).to_numpy(),
                batch.column(2).to_numpy().view(np.uint64),
            )
        )
        rows += batch.num_rows
        if rows >= at_least:
            tree, role, value = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = int(np.searchsorted(tree, tree[-1]))
            if cut:
                yield tree[:cut], role[:cut], value[:cut]
            held, rows = [(tree[cut:], role[cut:], value[cut:])], len(tree) - cut
    if rows:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def tree_rows(nodes: DataFrame, radius: int, tree_size: int) -> DataFrame:
    """tree, role, fingerprint: every node in its own tree of each shard and, as a searcher, in
    those behind it. A tree that many search has a copy for every block of searchers, so that
    none comes with more than about `_TREES_SEARCHING` trees of them."""
    bands = radius + 1
    width = -(-64 // bands)
    mask = (1 << width) - 1

    def band_value(i: int):
        return F.shiftrightunsigned("fingerprint", i * width).bitwiseAND(F.lit(mask).cast("long"))

    banded = nodes.select(
        "fingerprint",
        F.explode(
            F.array(*[F.struct(F.lit(i).alias("band"), band_value(i).alias("value")) for i in range(bands)])
        ).alias("shard"),
    ).select("fingerprint", "shard.band", "shard.value")
    sizes = banded.groupBy("band", "value").count().filter("count > 1")
    # Shards of one node have no links. Larger ones are cut into trees of `tree_size`.
    cut = F.ceil(F.col("count") / tree_size).cast("int")
    sized = banded.join(sizes, ["band", "value"]).withColumn("trees", cut)
    own = F.pmod(F.xxhash64("fingerprint"), F.col("trees")).cast("int")
    routed = sized.withColumn("own", own).withColumn(
        "tree", F.explode(F.sequence(F.col("own"), F.col("trees") - 1))
    )
    blocks = F.greatest(F.lit(1), F.ceil(F.col("tree") / _TREES_SEARCHING).cast("int"))
    is_node = F.col("tree") == F.col("own")
    one = F.pmod(F.xxhash64("fingerprint", "tree"), blocks).cast("int")
    dealt = routed.withColumn(
        "block", F.explode(F.when(is_node, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(one)))
    )
    return dealt.select(
        F.xxhash64("band", "value", "tree", "block").alias("tree"),
        F.when(~is_node, 1).when(F.col("block") == 0, 0).otherwise(2).alias("role"),
        "fingerprint",
    )


def _build_tree(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    values = np.sort(rows["fingerprint"].to_numpy()).view(np.uint64)
    return pd.DataFrame([Forest(np.zeros(len(values), np.int64), values).packed()])


def shard_trees(nodes: DataFrame, tree_size: int, count: int) -> list[Forest]:
    """The trees of shards drawn by hash, built in tasks and collected: for numbers of nodes whose
    size was checked only."""
    shard = F.pmod(F.xxhash64("fingerprint"), F.lit(-(-count // tree_size)))
    built = nodes.groupBy(shard.alias("shard")).applyInPandas(
        _build_tree, ", ".join(f"`{name}` BINARY" for name in _PACKED)
    )
    return [Forest.unpacked(row) for row in built.collect()]


def _links_to(trees: Broadcast, radius: int):
    """Numbers -> a spanning forest of their links to the nodes of all trees."""

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = batch.column(0).to_numpy().view(np.uint64)
        for tree in trees.value:
            values = np.concatenate([tree.values, own])
            label = np.arange(len(values))
            for who, node in tree.search(own, np.zeros(len(own), np.int64), radius):
                merge_labels(label, who + len(tree.values), node)
            linked = np.flatnonzero(values != values[label])
            ends = [pa.array(values[at].view(np.int64)) for at in (linked, label[linked])]
            yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])

    return arrow_batches(rows, _SEARCHING)


def links(
    nodes: DataFrame, radius: int = 3, tree_size: int = 20_000, max_broadcast_nodes: int = 1 << 16
) -> DataFrame:
    """Links (a, b) that connect all numbers in column `fingerprint` within `radius` bits of
    each other; not every linked pair is given. The numbers must be distinct. Up to
    `max_broadcast_nodes` of them, 21 bytes each, the trees are broadcast."""
    count = nodes.count()
    if count <= max_broadcast_nodes:
        spark = nodes.sparkSession
        trees = shard_trees(nodes, tree_size, count) if count else []
        search = _links_to(spark.sparkContext.broadcast(trees), radius)
        spread = nodes.select("fingerprint").repartition(parallelism(spark))
        return spread.mapInArrow(search, "a BIGINT, b BIGINT").distinct()
    rows = tree_rows(nodes, radius, tree_size)
    n = parallelism(nodes.sparkSession)
    return (
        rows.repartition(n, "tree")
        .sortWithinPartitions("tree", "role", "fingerprint")
        .mapInArrow(_links_in_shards(radius), "a BIGINT, b BIGINT")
        .distinct()
    )


def _components(marked: DataFrame, radius: int, tree_size: int, max_broadcast_nodes: int) -> DataFrame:
    """fingerprint, component (its smallest fingerprint as a number) and component_id, by the ids
    and fingerprints of all rows."""
    first = stored(marked.groupBy("fingerprint").agg(F.min("id").alias("first")), "nodes")
    linked = links(first.select("fingerprint"), radius, tree_size, max_broadcast_nodes)
    reached = connected_components(linked)
    nodes = first.join(reached.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "fingerprint"))
    names = nodes.groupBy("component").agg(F.min("first").alias("component_id"))
    return nodes.join(names, "component").select("fingerprint", "component", "component_id")


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 3,
    tree_size: int = 20_000,
    max_broadcast_nodes: int = 1 << 16,
) -> DataFrame:
    """id, fingerprint (signed 64 bits) and component_id, the smallest id reachable by links.

    One row per row of `docs`; two documents are linked if their fingerprints differ in at
    most `radius` bits. Texts without words have fingerprint zero and are linked with each
    other like any others. Null ids belong to their component but never name it, unless all
    its ids are null. Repeated rows are repeated; an empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marked = stored(fingerprints(source, "text", shingle, keep_text=False), "fingerprints")
    named = _components(marked, radius, tree_size, max_broadcast_nodes)
    return marked.join(named, "fingerprint").select(
        F.col("id").alias(id_col), "fingerprint", "component_id"
    )


def one_of_each_group(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 3,
    tree_size: int = 20_000,
    max_broadcast_nodes: int = 1 << 16,
) -> DataFrame:
    """The rows of `docs`, with its own columns, that name their component: one of each.

    Of rows with the id that names the component the one with the least hash of its columns stays,
    and of rows that are equal in all of them any one. Texts are fingerprinted once, and who stays
    is found by ids, fingerprints and hashes alone; texts meet the result in one join.
    """
    whole = F.xxhash64(*docs.columns)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), whole.alias("row"))
    marked = stored(fingerprints(source, "text", shingle, keep_text=False), "fingerprints")
    named = _components(marked, radius, tree_size, max_broadcast_nodes)
    naming = marked.join(named, "fingerprint").filter(F.col("id").eqNullSafe(F.col("component_id")))
    equal = naming.groupBy("component", "component_id", "row").agg(F.count(F.lit(1)).alias("copies"))
    least = equal.groupBy("component", "component_id").agg(F.min(F.struct("row", "copies")).alias("least"))
    name, value, copies = fresh(docs, "name", "value", "copies")
    stays = least.select(
        F.col("component_id").alias(name), F.col("least.row").alias(value), F.col("least.copies").alias(copies)
    )
    stays = stored(stays, "stays")

    def met(some: DataFrame) -> DataFrame:
        return docs.join(some, (whole == F.col(value)) & F.col(id_col).eqNullSafe(F.col(name)), "left_semi")

    repeated = stays.filter(F.col(copies) > 1)
    if repeated.isEmpty():
        return met(stays)
    # Rows that repeat whole are few as a rule: only they are looked at once more.
    one = met(repeated).withColumn(value, whole).dropDuplicates([id_col, value]).drop(value)
    return met(stays.filter(F.col(copies) == 1)).unionByName(one)
