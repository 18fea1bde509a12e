"""Ranked lexical search by norm buckets.

A document is a vector with a coordinate for each of its terms, the term's impact, and a query
one with the weights of its terms; a score is their inner product. The documents' vectors are
laid out in the order of their lengths, the longest first, and cut into buckets. A query goes
through the buckets with the score of the worst result it has to beat:

* by Cauchy and Schwarz no product is larger than that of the lengths: buckets whose longest
  vector is too short are left out, and so is the end of the one where lengths get too short;
* inside a bucket the query's heaviest terms are looked up in the bucket's postings. What they
  give, plus the product of the lengths that the other coordinates can have, bounds the score;
* survivors are scored anew over all terms, in 64-bit integers.

Bounds are taken in doubles, with a margin beyond their rounding, on coordinates that carry the
root of a term's weight on either side; they only ever leave out documents, never rank them.

Queries are worked on in blocks whose distinct terms have a bounded size in bytes, so that
what the tasks get of them is bounded; every block sees all documents, cut down to the terms
that the block knows. A task hands on `k` results for a query at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starload.llm.common import Batches, arrow_batches, power_of_two
from starload.session import stored

# Fixed values of the score: impact = SCALE tf / (1000 tf + 20 m), m = 50 + 50 n N / L.
_SCALE = 1_000_000_000
_MARGIN = 1 + 1e-9
_PIECE = 1 << 20

# A term is letters of A-Z, lower-cased, digits, and all that is not ASCII: bytes from 0x80 on
# are parts of such characters. Everything else separates terms.
_FOLD = bytes(
    ord(chr(b).lower()) if b < 0x80 and chr(b).isalnum() else b if b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, a piece of it after the other."""
    folded = (text or "").encode().translate(_FOLD)
    start = 0
    while start < len(folded):
        end = start + _PIECE
        if end < len(folded):
            cut = folded.rfind(b" ", start, end)
            end = cut if cut > start else (folded.find(b" ", end) + 1 or len(folded) + 1) - 1
        yield folded[start:end].split()
        start = end


class Block(NamedTuple):
    """Queries, and the numbers of their terms in the block's list of terms."""

    keys: list[int]
    terms: list[bytes]
    query_terms: list[np.ndarray]


class Weights(NamedTuple):
    """What depends on all documents: how many have terms, how many terms, and term weights."""

    docs: int
    length: int
    weight: np.ndarray


# -- queries


def _query_terms(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
    keys, terms, sizes = [], [], []
    for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        own = sorted({t for piece in terms_of(text) for t in piece})
        keys.append(key)
        terms.append(own)
        sizes.append(sum(map(len, own)) + 64 * len(own))
    arrays = [pa.array(keys, pa.int64()), pa.array(terms, pa.list_(pa.binary())), pa.array(sizes, pa.int64())]
    yield pa.RecordBatch.from_arrays(arrays, ["key", "terms", "size"])


def _blocks(queries: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """The queries (key, text) with their terms and the block that each is in, and the number of
    blocks. A block is no larger than twice `block_bytes`, or one query alone is."""
    found = queries.select("key", "text").mapInArrow(
        arrow_batches(_query_terms), "key long, terms array<binary>, size long"
    )
    found = stored(found.filter("size > 0"), "queries")
    count, total = found.agg(F.count(F.lit(1)), F.sum("size")).first()
    blocks = power_of_two(-(-(total or 0) // block_bytes))
    while True:
        block = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")
        # A query that is too large by itself is in a block of its own sooner or later.
        too_large = found.groupBy(block.alias("block")).agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"))
        if too_large.filter((F.col("s") > 2 * block_bytes) & (F.col("n") > 1)).isEmpty():
            return found.withColumn("block", block), blocks if count else 0
        blocks *= 2


def _read_block(queries: DataFrame, number: int) -> Block:
    """A block's queries on the driver: of bounded size, see `_blocks`."""
    rows = queries.filter(F.col("block") == number).orderBy("key").collect()
    terms = sorted({bytes(t) for r in rows for t in r["terms"]})
    place = {t: i for i, t in enumerate(terms)}
    own = [np.array([place[bytes(t)] for t in r["terms"]], np.int32) for r in rows]
    return Block([r["key"] for r in rows], terms, own)


# -- documents as vectors


def _vectors(terms: list[bytes]):
    """Documents (id, text) as id, their number of terms, and the numbers and frequencies of those
    that the block knows; documents without a term are left out."""
    place = {t: i for i, t in enumerate(terms)}

    def rows(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        ids, lengths, known, often, ends = [], [], [], [], [0]
        for own, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            length, counts = 0, []
            for piece in terms_of(text.as_py()):
                length += len(piece)
                counts.append(np.fromiter((i for i in map(place.get, piece) if i is not None), np.int32))
            if not length:
                continue
            at, tf = np.unique(np.concatenate(counts), return_counts=True)
            ids.append(own)
            lengths.append(length)
            known.append(at)
            often.append(tf)
            ends.append(ends[-1] + len(at))
        if not ids:
            return
        joined = [np.concatenate(known).astype(np.int32), np.concatenate(often).astype(np.int64)]
        lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x)) for x in joined]
        arrays = [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), *lists]
        yield pa.RecordBatch.from_arrays(arrays, ["id", "n", "terms", "tf"])

    return arrow_batches(rows)


def _weigh(vectors: DataFrame, terms: int) -> Weights:
    """Statistics over all documents; a number for each term of the block comes to the driver."""
    docs, length = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    weight = np.zeros(terms, np.int64)
    found = vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    for row in found.collect():
        weight[row["t"]] = math.floor(1000 * math.log((2 * docs + 2) / (2 * row["df"] + 1)))
    return Weights(docs, length or 0, weight)


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and where each row's end, from zero on."""
    column = batch.column(batch.schema.get_field_index(name))
    ends = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), ends - ends[0]


def _impacts(known: Weights):
    """Vectors with impacts in place of frequencies, without terms that weigh nothing, and their
    length."""
    root = np.sqrt(known.weight.astype(np.float64))

    def rows(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        terms, ends = _flat(batch, "terms")
        tf, _ = _flat(batch, "tf")
        n = batch.column(1).to_numpy(zero_copy_only=False)
        m = 50 + (50 * n * known.docs) // known.length
        impact = (_SCALE * tf) // (1000 * tf + 20 * np.repeat(m, np.diff(ends)))
        some = (known.weight[terms] > 0) & (impact > 0)
        owner = np.repeat(np.arange(len(n)), np.diff(ends))[some]
        terms, impact = terms[some], impact[some]
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(n)))])
        squares = np.bincount(owner, (root[terms] * impact) ** 2, minlength=len(n))
        lists = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(x)) for x in (terms, impact)]
        arrays = [batch.column(0), *lists, pa.array(np.sqrt(squares))]
        yield pa.RecordBatch.from_arrays(arrays, ["id", "terms", "impacts", "length"])

    return arrow_batches(rows)


# -- search


class Best:
    """The best results of a query so far: scores, ids, and whether the id is null."""

    def __init__(self, k: int, floor: int):
        self.k = k
        self.floor = floor  # results below it are beaten elsewhere
        self.score = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        fit = score >= max(self.floor, 1)
        if not fit.any():
            return
        score, ids, null = (
            np.concatenate([old, new[fit]])
            for old, new in ((self.score, score), (self.ids, ids), (self.null, null))
        )
        order = np.lexsort((ids, null, -score))[: self.k]
        self.score, self.ids, self.null = score[order], ids[order], null[order]
        if len(order) == self.k:
            self.floor = max(self.floor, int(self.score[-1]))


class Bucket:
    """Vectors in the order of their lengths, the longest first, and their postings by term."""

    def __init__(self, batch: pa.RecordBatch, root: np.ndarray):
        ids = batch.column(0)
        self.null = np.asarray(ids.is_null().to_numpy(zero_copy_only=False), bool)
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.terms, self.ends = _flat(batch, "terms")
        self.impacts, _ = _flat(batch, "impacts")
        self.length = batch.column(3).to_numpy(zero_copy_only=False)
        self.downward = -self.length
        order = np.argsort(self.terms, kind="stable")
        self.of_term = self.terms[order]
        self.row = np.repeat(np.arange(len(self.ids)), np.diff(self.ends))[order]
        self.value = (root[self.terms] * self.impacts)[order]

    def bounds(self, first: int, terms: np.ndarray, root: np.ndarray, rest: float) -> np.ndarray:
        """For the `first` vectors what their scores cannot exceed: looked up for `terms`, by
        lengths for the others, whose part of the query is `rest` long."""
        given, square = np.zeros(first), np.zeros(first)
        starts = np.searchsorted(self.of_term, terms)
        ends = np.searchsorted(self.of_term, terms, "right")
        for term, start, end in zip(terms, starts, ends, strict=True):
            row = self.row[start:end]
            row = row[: np.searchsorted(row, first)]
            value = self.value[start : start + len(row)]
            given[row] += root[term] * value
            square[row] += value * value
        left = np.maximum(self.length[:first] ** 2 - square, 0)
        return given + rest * np.sqrt(left)

    def scores(self, rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The exact scores of the rows; `weight` has the query's weights and zeros."""
        sizes = self.ends[rows + 1] - self.ends[rows]
        at = np.repeat(self.ends[rows] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        at += np.arange(len(at))
        total = np.concatenate([[0], np.cumsum(weight[self.terms[at]] * self.impacts[at])])
        ends = np.cumsum(sizes)
        return total[ends] - total[ends - sizes]


def _go_through(
    buckets: Iterable[Bucket], block: Block, known: Weights, best: list[Best], focus: int
) -> None:
    """Every query through all buckets."""
    root = np.sqrt(known.weight.astype(np.float64))
    plans = []
    for terms in block.query_terms:
        ordered = terms[np.argsort(-known.weight[terms], kind="stable")]
        ordered = ordered[known.weight[ordered] > 0]
        size = math.sqrt(known.weight[ordered].sum())
        rest = math.sqrt(known.weight[ordered[focus:]].sum())
        plans.append((ordered, size, rest))
    own = np.zeros(len(known.weight), np.int64)
    for bucket in buckets:
        for (terms, size, rest), found in zip(plans, best, strict=True):
            if not len(terms):
                continue
            reach = found.floor / (size * _MARGIN)
            first = int(np.searchsorted(bucket.downward, -reach, "right"))
            if not first:
                continue
            bound = bucket.bounds(first, terms[:focus], root, rest)
            rows = np.flatnonzero((bound * _MARGIN >= found.floor) & (bound > 0))
            if len(rows):
                own[terms] = known.weight[terms]
                found.add(bucket.scores(rows, own), bucket.ids[rows], bucket.null[rows])
                own[terms] = 0


def _search(block: Block, known: Weights, k: int, floors: list[int], bucket_rows: int, focus: int):
    """A task's buckets, one after the other; then its results, by the place of the query."""
    root = np.sqrt(known.weight.astype(np.float64))

    def over(batches: Batches) -> Batches:
        best = [Best(k, floor) for floor in floors]
        part = TaskContext.get().partitionId()

        def buckets() -> Iterator[Bucket]:
            for batch in batches:
                for first in range(0, batch.num_rows, bucket_rows):
                    yield Bucket(batch.slice(first, bucket_rows), root)

        _go_through(buckets(), block, known, best, focus)
        for key, found in zip(block.keys, best, strict=True):
            if len(found.score):
                size = len(found.score)
                arrays = [
                    pa.array(np.full(size, key)), pa.array(found.ids, mask=found.null),
                    pa.array(found.score), pa.array(np.full(size, part, np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "id", "score", "part"])
        pa.default_memory_pool().release_unused()

    return over


def _top(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("id")]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def _block_results(
    docs: DataFrame, block: Block, k: int, bucket_rows: int, seeds: int, focus: int
) -> DataFrame:
    """key, id, score, rank for the queries of a block."""
    vectors = stored(
        docs.mapInArrow(_vectors(block.terms), "id long, n long, terms array<int>, tf array<long>"),
        "vectors",
    )
    known = _weigh(vectors, len(block.terms))
    weighed = vectors.filter(F.size("terms") > 0).mapInArrow(
        _impacts(known), "id long, terms array<int>, impacts array<long>, length double"
    )
    ordered = weighed.filter("length > 0").repartitionByRange(F.desc("length"), "id")
    index = stored(ordered.sortWithinPartitions(F.desc("length"), "id"), "index")
    result = "key long, id long, score long, part int"
    # The longest vectors, a fixed number, say what every result has to reach.
    longest = index.orderBy(F.desc("length"), "id").limit(seeds)
    nothing = [0] * len(block.keys)
    seeded = longest.mapInArrow(_search(block, known, k, nothing, bucket_rows, focus), result)
    reached = _top(seeded, k, "key").filter(F.col("rank") == k).select("key", "score").collect()
    reached = {r["key"]: r["score"] for r in reached}
    floors = [reached.get(key, 0) for key in block.keys]
    found = index.mapInArrow(_search(block, known, k, floors, bucket_rows, focus), result)
    # Tasks are merged in 64 groups first: no task gets more than `k` rows of each of them.
    merged = _top(found.withColumn("part", F.pmod("part", F.lit(64))), k, "key", "part")
    return _top(merged.drop("rank", "part"), k, "key")


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id_col: str = "item_id",
    query_text_col: str = "text",
    block_bytes: int = 4 << 20,
    bucket_rows: int = 2048,
    seeds: int = 4096,
    focus: int = 8,
) -> DataFrame:
    """For every row of `queries` the `k` rows of `docs` with the highest scores above zero, or
    all, if there are fewer: query id, `rank` from 1, document id (as long), `score`.

    Terms are maximal runs of ASCII letters and digits and of whatever is not ASCII, with A-Z
    lower-cased. A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))) for N documents
    with a term, df of them with this one; its impact 10^9 tf div (1000 tf + 20 m), with
    m = 50 + (50 n N) div L for n terms in the document and L in all of them. A score sums
    weight times impact over the query's terms, once each.

    Equal scores rank by ascending id, null ids last. Every row of `docs` is a document and every
    row of `queries` a query, also where ids or whole rows repeat. Null and empty texts, and
    queries none of whose terms tells documents apart, find nothing, as empty tables do. Other
    columns are ignored.

    `block_bytes` bounds the queries that are worked on together, `bucket_rows` a bucket; `seeds`
    is how many of the longest vectors give the first bounds, `focus` how many terms are looked
    up before survivors are scored. None of them changes a result.
    """
    asked = queries.select(
        F.col(query_id_col).alias("query"), F.col(query_text_col).alias("text"),
        F.monotonically_increasing_id().alias("key"),
    )
    asked = stored(asked, "asked")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    by_block, blocks = _blocks(asked, block_bytes)
    found = None
    for number in range(blocks):
        block = _read_block(by_block, number)
        if block.keys:
            results = stored(_block_results(source, block, k, bucket_rows, seeds, focus), "results")
            found = results if found is None else found.unionByName(results)
    if found is None:
        empty = docs.sparkSession.createDataFrame([], "key long, id long, score long, rank int")
        found = empty
    return found.join(asked.select("key", "query"), "key").select(
        F.col("query").alias(query_id_col), "rank", F.col("id").alias(id_col), "score"
    )
