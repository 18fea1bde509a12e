"""Packing by optimal length buckets.

Documents are cut into pieces of at most `max_tokens` tokens. A bucket takes the pieces up to
its length and pads them to it; a batch takes as many pieces of one bucket as fit the token
budget. Which lengths make the best buckets is found exactly: the histogram of all piece
lengths, which has at most `max_tokens` + 1 rows however many documents there are, goes
through a dynamic program that minimises the padding in all buckets together.

Batches are full but for the last of each bucket. Pieces are numbered through their bucket by
a hash of the document, in two levels: chunks of a bucket are counted, and the prefix sums of
the counts tell where each chunk's numbers begin. A bucket that holds most pieces has most
chunks.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starload.llm.common import parallelism, text_of
from starload.session import stored


class Buckets(NamedTuple):
    """Ascending lengths, the last one that of the longest piece, and the tokens of padding."""

    lengths: list[int]
    padding: int


def optimal_buckets(histogram: Sequence[tuple[int, int]], buckets: int) -> Buckets:
    """The at most `buckets` lengths with the least padding for (length, pieces) rows.

    The cost of a bucket over lengths i..j is monotone in the way that lets each layer's
    best cuts be searched between those of its neighbours: layers times n log n steps.
    Of equally good plans the one with fewer buckets, then that with smaller cuts, wins.
    """
    rows = sorted((length, pieces) for length, pieces in histogram if pieces)
    if not rows:
        return Buckets([], 0)
    lengths = np.array([r[0] for r in rows], np.int64)
    pieces = np.concatenate([[0], np.cumsum([r[1] for r in rows])])
    tokens = np.concatenate([[0], np.cumsum([r[0] * r[1] for r in rows])])
    n = len(rows)

    def cost(first: np.ndarray, end: int) -> np.ndarray:
        """Padding of one bucket over rows first..end - 1."""
        return lengths[end - 1] * (pieces[end] - pieces[first]) - (tokens[end] - tokens[first])

    best = [cost(np.zeros(1, np.int64), end)[0] if end else 0 for end in range(n + 1)]
    layers = [np.array(best)]
    cuts: list[np.ndarray] = [np.zeros(n + 1, np.int64)]
    for layer in range(1, min(buckets, n)):
        current = np.full(n + 1, np.iinfo(np.int64).max // 4)
        cut = np.zeros(n + 1, np.int64)
        tasks = [(layer + 1, n, layer, n - 1)]
        while tasks:
            low, high, from_, to = tasks.pop()
            if low > high:
                continue
            end = (low + high) // 2
            options = np.arange(from_, min(to, end - 1) + 1)
            costs = layers[-1][options] + cost(options, end)
            found = int(costs.argmin())
            current[end], cut[end] = costs[found], options[found]
            tasks += [(low, end - 1, from_, int(cut[end])), (end + 1, high, int(cut[end]), to)]
        layers.append(current)
        cuts.append(cut)
    final = [int(layer[n]) for layer in layers]
    used = int(np.argmin(final))
    ends, end = [], n
    for layer in range(used, -1, -1):
        ends.append(end)
        end = int(cuts[layer][end])
    return Buckets([int(lengths[e - 1]) for e in reversed(ends)], final[used])


def words(text_col: str) -> Column:
    """How many runs of anything but white space a text has; a tokenizer's count for those
    who need no tokenizer."""
    return F.size(F.filter(F.split(text_of(text_col), r"\s+"), lambda w: w != ""))


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens: Column | None = None,
    max_tokens: int = 2048,
    buckets: int = 16,
    batch_tokens: int = 65_536,
    chunk_pieces: int = 100_000,
) -> DataFrame:
    """One row per piece: id, piece, start, n_tokens, bucket, bucket_tokens, batch, slot.

    `tokens` gives a document's length (its words by default; null counts as zero). A
    document of n tokens has ceil(n / max_tokens) pieces, numbered from 0, that cover it
    without gap or overlap; one without tokens has one piece of none, so that no document
    gets lost. `bucket` counts from 0 by length, `bucket_tokens` is the length its pieces
    are padded to, `batch` is numbered within the bucket, `slot` within the batch; a batch
    of a bucket has max(1, batch_tokens // bucket_tokens) slots, all filled but in the last
    one. Repeated rows are packed each for itself. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    length = words(text_col) if tokens is None else F.coalesce(tokens, F.lit(0))
    count = F.greatest(F.lit(1), F.ceil(F.col("length") / max_tokens)).cast("int")
    cut = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("mix"), length.alias("length")
    ).withColumn("piece", F.explode(F.sequence(F.lit(0), count - 1)))
    start = F.col("piece").cast("long") * max_tokens
    pieces = stored(
        cut.select(
            "id", "mix", "piece", start.alias("start"),
            F.least(F.lit(max_tokens), F.col("length") - start).cast("int").alias("n_tokens"),
        ),
        "pieces",
    )
    histogram = [
        (r["n_tokens"], r["count"]) for r in pieces.groupBy("n_tokens").count().collect()
    ]
    plan = optimal_buckets(histogram, buckets)
    rows = sum(n for _, n in histogram)
    bounds = F.array(*[F.lit(b) for b in plan.lengths]) if plan.lengths else F.array(F.lit(0))
    bucket = F.size(F.filter(bounds, lambda b: b < F.col("n_tokens")))
    chunks = _chunks(histogram, plan.lengths, chunk_pieces, parallelism(spark) if rows else 1)
    many = F.get(F.array(*[F.lit(c) for c in chunks]), F.col("bucket"))
    dealt = pieces.withColumn("bucket", bucket).withColumn(
        "chunk", F.pmod(F.col("mix"), many).cast("int")
    )
    sizes = dealt.groupBy("bucket", "chunk").count()
    before = Window.partitionBy("bucket").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each chunk; the sums run over the chunks of a bucket.
    bases = sizes.select(
        "bucket", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")
    )
    order = Window.partitionBy("bucket", "chunk").orderBy("mix", "id", "piece")
    numbered = dealt.join(bases, ["bucket", "chunk"]).withColumn(
        "number", F.col("base") + F.row_number().over(order) - 1
    )
    padded = F.get(bounds, F.col("bucket"))
    slots = F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.greatest(F.lit(1), padded)))
    return numbered.select(
        F.col("id").alias(id_col), "piece", "start", "n_tokens", "bucket",
        padded.alias("bucket_tokens"),
        F.floor(F.col("number") / slots).cast("long").alias("batch"),
        (F.col("number") % slots).cast("long").alias("slot"),
    )


def _chunks(histogram, lengths: list[int], chunk_pieces: int, spread: int) -> list[int]:
    """For each bucket how many chunks it is cut into: by its size, and so that all buckets
    together keep the cluster busy."""
    held = [0] * max(1, len(lengths))
    for length, pieces in histogram:
        held[bisect.bisect_left(lengths, length)] += pieces
    total = max(1, sum(held))
    return [max(1, -(-h // chunk_pieces), -(-h * spread // total)) for h in held]
