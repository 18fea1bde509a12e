from __future__ import annotations

import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starload.llm.packing import Buckets, optimal_buckets, pack
from tests.llm.conftest import plain_rows


def padding(histogram, lengths):
    return sum(n * (min(b for b in lengths if b >= x) - x) for x, n in histogram)


@pytest.mark.parametrize("seed", range(8))
def test_buckets_are_optimal(seed):
    pick = random.Random(seed)
    histogram = [(x, pick.randint(1, 30)) for x in pick.sample(range(40), 9)]
    lengths = sorted(x for x, _ in histogram)
    for buckets in (1, 2, 3, 5, 9, 12):
        found = optimal_buckets(histogram, buckets)
        best = min(
            padding(histogram, [*inner, lengths[-1]])
            for k in range(min(buckets, 9))
            for inner in itertools.combinations(lengths[:-1], k)
        )
        assert found.padding == best == padding(histogram, found.lengths)
        assert len(found.lengths) <= buckets
        assert found.lengths[-1] == lengths[-1]


def test_no_histogram():
    assert optimal_buckets([], 4) == Buckets([], 0)
    assert optimal_buckets([(7, 3)], 4) == Buckets([7], 0)


def check(rows, found, max_tokens, batch_tokens):
    """Pieces cover their documents, batches are full and hold what the budget allows."""
    pieces, batches = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["n_tokens"]))
        batches[r["bucket"], r["bucket_tokens"], r["batch"]].append(r["slot"])
        assert r["n_tokens"] <= r["bucket_tokens"] <= max_tokens
    for name, text in rows:
        n = len((text or "").split())
        want = [(i, s, min(max_tokens, n - s)) for i, s in enumerate(range(0, n, max_tokens))]
        assert sorted(pieces[name]) == (want or [(0, 0, 0)])
    last = defaultdict(int)
    for bucket, _, batch in batches:
        last[bucket] = max(last[bucket], batch)
    for (bucket, length, batch), slots in batches.items():
        size = max(1, batch_tokens // max(1, length))
        assert sorted(slots) == list(range(len(slots)))
        assert len(slots) == size if batch < last[bucket] else len(slots) <= size
        assert {b for k, _, b in batches if k == bucket} == set(range(last[bucket] + 1))


@pytest.mark.parametrize("chunk_pieces", [3, 100_000])
def test_batches(documents, chunk_pieces):
    pick = random.Random(4)
    rows = [(i, " ".join("w" * pick.randint(0, 60))) for i in range(300)]
    rows += [(1000 + i, "a b c") for i in range(200)] + [(2000, None), (2001, ""), (2002, "w " * 1000)]
    found = pack(documents(rows), max_tokens=64, buckets=5, batch_tokens=200, chunk_pieces=chunk_pieces)
    check(rows, found.collect(), 64, 200)
    assert plain_rows(found) == plain_rows(
        pack(documents(rows).repartition(3), max_tokens=64, buckets=5, batch_tokens=200, chunk_pieces=chunk_pieces)
    )


def test_rows_of_every_kind(documents):
    assert pack(documents([])).count() == 0
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (2, None)]
    clash = {c: "?" for c in ("id", "mix", "length", "piece", "bucket", "chunk", "base", "number")}
    found = pack(documents(rows, **clash)).collect()
    assert len({(r["bucket"], r["batch"], r["slot"]) for r in found}) == 4
    assert sorted(r["n_tokens"] for r in found) == [0, 1, 2, 2]
    only_empty = pack(documents([(1, ""), (2, None)]), batch_tokens=5).collect()
    assert [(r["n_tokens"], r["bucket_tokens"]) for r in only_empty] == [(0, 0)] * 2


def test_lengths_of_another_kind(documents):
    table = documents([(1, "abc"), (2, "abcdefgh"), (3, None)])
    found = pack(table, tokens=F.length("text"), max_tokens=5).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"]) for r in found) == [
        (1, 0, 3), (2, 0, 5), (2, 5, 3), (3, 0, 0),
    ]
