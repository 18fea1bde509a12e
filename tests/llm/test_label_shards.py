from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from starload.llm.label_shards import plan_quotas, shard_documents
from tests.llm.conftest import plain_rows


def check(rows, found, shards):
    """What must hold of any result: the rows themselves, sizes, and slots without gaps."""
    wanted = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in found), key=repr) == wanted
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[s]) for s in range(shards)]
    assert sum(counts) == len(rows) and max(counts) - min(counts) <= 1
    return counts


def shards_of_texts(rows, found):
    text = dict(rows)
    spread = defaultdict(set)
    for r in found:
        spread[text[r["doc_id"]]].add(r["shard"])
    return spread


def cut_links(rows, found):
    """Pairs of equal texts in different shards, and all pairs."""
    text = dict(rows)
    cells = Counter((text[r["doc_id"]], r["shard"]) for r in found)
    sizes = Counter(text[r["doc_id"]] for r in found)
    pairs = sum(n * (n - 1) // 2 for n in sizes.values())
    return pairs - sum(n * (n - 1) // 2 for n in cells.values()), pairs


def test_small_groups_stay_whole_where_there_is_room(documents):
    rows = [(i, f"group {i % 60}" if i < 300 else f"own {i}") for i in range(1000)]
    found = shard_documents(documents(rows).repartition(5), shards=8).collect()
    check(rows, found, 8)
    assert all(len(s) == 1 for s in shards_of_texts(rows, found).values())
    assert {r["linked"] for r in found if r["doc_id"] < 300} == {5}


def test_only_pairs(documents):
    """No document is free to fill up: partners change places, and few pairs are cut."""
    rows = [(i, f"pair {i // 2}") for i in range(2000)]
    found = shard_documents(documents(rows).repartition(5), shards=16).collect()
    check(rows, found, 16)
    cut, pairs = cut_links(rows, found)
    assert pairs == 1000 and cut <= 60


def test_a_third_of_all_rows_fills_few_shards(documents):
    rows = [(i, "hot" if i % 3 == 0 else f"group {i % 50}" if i % 3 == 1 else f"own {i}") for i in range(3000)]
    found = shard_documents(documents(rows).repartition(7), shards=16, rows_per_piece=100).collect()
    counts = check(rows, found, 16)
    spread = shards_of_texts(rows, found)
    least = -(-1000 // max(counts))
    assert len(spread["hot"]) <= least + 4
    # Drawn by hash, fifteen in sixteen links would be cut; six full shards would cut 82 in 100.
    cut, pairs = cut_links(rows, found)
    assert cut < 0.9 * pairs
    assert sum(len(s) > 1 for text, s in spread.items() if text != "hot") <= 8


def test_everything_is_one_text(documents):
    rows = [(i, "same") for i in range(1001)]
    check(rows, shard_documents(documents(rows).repartition(4), shards=16).collect(), 16)


def test_random_groups(documents):
    draw = random.Random(11)
    rows = [(i, f"g{int(draw.paretovariate(0.8))}") for i in range(1500)]
    found = shard_documents(documents(rows).repartition(6), shards=5).collect()
    check(rows, found, 5)
    cut, pairs = cut_links(rows, found)
    # The largest text alone has two and a half times the rows of a shard.
    assert cut < 0.7 * pairs


@pytest.mark.parametrize("size", [0, 1, 3, 16, 17])
def test_few_rows(documents, size):
    rows = [(i, "a") for i in range(size)]
    check(rows, shard_documents(documents(rows), shards=16).collect(), 16)


def test_nulls_long_texts_repeated_rows_and_clashes(documents):
    rows = [(1, None), (2, ""), (None, "x" * 2_000_000), (None, "é"), (3, "é"), (3, "é"), (4, "own")]
    clash = {c: "?" for c in ("id", "size", "digest", "row", "held", "shard", "slot", "piece", "cells", "linked", "start", "line")}
    found = shard_documents(documents(rows, **clash), shards=3).collect()
    check(rows, found, 3)
    assert sorted((r["text_crc32"], r["linked"]) for r in found if r["doc_id"] in (1, 2)) == [(0, 2), (0, 2)]
    assert plain_rows(shard_documents(documents(rows, **clash), shards=1)) is not None


def test_one_shard_and_wrong_parameters(documents):
    found = shard_documents(documents([(1, "a"), (2, "a")]), shards=1)
    assert found.agg(F.max("shard")).first()[0] == 0
    with pytest.raises(ValueError):
        shard_documents(documents([]), shards=0)


def test_quotas_keep_capacities():
    draw = random.Random(3)
    for _ in range(50):
        n = draw.randint(1, 6)
        asked = [[0 if i == j else draw.randint(0, 100) for j in range(n)] for i in range(n)]
        load = [draw.randint(50, 150) for _ in range(n)]
        capacity = [draw.randint(80, 150) for _ in range(n)]
        granted = plan_quotas(asked, load, capacity)
        for t in range(n):
            assert all(0 <= granted[s][t] <= asked[s][t] for s in range(n))
            come, go = sum(granted[s][t] for s in range(n)), sum(granted[t])
            assert come <= max(0, capacity[t] - load[t] + go) + n + 1
    # Members that change places need no room.
    assert plan_quotas([[0, 5], [5, 0]], [9, 9], [9, 9]) == [[0, 5], [5, 0]]
