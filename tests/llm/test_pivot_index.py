from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from starload.llm import pivot_index
from starload.llm.pivot_index import (
    _BLOCK,
    _order_pivots,
    _postings,
    _two_levels,
    choose_pivots,
    describe,
    near_vectors,
)
from tests.conftest import SF_DIR
from tests.llm.conftest import plain_rows

VECTORS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def table(spark, rows, schema=VECTORS):
    return spark.createDataFrame(rows, schema)


def unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def expected(ids, vectors, labels, threshold):
    """(links, component) by comparing all with all."""
    x = unit(np.asarray(vectors, np.float32).astype(float))
    linked = (x @ x.T >= threshold) & (np.asarray(labels)[:, None] == np.asarray(labels)[None, :])
    component = np.asarray(ids)
    while True:
        lower = np.where(linked, component[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (lower == component).all():
            break
        component = lower
    return linked.sum(axis=1) - 1, component


def close_to(pick, base, cosine):
    """A unit vector at just that cosine to each base."""
    noise = pick.normal(size=base.shape)
    noise -= (noise * base).sum(axis=1, keepdims=True) * base
    return cosine * base + np.sqrt(1 - cosine**2) * unit(noise)


def planted(seed, groups=150, at=(0.935, 0.96, 0.99)):
    pick = np.random.default_rng(seed)
    base = unit(pick.normal(size=(groups, 64)))
    copies = [close_to(pick, base, c) for c in at]
    lone = unit(pick.normal(size=(1500, 64)))
    vectors = np.concatenate([base, *copies, lone]).astype(np.float32)
    labels = np.concatenate([np.tile(np.arange(groups) % 3, len(at) + 1), np.arange(1500) % 3])
    order = pick.permutation(len(vectors))
    return vectors[order], labels[order].astype(int)


@pytest.mark.parametrize("block_rows", [100, 4096])
def test_nearly_all_links_even_at_the_threshold(spark, block_rows):
    vectors, labels = planted(1)
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(vectors, labels, strict=True))]
    links, component = expected(np.arange(len(rows)), vectors, labels, 0.93)
    got = {r["vec_id"]: r for r in near_vectors(table(spark, rows), block_rows=block_rows).collect()}
    found = np.array([got[i]["n_links"] for i in range(len(rows))])
    assert (found <= links).all()
    assert found.sum() / links.sum() > 0.97
    assert sum(got[i]["component_id"] == component[i] for i in range(len(rows))) / len(rows) > 0.97


@pytest.mark.parametrize("looked_at", [64, 10**6])
def test_links_are_found_through_few_roots(spark, looked_at):
    vectors, labels = planted(3)
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(vectors, labels, strict=True))]
    links, _ = expected(np.arange(len(rows)), vectors, labels, 0.93)
    got = near_vectors(table(spark, rows), pivots=600, looked_at=looked_at, block_rows=512).collect()
    found = {r["vec_id"]: r["n_links"] for r in got}
    assert all(found[i] <= links[i] for i in range(len(rows)))
    assert sum(found.values()) / links.sum() > 0.97


def test_nearest_pivots_by_their_roots():
    pick = np.random.default_rng(4)
    points = unit(pick.normal(size=(900, 32))).astype(np.float32)
    pivots = _two_levels(points, 400, 0.7)
    x = unit(pick.normal(size=(50, 32))).astype(np.float32)
    assert len(pivots.starts) == len(pivots.roots) + 1 and pivots.starts[-1] == len(pivots.points)
    every = pivots.nearest(x, 8, len(pivots.points))
    assert (every == np.argsort(-(x @ pivots.points.T), axis=1)[:, :8]).all()
    some = pivots.nearest(x, 8, 100)
    for row, numbers in zip(x, some, strict=True):
        order = np.argsort(-(pivots.roots @ row), kind="stable")
        seen = np.zeros(len(pivots.points), bool)
        for root in order:
            if seen.sum() >= 100:
                break
            seen[pivots.starts[root] : pivots.starts[root + 1]] = True
        similar = np.where(seen, pivots.points @ row, -np.inf)
        assert numbers.tolist() == np.argsort(-similar, kind="stable")[:8].tolist()


def test_a_vector_goes_to_a_block_once(spark):
    pick = np.random.default_rng(5)
    vectors = unit(pick.normal(size=(800, 16)))
    rows = [(i, i % 2, 16, 1, v.tolist()) for i, v in enumerate(vectors)]
    nodes = spark.createDataFrame(rows, "node BIGINT, group BIGINT, dimension INT, size BIGINT, vec ARRAY<FLOAT>")
    described = describe(nodes, choose_pivots(nodes, 60), 8, 4096)
    known = _order_pivots(described)
    whole = _postings(described, known, 2, None).select("node", *_BLOCK)
    assert whole.count() == whole.distinct().count() == 800
    cut = _postings(described, known, 2, 300).select("node", *_BLOCK)
    assert cut.count() == cut.distinct().count() < 800 * 7
    assert cut.select("group", "cell").distinct().count() > 4


@pytest.mark.parametrize("block_rows", [64, 400, None])
def test_a_dense_group_and_copies(spark, block_rows):
    pick = np.random.default_rng(2)
    base = unit(pick.normal(size=(1, 64)))
    near = close_to(pick, np.repeat(base, 300, axis=0), 0.985)
    lone = unit(pick.normal(size=(300, 64)))
    vectors = np.concatenate([near, np.repeat(base, 300, axis=0), lone]).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    links, component = expected(np.arange(len(rows)), vectors, [0] * len(rows), 0.93)
    got = {r["vec_id"]: r for r in near_vectors(table(spark, rows), block_rows=block_rows).collect()}
    assert [got[i]["n_links"] for i in range(len(rows))] == links.tolist()
    assert [got[i]["component_id"] for i in range(len(rows))] == component.tolist()


def test_vectors_that_link_with_nothing(spark):
    one = [1.0, 2.0]
    rows = [
        (1, one, 0), (2, one, 0), (3, one, 1), (4, one, None), (5, None, 0), (6, [0.0, 0.0], 0),
        (7, [1.0, None], 0), (8, [1.0, float("nan")], 0), (9, [float("inf"), 1.0], 0), (10, [], 0),
        (11, [2.0, 4.0], 0), (12, [1.0, 2.0, 0.0], 0), (13, one, None),
    ]
    got = {r["vec_id"]: tuple(r)[1:] for r in near_vectors(table(spark, rows)).collect()}
    linked = {1: (2, 1, True), 2: (2, 1, False), 11: (2, 1, False)}
    assert got == {i: linked.get(i, (0, i, True)) for i, *_ in rows}


def test_zeros_have_no_sign(spark):
    rows = [(1, [0.0, 1.0], 0), (2, [-0.0, 1.0], 0), (3, [-0.0, -1.0], 0)]
    got = plain_rows(near_vectors(table(spark, rows)))
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_null_and_repeated_ids(spark):
    rows = [(None, [1.0, 0.0], 0), (4, [1.0, 0.0], 0), (4, [1.0, 0.0], 0), (None, [0.0, 1.0], 0)]
    assert plain_rows(near_vectors(table(spark, rows))) == [
        (4, 2, 4, True), (4, 2, 4, True), (None, 0, None, True), (None, 2, 4, False),
    ]


def test_empty_table_and_clashing_columns(spark):
    assert near_vectors(table(spark, [])).count() == 0
    rows = [(1, [1.0, 0.0], 0, 5, 6), (2, [1.0, 0.01], 0, 5, 6)]
    clash = table(spark, rows, f"{VECTORS}, node INT, size INT")
    assert plain_rows(near_vectors(clash)) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_strange_magnitudes(spark):
    rows = [(1, [1e300, 1e300], 0), (2, [1e-300, 1e-300], 0), (3, [1.0, -1.0], 0)]
    doubles = table(spark, rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT")
    assert {r["vec_id"]: r["n_links"] for r in near_vectors(doubles).collect()} == {1: 1, 2: 1, 3: 0}


def test_embeddings_equal_brute_force(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = sorted((r["vec_id"], r["embedding"], r["label"]) for r in vectors.collect())
    ids, vecs, labels = zip(*rows, strict=True)
    links, component = expected(ids, vecs, labels, 0.3)
    got = {r["vec_id"]: r for r in near_vectors(vectors, threshold=0.3, shared=1, pivots=8).collect()}
    assert sum(got[i]["n_links"] for i in ids) == links.sum() > 0
    assert [got[i]["component_id"] for i in ids] == component.tolist()


@pytest.mark.parametrize(("tile", "at_once", "together"), [(5000, 5000, 0), (100, 64, 0), (64, 100, 10**6)])
def test_a_block_is_compared_alike_in_tiles(monkeypatch, tile, at_once, together):
    for name, value in (("_TILE", tile), ("_ROWS_AT_ONCE", at_once), ("_ROWS_TOGETHER", together)):
        monkeypatch.setattr(pivot_index, name, value)
    pick = np.random.default_rng(6)
    dense = pick.normal(size=(1, 32)) + 0.25 * pick.normal(size=(400, 32))
    vectors = np.concatenate([dense, pick.normal(size=(200, 32))]).astype(np.float32)
    x, n, cells = unit(vectors.astype(float)), 600, 3
    order = np.sort(np.argsort(-(x @ x[pick.permutation(n)[:40]].T), axis=1)[:, :8].astype(np.int32), axis=1)
    shares = {32: np.linspace(0, 1, 40, endpoint=False)}
    has = np.stack([np.bincount(o, minlength=40) for o in order])
    linked = (x @ x.T >= 0.93) & (has @ has.T >= 2) & ~np.eye(n, dtype=bool)
    for b, side in ((0, np.zeros(n, int)), (1, np.arange(n) % 2)):
        found = np.zeros(n, int)
        for cell in range(cells):
            same = {"cell": cell, "dimension": 32, "a": 0, "b": b, "cells": cells, "size": 1}
            block = pa.table({c: [v] * n for c, v in same.items()} | {
                "side": side, "node": np.arange(n), "vec": pa.array(list(vectors)), "order": pa.array(list(order)),
            })
            links = pivot_index._compare_block(block, 0.93, 2, shares)
            np.add.at(found, links["node"].to_numpy(), links["links"].to_numpy())
        meets = linked if not b else linked & (side[:, None] != side[None, :])
        assert (found == meets.sum(axis=1)).all() and found.sum() > 0
