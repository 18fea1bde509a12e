from __future__ import annotations

import hashlib
from collections import defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starload.llm.exact_dedup import (
    _merge_along,
    digests,
    exact_dedup,
    first_runs,
    merge_round,
)
from starload.session import stored
from tests.llm.conftest import by_id, plain_rows

ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "A"), (7, "a "), (8, "a"), (9, "x" * 200_000)]


def expected(rows, choose):
    groups = defaultdict(list)
    for name, text in rows:
        groups[text or ""].append(name)
    return sorted(
        (
            name, choose(groups[text or ""]), len(groups[text or ""]),
            name == choose(groups[text or ""]), hashlib.sha256((text or "").encode()).hexdigest(),
        )
        for name, text in rows
    )


@pytest.mark.parametrize(("keep", "choose"), [("smallest", min), ("largest", max)])
@pytest.mark.parametrize("fan_in", [2, 8])
def test_equals_grouping(documents, keep, choose, fan_in):
    rows = ROWS + [(100 + i, f"t{i % 17}") for i in range(300)]
    table = documents(rows).repartition(7)
    found = exact_dedup(table, keep=keep, fan_in=fan_in, rows_per_shard=10)
    assert sorted(map(tuple, found.collect())) == expected(rows, choose)


def test_one_text_for_a_third_of_the_rows(documents):
    rows = [(i, "same" if i % 3 == 0 else f"own {i}") for i in range(900)]
    found = by_id(exact_dedup(documents(rows).repartition(9)))
    assert {found[i]["keep_id"] for i in range(0, 900, 3)} == {0}
    assert found[3]["group_size"] == 300
    assert all(found[i]["kept"] for i in range(900) if i % 3)


def test_null_ids_never_win(documents):
    found = exact_dedup(documents([(None, "a"), (3, "a"), (None, "b")])).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["kept"]) for r in found) == [
        ("3", "3", True), ("None", "3", False), ("None", "None", True),
    ]


def test_repeated_rows_share_their_fate(documents):
    found = exact_dedup(documents([(1, "a"), (1, "a"), (2, "a")])).collect()
    assert sorted((r["doc_id"], r["kept"], r["group_size"]) for r in found) == [
        (1, True, 3), (1, True, 3), (2, False, 3),
    ]


def test_empty_table_and_clashing_columns(documents):
    assert exact_dedup(documents([])).count() == 0
    clash = {c: "?" for c in ("id", "digest", "sha256", "run", "shard", "best", "size", "kept")}
    assert plain_rows(exact_dedup(documents(ROWS, **clash))) == plain_rows(exact_dedup(documents(ROWS)))


def test_wrong_parameters(documents):
    with pytest.raises(ValueError):
        exact_dedup(documents([]), keep="first")
    with pytest.raises(ValueError):
        exact_dedup(documents([]), fan_in=3)


def test_every_level_is_in_order(spark, documents):
    """Whole files, row by row: each run ascends, and holds a digest once."""
    table = documents([(i, f"t{i % 40}") for i in range(400)]).repartition(9)
    better = F.asc_nulls_last("best")
    entries = stored(digests(table, "doc_id", "text").withColumn("part", F.spark_partition_id()), "d", "part")
    level = first_runs(entries, 4, better)
    assert "Sort [" in level._jdf.queryExecution().executedPlan().toString()
    left = None
    while left is None or left > 1:
        level = stored(level, "level")
        rows = 0
        for file in level.inputFiles():
            read = pq.read_table(file.removeprefix("file://")).to_pylist()
            keys = [(r["shard"], r["run"], r["digest"] , r["sha256"]) for r in read]
            assert keys == sorted(set(keys))
            rows += sum(r["size"] for r in read)
        assert rows == 400
        left = level.select("run").distinct().count()
        if left > 1:
            assert level.count() > 40
            level = merge_round(level, 2, better)
            plan = level._jdf.queryExecution().executedPlan().toString()
            assert "Sort [" in plan and "Aggregate" not in plan
    assert level.count() == 40
    assert {r["best"] for r in level.collect()} == set(range(40))


def test_a_merge_holds_one_batch_whatever_the_length():
    """Equal entries over many batches become one; nothing is kept but the last entry."""
    names = ["shard", "run", "digest", "sha256", "best", "size"]
    most = 0

    def batches():
        nonlocal most
        for n in range(300):
            digest = [5] * 1000 if n < 200 else [n * 1000 + i for i in range(1000)]
            columns = [[0] * 1000, [0] * 1000, digest, [b"x"] * 1000, [n] * 1000, [1] * 1000]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            # As Spark's batches come: some columns cannot be null.
            fields = [pa.field(n, t, nullable=n != "size") for n, t in zip(names, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))
            most = max(most, pa.total_allocated_bytes())

    before = pa.total_allocated_bytes()
    found = [(b.num_rows, b.column(5).to_pylist()[0], b.column(4).to_pylist()[0]) for b in _merge_along(batches())]
    assert sum(n for n, _, _ in found) == 1 + 100 * 1000
    assert found[0][1:] == (200_000, 0)
    assert most - before < 2_000_000


def test_identifiers_of_any_type(spark):
    rows = [("b", "x"), ("a", "x"), (None, "x"), ("c", "y")]
    table = spark.createDataFrame(rows, "doc_id STRING, text STRING").repartition(3)
    found = {r["doc_id"]: r["keep_id"] for r in exact_dedup(table).collect()}
    assert found == {"a": "a", "b": "a", None: "a", "c": "c"}
