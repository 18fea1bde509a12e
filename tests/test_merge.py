"""Insert-ignore, surrogate keys, upsert; checked against plain dictionaries."""

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starload.operators.merge import (
    assign_keys,
    duplicate_keys,
    insert_ignore,
    latest_per_key,
    upsert,
)
from tests.conftest import FAILURE, rows_of

SCHEMA = "k INT, s STRING, a DECIMAL(10,4), b BIGINT"
KEYS = ["k", "s"]


def table(spark, rows):
    return spark.createDataFrame(rows, "k INT, s STRING, a STRING, b BIGINT").withColumn(
        "a", F.col("a").cast("decimal(10,4)")
    )


def test_insert_ignore_keeps_the_first(spark):
    target = spark.createDataFrame([(1, "old")], "k INT, v STRING")
    new = spark.createDataFrame([(1, "new"), (2, "x"), (2, "x"), (3, "y")], "k INT, v STRING")
    assert rows_of(insert_ignore(target, new, ["k"])) == {(2, "x"), (3, "y")}
    assert insert_ignore(target, new, ["k"]).count() == 2


def test_keys_go_on_after_the_largest_and_have_no_gaps(spark):
    target = spark.createDataFrame([(7, "OLD")], "id INT, code STRING")
    codes = [f"S{n}" for n in range(500)]
    new = spark.createDataFrame([(c,) for c in codes], "code STRING")
    keyed = assign_keys(target, new, "id", "code")
    assert dict(keyed.dtypes)["id"] == "int"
    by_digest = sorted(codes, key=lambda c: hashlib.md5(c.encode()).hexdigest())
    assert {(r.code, r.id) for r in keyed.collect()} == {
        (c, 8 + position) for position, c in enumerate(by_digest)
    }


def test_no_task_numbers_all_codes(spark):
    target = spark.createDataFrame([], "id INT, code STRING")
    new = spark.range(5000).select(F.format_string("S%d", "id").alias("code"))
    keyed = assign_keys(target, new, "id", "code")
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "row_number()" in line:
            assert "_bucket" in line.split("windowspecdefinition(")[1].split(",")[0]


def test_upsert_replaces_all_measures_even_by_null(spark):
    old = table(spark, [(1, "A", "1", 10), (2, "A", "2", 20), (1, "B", "3", 30)])
    new = table(spark, [(1, "A", "9", None), (3, "A", None, 5)])
    merged = upsert(old, new, KEYS)
    assert merged.columns == old.columns
    assert rows_of(merged) == rows_of(
        table(spark, [(1, "A", "9", None), (2, "A", "2", 20), (1, "B", "3", 30), (3, "A", None, 5)])
    )


def test_upsert_twice_is_upsert_once(spark):
    old = table(spark, [(1, "A", "1", 10), (2, "A", "2", 20)])
    new = table(spark, [(2, "A", "5", 50), (3, "A", "6", 60)])
    once = upsert(old, new, KEYS)
    assert rows_of(upsert(once, new, KEYS)) == rows_of(once)


@pytest.mark.parametrize("bad", [[(1, "A", "1", 1), (1, "A", "2", 2)], [(1, None, "1", 1)]])
def test_upsert_conflicts_fail(spark, bad):
    with pytest.raises(FAILURE, match="NULL or repeated key"):
        upsert(table(spark, []), table(spark, bad), KEYS).collect()


def test_conflict_check_survives_pruning(spark):
    twice = table(spark, [(1, "A", "1", 1), (1, "A", "1", 1)])
    with pytest.raises(FAILURE, match="NULL or repeated key"):
        upsert(table(spark, []), twice, KEYS).count()


def test_upsert_is_one_sort_over_one_shuffle(spark):
    merged = upsert(table(spark, [(1, "A", "1", 10)]), table(spark, [(2, "A", "2", 20)]), KEYS)
    plan = merged.sortWithinPartitions(*KEYS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    assert plan.count("Sort [") == 1
    assert "Aggregate" not in plan and "Join" not in plan


def test_latest_per_key_combines_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS s", "id AS t")
    plan = latest_per_key(df, ["s"], [F.col("t")])._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange ")[1]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_duplicate_keys(spark):
    df = table(spark, [(1, "A", "1", 1), (1, "A", "2", 2), (1, "B", "1", 1)])
    assert rows_of(duplicate_keys(df, KEYS)) == {(1, "A", 2)}


def test_latest_per_key_keeps_nulls_of_the_latest(spark):
    df = spark.createDataFrame(
        [("A", 1, "x"), ("A", 2, None), ("B", 1, "y")], "s STRING, t INT, v STRING"
    )
    assert rows_of(latest_per_key(df, ["s"], [F.col("t")])) == {("A", 2, None), ("B", 1, "y")}


batch = st.dictionaries(
    st.tuples(st.integers(1, 4), st.sampled_from("AB")),
    st.tuples(st.none() | st.integers(0, 9), st.none() | st.integers(0, 9)),
    max_size=8,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches=st.lists(batch, min_size=1, max_size=3))
def test_upserts_equal_dictionary_updates(spark, batches):
    """Splitting rows into batches any way ends where updating a dictionary in turn ends."""
    expected = {}
    merged = spark.createDataFrame([], "k INT, s STRING, a INT, b INT")
    for rows in batches:
        expected.update(rows)
        data = [(*key, *values) for key, values in rows.items()]
        merged = upsert(merged, spark.createDataFrame(data, "k INT, s STRING, a INT, b INT"), KEYS)
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(
        ((*key, *values) for key, values in expected.items()), key=str
    )
