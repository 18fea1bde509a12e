from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starload.llm import cuckoo, line_dedup
from starload.llm.line_dedup import LineStore, drop_frequent_lines
from tests.conftest import FAILURE
from tests.llm.conftest import by_id, plain_rows

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def expected(rows, min_docs, min_chars=1):
    held = Counter()
    for _, text in rows:
        held.update({k for k in map(key, (text or "").split("\n")) if len(k) >= min_chars})
    result = {}
    for name, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if held[key(x)] < min_docs]
        result[name] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return result


def made(seed=1, documents=200):
    pick = random.Random(seed)
    pool = ["License MIT", "  license mit\t", "É line", "é line", "", " ", "\r", "x", "Ünïque\x0b"]
    pool += [f"line {i}" for i in range(60)]
    return [(i, "\n".join(pick.choices(pool, k=pick.randint(0, 12)))) for i in range(documents)]


def check(found, rows, **how):
    wanted = expected(rows, **how)
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in found.collect()}
    assert got == wanted


@pytest.mark.parametrize("min_chars", [1, 3])
def test_equals_counting(documents, min_chars):
    rows = [*made(), (900, None), (901, ""), (902, "License MIT\n" * 5000)]
    check(
        drop_frequent_lines(documents(rows), min_docs=10, min_chars=min_chars), rows,
        min_docs=10, min_chars=min_chars,
    )


def test_insert_and_remove_are_exact(spark, documents, tmp_path):
    first, second = made(1), [(i + 1000, t) for i, t in made(2, 150)]
    store = LineStore(spark, str(tmp_path / "s"), min_docs=10, shards=5)
    store.insert(documents(first))
    alone = sorted(map(tuple, store.counts().collect()))
    check(store.apply(documents(first)), first, min_docs=10)
    store.insert(documents(second))
    both = expected(first + second, 10)
    got = {r["doc_id"]: r["text"] for r in store.apply(documents(first + second)).collect()}
    assert got == {name: text for name, (text, *_) in both.items()}
    store.remove(documents(second))
    assert sorted(map(tuple, store.counts().collect())) == alone
    check(store.apply(documents(first)), first, min_docs=10)


def test_a_store_opened_again_goes_on(spark, documents, tmp_path):
    first, second = made(1), [(i + 1000, t) for i, t in made(2, 150)]
    path = str(tmp_path / "s")
    LineStore(spark, path, min_docs=10, shards=5).insert(documents(first))
    alone = sorted(map(tuple, LineStore(spark, path, min_docs=10).counts().collect()))
    again = LineStore(spark, path, min_docs=10)
    assert (again.version, again.shards) == (1, 5)
    check(again.apply(documents(first)), first, min_docs=10)
    again.insert(documents(second))
    check(LineStore(spark, path, min_docs=10).apply(documents(first + second)), first + second, min_docs=10)
    for wrong in ({"min_docs": 9}, {"min_docs": 10, "min_chars": 2}, {"min_docs": 10, "shards": 4}):
        with pytest.raises(ValueError, match="was made with"):
            LineStore(spark, path, **wrong)
    # A change that dies leaves the version before it.
    with pytest.raises(FAILURE):
        LineStore(spark, path, min_docs=10).remove(documents([(1, "never inserted")]))
    last = LineStore(spark, path, min_docs=10)
    assert last.version == 2
    last.remove(documents(second))
    assert last.version == 3
    assert sorted(map(tuple, LineStore(spark, path, min_docs=10).counts().collect())) == alone


def test_two_objects_may_take_turns(spark, documents, tmp_path):
    one, two, other = (LineStore(spark, str(tmp_path / "s"), min_docs=2, shards=n) for n in (2, 2, 3))
    one.insert(documents([(1, "a")]))
    two.insert(documents([(2, "a")]))
    with pytest.raises(ValueError, match="was made with"):
        other.insert(documents([(3, "a")]))
    assert [r["n"] for r in one.counts().collect()] == [1]
    assert [r["n"] for r in two.counts().collect()] == [2]


def test_versions_without_their_settings_are_not_overwritten(spark, documents, tmp_path):
    store = LineStore(spark, str(tmp_path / "s"), min_docs=2, shards=2)
    (tmp_path / "s" / "version=1").mkdir(parents=True)
    with pytest.raises(ValueError, match="does not say"):
        store.insert(documents([(1, "a")]))


def test_keys_travel_where_filters_are_too_large(spark, documents, tmp_path):
    rows = [*made(), (900, None), (901, "")]
    store = LineStore(spark, str(tmp_path / "s"), min_docs=10, shards=5, max_broadcast_bytes=0)
    store.insert(documents(rows))
    check(store.apply(documents(rows)), rows, min_docs=10)


def test_a_stranger_cannot_be_removed(spark, documents, tmp_path):
    """Not even one whose lines are all in the store, nor a member once too often."""
    store = LineStore(spark, str(tmp_path / "s"), min_docs=10, shards=3)
    rows = [(i, f"shared\nown {i}") for i in range(12)]
    store.insert(documents(rows))
    before = sorted(map(tuple, store.counts().collect()))
    strangers = [[(100 + i, "shared") for i in range(3)], [(1, "shared")], [(50, rows[1][1])], [(None, "shared")]]
    for some in [*strangers, [rows[1], rows[1]]]:
        with pytest.raises(FAILURE, match="not in the store"):
            store.remove(documents(some))
        assert sorted(map(tuple, store.counts().collect())) == before
    check(store.apply(documents(rows)), rows, min_docs=10)
    store.remove(documents(rows[:3]))
    check(store.apply(documents(rows[3:])), rows[3:], min_docs=10)
    with pytest.raises(FAILURE, match="not in the store"):
        store.remove(documents(rows[:1]))


def test_a_document_may_be_in_the_store_several_times(spark, documents, tmp_path):
    store = LineStore(spark, str(tmp_path / "s"), min_docs=3, shards=2)
    row = [(None, "a")]
    for _ in range(3):
        store.insert(documents(row))
    assert [r["n"] for r in store.members().collect()] == [3]
    assert store.apply(documents(row)).first()["text"] == ""
    store.remove(documents(row))
    assert store.apply(documents(row)).first()["text"] == "a"
    store.remove(documents(row * 2))
    assert store.counts().count() == store.members().count() == 0


def test_shards_are_doubled_as_the_store_grows(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(line_dedup, "_SHARD_KEYS", 20)
    path = str(tmp_path / "s")
    first, second = made(1, 40), [(2000 + i, f"own é {i}\nand {i}\nLicense MIT") for i in range(300)]
    store = LineStore(spark, path, min_docs=5)
    store.insert(documents(first))
    few, alone = store.shards, sorted((r["hi"], r["lo"], r["n"]) for r in store.counts().collect())
    check(store.apply(documents(first)), first, min_docs=5)
    store.insert(documents(second))
    assert store.shards > few and store.shards & (store.shards - 1) == 0
    assert max(r["count"] for r in store.counts().groupBy("shard").count().collect()) < 60
    again = LineStore(spark, path, min_docs=5)
    assert again.shards == store.shards
    check(again.apply(documents(first + second)), first + second, min_docs=5)
    again.remove(documents(second))
    assert sorted((r["hi"], r["lo"], r["n"]) for r in again.counts().collect()) == alone
    check(again.apply(documents(first)), first, min_docs=5)


def buckets(path):
    """(version, table, bucket) of all that a store holds."""
    found = path.glob("version=*/*/bucket=*")
    return {tuple(p.relative_to(path).parts) for p in found}


def test_old_versions_go(spark, documents, tmp_path):
    store = LineStore(spark, str(tmp_path / "s"), min_docs=2, shards=1)
    for i in range(4):
        store.insert(documents([(i, "a")]))
    versions = {p.name: {q.name for q in p.iterdir() if not q.name.startswith(".")} for p in (tmp_path / "s").glob("version=*")}
    assert versions == {f"version={n}": {"members", "counts", "filters", "complete"} for n in (3, 4)}


def test_a_change_writes_only_the_buckets_it_meets(spark, documents, tmp_path, monkeypatch):
    path = tmp_path / "s"
    first = made(1, 60)
    store = LineStore(spark, str(path), min_docs=3, shards=32)
    store.insert(documents(first))
    whole = buckets(path)
    # Two documents with a new line, and one line that crosses the threshold by them.
    small = [(5000, "brand new\nline 1"), (5001, "brand new\nline 1")]
    store.insert(documents(small))
    written = {b for b in buckets(path) if b[0] == "version=2"}
    assert len([b for b in written if b[1] == "counts"]) <= 2 and len([b for b in written if b[1] == "members"]) <= 2
    assert {b for b in buckets(path) if b[0] == "version=1"} == whole
    again = LineStore(spark, str(path), min_docs=3)
    check(again.apply(documents(first + small)), first + small, min_docs=3)
    again.remove(documents(small))
    check(LineStore(spark, str(path), min_docs=3).apply(documents(first)), first, min_docs=3)
    # What is of no use any more goes bucket by bucket.
    for i in range(3):
        again.insert(documents([(6000 + i, "brand new")]))
    counts = [b for v, t, b in buckets(path) if t == "counts"]
    assert len(counts) <= len({b for _, t, b in whole if t == "counts"}) + 2
    assert len(list(path.glob("version=*/complete"))) == 2
    # Once many versions hold parts of the store, a change writes all of it.
    monkeypatch.setattr(line_dedup, "_MAX_VERSIONS", 2)
    again.insert(documents([(7000, "z")]))
    assert {v for held in again._held.values() for v in held if v} == {again.version}
    rows = [*first, *((6000 + i, "brand new") for i in range(3)), (7000, "z")]
    check(LineStore(spark, str(path), min_docs=3).apply(documents(rows)), rows, min_docs=3)


def test_buckets_hold_several_shards(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(line_dedup, "_BUCKETS", 4)
    first, second = made(1, 60), [(i + 1000, t) for i, t in made(2, 40)]
    store = LineStore(spark, str(tmp_path / "s"), min_docs=5, shards=10)
    store.insert(documents(first))
    alone = sorted(map(tuple, store.counts().collect()))
    store.insert(documents(second))
    assert {b for _, _, b in buckets(tmp_path / "s")} == {f"bucket={i}" for i in range(4)}
    check(store.apply(documents(first + second)), first + second, min_docs=5)
    store.remove(documents(second))
    assert sorted(map(tuple, store.counts().collect())) == alone
    check(store.apply(documents(first)), first, min_docs=5)


def test_shards_grow_with_the_corpus(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(line_dedup, "_SHARD_KEYS", 20)
    rows = [*made(), *((2000 + i, f"own é {i}\nand {i}") for i in range(300))]
    store = LineStore(spark, str(tmp_path / "s"), min_docs=10)
    store.insert(documents(rows))
    assert store.shards >= 600 // 20
    assert max(r["count"] for r in store.counts().groupBy("shard").count().collect()) < 60
    check(LineStore(spark, str(tmp_path / "s"), min_docs=10).apply(documents(rows)), rows, min_docs=10)


def test_removing_what_was_never_inserted_fails(spark, documents, tmp_path):
    store = LineStore(spark, str(tmp_path / "s"), min_docs=2, shards=2)
    store.insert(documents([(1, "a")]))
    with pytest.raises(FAILURE):
        store.remove(documents([(2, "b")]))
    assert store.version == 1


def test_repeated_rows_and_ids_count_each(documents):
    rows = [(1, "a\nb"), (1, "a"), (None, "a"), (None, "c")]
    found = drop_frequent_lines(documents(rows), min_docs=3)
    assert sorted(r["text"] for r in found.collect()) == ["", "", "b", "c"]
    rows = [(1, "a\nb")] * 3
    assert plain_rows(drop_frequent_lines(documents(rows), min_docs=3).select("text")) == [("",)] * 3


def test_empty_table_and_clashing_columns(documents):
    assert drop_frequent_lines(documents([])).count() == 0
    clash = {c: "?" for c in ("shard", "hi", "lo", "n", "n_lines", "_digest", "_gone")}
    found = drop_frequent_lines(documents([(1, "a")], **clash))
    row = by_id(found)[1]
    assert (row["text"], row["n_lines"], row["hi"], row["_gone"]) == ("a", 1, "?", "?")
    assert found.columns.count("n_lines") == 1


def words(numbers):
    return np.array(numbers, np.uint64)


@settings(max_examples=30, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 2**64 - 1), st.integers(0, 2**64 - 1)), max_size=200))
def test_filters_never_miss_and_can_forget(keys):
    keys = list(keys)
    hi, lo = words([k[0] for k in keys]), words([k[1] for k in keys])
    slots = cuckoo.build(hi, lo)
    assert cuckoo.Shards({0: slots}, 1).contains(hi, lo).all()
    half = len(keys) // 2
    cuckoo.delete(slots, hi[:half], lo[:half])
    assert cuckoo.Shards({0: slots}, 1).contains(hi[half:], lo[half:]).all()
    cuckoo.delete(slots, hi[half:], lo[half:])
    assert not slots.any()


def test_filters_err_seldom():
    pick = np.random.default_rng(5)
    keys = pick.integers(0, 2**64, (40_000, 2), np.uint64)
    slots = cuckoo.build(keys[:20_000, 0], keys[:20_000, 1])
    wrong = cuckoo.Shards({0: slots}, 1).contains(keys[20_000:, 0], keys[20_000:, 1])
    assert wrong.mean() < 0.001
