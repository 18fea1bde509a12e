"""Documents that land over time."""

import datetime as dt
import os
from pathlib import Path

import pytest

from starload.plans.load import LoadCounts
from starload.streaming.ingest import ingest
from tests.conftest import FAILURE, land, payload

JAN_2, JAN_3, FEB_1 = "2024-01-02", "2024-01-03", "2024-02-01"


@pytest.fixture
def drop(spark, warehouse, tmp_path):
    """Land documents, run the stream once, return the fact."""

    def go(*documents, **kwargs):
        for number, (symbol, days) in enumerate(documents):
            name = f"{len(list((tmp_path / 'in').rglob('*.json')))}.json"
            land(tmp_path / "in", symbol, payload(days), name)
            # Landing order is the order of modification times.
            stamp = 1_700_000_000 + 10 * int(name.split(".")[0])
            os.utime(tmp_path / "in" / "landed=20240105" / f"symbol={symbol}" / name, (stamp, stamp))
        query = ingest(spark, str(tmp_path / "in"), warehouse, str(tmp_path / "cp"), **kwargs)
        query.awaitTermination()
        rows = warehouse.read(warehouse.fact).collect()
        return {(r.date_key, r.symbol_code): float(r.open_price) for r in rows}

    return go


def prices(value):
    return (value, value, value, value, 1)


def test_each_run_loads_only_what_is_new(warehouse, drop):
    first = drop(("A", {JAN_2: prices(1), FEB_1: prices(1)}), ("B", {JAN_2: prices(2)}))
    assert first == {(20240102, "A"): 1.0, (20240201, "A"): 1.0, (20240102, "B"): 2.0}
    second = drop(("A", {JAN_2: prices(9), JAN_3: prices(9)}))
    assert second == {**first, (20240102, "A"): 9.0, (20240103, "A"): 9.0}
    assert warehouse.read(warehouse.staging).count() == 2
    assert warehouse.read(warehouse.dim_date).count() == 3
    assert drop() == second
    drop(("C", {"2024-03-01": prices(1)}))
    assert warehouse.read(warehouse.staging).count() == 1
    assert warehouse.read(warehouse.dim_date).count() == 4
    assert warehouse.read(warehouse.dim_symbol).count() == 3


def test_last_landed_document_wins_within_a_batch(drop):
    documents = [("A", {JAN_2: prices(v), JAN_3: prices(v)}) for v in (1, 2)]
    assert drop(*documents, ("A", {JAN_2: prices(3)})) == {
        (20240102, "A"): 3.0,
        (20240103, "A"): 2.0,
    }


def test_one_document_per_batch_ends_in_the_same_state(drop):
    documents = [("A", {JAN_2: prices(v), JAN_3: prices(v)}) for v in (1, 2)]
    assert drop(*documents, ("A", {JAN_2: prices(3)}), max_files=1) == {
        (20240102, "A"): 3.0,
        (20240103, "A"): 2.0,
    }


def test_unusable_document_stops_the_stream(spark, warehouse, tmp_path):
    land(tmp_path / "in", "A", '{"Note": "limit"}')
    query = ingest(spark, str(tmp_path / "in"), warehouse, str(tmp_path / "cp"))
    with pytest.raises(FAILURE, match="unusable payload of symbol A"):
        query.awaitTermination()
    assert warehouse.read(warehouse.fact).count() == 0


def test_a_bad_document_does_not_block_the_stream(spark, warehouse, drop, tmp_path):
    rejects = str(tmp_path / "rejects")
    land(tmp_path / "in", "BAD", '{"Note": "limit"}', "bad.json")
    found = drop(("A", {JAN_2: prices(1), JAN_3: (1, 1, 1, 1, "x")}), rejects=rejects)
    assert found == {(20240102, "A"): 1.0}
    assert drop(("A", {FEB_1: prices(2)}), rejects=rejects) == {**found, (20240201, "A"): 2.0}
    documents = spark.read.parquet(f"{rejects}/documents").collect()
    assert [(r.symbol, r.reason) for r in documents] == [("BAD", "no daily series")]
    rows = spark.read.parquet(f"{rejects}/rows").collect()
    assert [(r.timestamp, r.reason) for r in rows] == [(JAN_3, "volume is not a bigint")]


def test_a_repeated_batch_does_not_double_its_rejects(spark, warehouse, tmp_path, monkeypatch):
    rejects, checkpoint = str(tmp_path / "rejects"), str(tmp_path / "cp")
    land(tmp_path / "in", "BAD", "nonsense")
    land(tmp_path / "in", "A", payload({JAN_2: prices(1), JAN_3: (1, 1, 1, 1, "x")}))

    def start():
        return ingest(spark, str(tmp_path / "in"), warehouse, checkpoint, rejects=rejects)

    def die(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr("starload.streaming.ingest.load_fact_counted", die)
        with pytest.raises(FAILURE, match="lost"):
            start().awaitTermination()
    start().awaitTermination()
    assert spark.read.parquet(f"{rejects}/documents").count() == 1
    assert spark.read.parquet(f"{rejects}/rows").count() == 1
    assert warehouse.read(warehouse.fact).count() == 1


def test_packed_documents_in_the_stream(spark, warehouse, tmp_path):
    lines = [payload({f"2024-01-0{d}": prices(d)}) for d in (1, 2, 3)]
    land(tmp_path / "in", "A", "\n".join(lines))
    ingest(spark, str(tmp_path / "in"), warehouse, str(tmp_path / "cp"), packed=True).awaitTermination()
    assert warehouse.read(warehouse.fact).count() == 3


def test_a_file_of_several_documents_stops_the_stream(spark, warehouse, tmp_path):
    lines = [payload({f"2024-01-0{d}": prices(d)}) for d in (1, 2, 3)]
    land(tmp_path / "in", "A", "\n".join(lines))
    with pytest.raises(FAILURE, match="not a valid document"):
        ingest(spark, str(tmp_path / "in"), warehouse, str(tmp_path / "cp")).awaitTermination()


def test_a_late_document_of_an_earlier_day_fills_gaps_only(spark, warehouse, tmp_path):
    def go():
        ingest(spark, str(tmp_path / "in"), warehouse, str(tmp_path / "cp")).awaitTermination()
        rows = warehouse.read(warehouse.fact).collect()
        return {(r.date_key, r.symbol_code): float(r.open_price) for r in rows}

    later, earlier = dt.date(2024, 1, 6), dt.date(2024, 1, 5)
    land(tmp_path / "in", "A", payload({JAN_2: prices(6)}), day=later)
    assert go() == {(20240102, "A"): 6.0}
    late = payload({JAN_2: prices(5), JAN_3: prices(5)})
    land(tmp_path / "in", "A", late, day=earlier)
    assert go() == {(20240102, "A"): 6.0, (20240103, "A"): 5.0}
    # Landed on the later day, but earlier than what was loaded of it.
    path = land(tmp_path / "in", "A", payload({JAN_2: prices(4)}), "early.json", day=later)
    os.utime(f"{path}/landed=20240106/symbol=A/early.json", (1_600_000_000, 1_600_000_000))
    assert go() == {(20240102, "A"): 6.0, (20240103, "A"): 5.0}


def test_the_stream_removes_old_versions(spark, warehouse, drop):
    for value in range(4):
        drop(("A", {JAN_2: prices(value), FEB_1: prices(value)}), keep=dt.timedelta(0))
    folder = Path(warehouse.root)
    assert len(list(folder.glob("storage/fact_files/load=*"))) == 1
    assert len(list(folder.glob("storage/fact_files/load=*/month_key=*"))) == 2
    assert len(list(folder.glob("staging/stock_prices/load=*"))) == 1
    assert warehouse.read(warehouse.fact).count() == 2


def test_the_stream_keeps_versions_for_a_while(spark, warehouse, drop):
    for value in range(3):
        drop(("A", {JAN_2: prices(value)}))
    assert len(list(Path(warehouse.root).glob("storage/fact_files/load=*"))) == 3


def test_the_stream_audits_before_it_writes_the_fact(spark, warehouse, drop):
    first = drop(("A", {JAN_2: prices(1)}))
    warehouse.append(warehouse.dim_symbol, warehouse.read(warehouse.dim_symbol))
    with pytest.raises(FAILURE, match="symbol_code unique"):
        drop(("A", {JAN_3: prices(2)}))
    rows = warehouse.read(warehouse.fact).collect()
    assert {(r.date_key, r.symbol_code): float(r.open_price) for r in rows} == first
    assert drop(check=False) == {**first, (20240103, "A"): 2.0}


def test_the_stream_tells_what_it_counted(drop, tmp_path):
    told = {}
    drop(
        ("A", {JAN_2: prices(1), JAN_3: (1, 1, 1, 1, "x")}), ("B", {JAN_2: prices(1)}),
        rejects=str(tmp_path / "bad"), on_load=told.__setitem__,
    )
    drop(("B", {JAN_2: prices(3), FEB_1: prices(1)}), on_load=told.__setitem__)
    assert told == {
        0: LoadCounts(documents=2, read_rows=3, rejected_rows=1, staged_rows=2, inserted_rows=2),
        1: LoadCounts(documents=1, read_rows=2, staged_rows=2, inserted_rows=1, replaced_rows=1),
    }
