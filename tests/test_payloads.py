"""Landed documents: validity, order, repeated days, odd symbols."""

import datetime as dt
import json
import random

import pytest

from starload.schemas import SERIES_KEY
from starload.sources.payloads import (
    explode_series,
    parse_payloads,
    read_landing,
    require_usable,
    split_payloads,
)
from tests.conftest import FAILURE, land, payload

DAY = ("1", "2", "0.5", "1.5", "100")


def parsed(spark, path, **kwargs):
    return parse_payloads(read_landing(spark, path, **kwargs))


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        ('{"Note": "limit"}', "no daily series"),
        (f'{{"{SERIES_KEY}": null}}', "no daily series"),
        ("<html></html>", "not a valid document"),
        (payload({"2024-01-02": DAY})[:-5], "not a valid document"),
        (f'{{"{SERIES_KEY}": [1, 2]}}', "not a valid document"),
        (f"{{'{SERIES_KEY}': {{}}}}", "not a valid document"),
        (payload({"2024-01-02": DAY}) * 2, "not a valid document"),
        (payload({"2024-01-02": DAY}) + "\n" + payload({"2024-01-03": DAY}), "not a valid document"),
        (payload({"2024-01-02": DAY}) + ", " + payload({"2024-01-03": DAY}), "not a valid document"),
        (payload({"2024-01-02": DAY}) + " trailing", "not a valid document"),
        (payload({"2024-01-02": DAY}) + "]", "not a valid document"),
        (payload({"2024-01-02": DAY}) + ", 1] x", "not a valid document"),
        (" ", "not a valid document"),
        (f'{{"{SERIES_KEY}": {{}}}}', "empty daily series"),
        (f'{{"{SERIES_KEY}": {{"2024-01-02": null}}}}', "day without values"),
    ],
)
def test_unusable_document(spark, tmp_path, text, reason):
    land(tmp_path, "GOOD", payload({"2024-01-02": DAY}))
    path = land(tmp_path, "BAD", text)
    good, rejects = split_payloads(parsed(spark, path))
    assert [r.symbol for r in good.collect()] == ["GOOD"]
    assert [(r.symbol, r.reason) for r in rejects.collect()] == [("BAD", reason)]
    with pytest.raises(FAILURE, match=f"symbol BAD: {reason}"):
        explode_series(require_usable(parsed(spark, path))).collect()


def test_days_ascend_and_extra_fields_are_ignored(spark, tmp_path):
    document = json.loads(payload({"2024-01-03": DAY, "2023-12-29": DAY, "2024-01-02": DAY}))
    document[SERIES_KEY]["2024-01-02"]["6. extra"] = "x"
    document["Meta Data"] = {"2. Symbol": "OTHER"}
    path = land(tmp_path, "IBM", json.dumps(document))
    rows = explode_series(parsed(spark, path)).collect()
    assert [r.timestamp for r in rows] == ["2023-12-29", "2024-01-02", "2024-01-03"]
    assert {r.symbol for r in rows} == {"IBM"}
    assert (rows[0].open, rows[0].high, rows[0].low, rows[0].close, rows[0].volume) == DAY


def test_last_of_a_repeated_day_wins(spark, tmp_path):
    text = (
        f'{{"{SERIES_KEY}": {{"2024-01-02": {{"1. open": "9"}}, "2024-01-01": {{"1. open": "7"}}, '
        '"2024-01-02": {"1. open": "2"}}}'
    )
    path = land(tmp_path, "IBM", text)
    rows = explode_series(parsed(spark, path)).collect()
    assert [(r.timestamp, r.open, r.volume) for r in rows] == [
        ("2024-01-01", "7", None),
        ("2024-01-02", "2", None),
    ]


def test_random_documents_read_as_a_json_parser_reads_them(spark, tmp_path):
    rng = random.Random(7)
    expected = set()
    for number in range(40):
        symbol = f"S{number}"
        days = [f"2024-01-{rng.randint(1, 9):02}" for _ in range(rng.randint(1, 30))]
        entries = ", ".join(f'"{day}": {{"1. open": "{rng.random():.4f}"}}' for day in days)
        text = f'{{"{SERIES_KEY}": {{{entries}}}}}'
        path = land(tmp_path, symbol, text)
        series = json.loads(text)[SERIES_KEY]
        expected |= {(day, values["1. open"], symbol) for day, values in series.items()}
    rows = explode_series(require_usable(parsed(spark, path))).collect()
    assert len(rows) == len(expected)
    assert {(r.timestamp, r.open, r.symbol) for r in rows} == expected


def test_symbols_stay_text_and_prune_the_scan(spark, tmp_path):
    for symbol in ("NA", "TRUE", "000001", "Brand%2312"):
        path = land(tmp_path, symbol, payload({"2024-01-02": DAY}))
    rows = explode_series(parsed(spark, path)).collect()
    assert sorted(r.symbol for r in rows) == ["000001", "Brand#12", "NA", "TRUE"]
    one = read_landing(spark, path, symbols=["000001"])
    assert [r.symbol for r in one.collect()] == ["000001"]
    assert "PartitionFilters: [(symbol" in one._jdf.queryExecution().toString().replace(
        "isnotnull(symbol", "(symbol"
    )


def test_blanks_around_a_document_are_no_fault(spark, tmp_path):
    path = land(tmp_path, "IBM", " \n" + payload({"2024-01-02": DAY}) + " \n\t ")
    assert explode_series(require_usable(parsed(spark, path))).count() == 1


def test_a_day_is_read_by_itself(spark, tmp_path):
    other = dt.date(2024, 1, 6)
    land(tmp_path, "A", payload({"2024-01-02": DAY}))
    path = land(tmp_path, "B", payload({"2024-01-02": DAY}), day=other)
    assert {r.symbol for r in read_landing(spark, path).collect()} == {"A", "B"}
    one = read_landing(spark, path, other)
    assert [r.symbol for r in one.collect()] == ["B"]
    assert all("landed=20240106" in file for file in one.inputFiles())


def test_packed_documents(spark, tmp_path):
    lines = [payload({f"2024-01-0{d}": DAY}) for d in (1, 2, 3)]
    path = land(tmp_path, "IBM", "\n".join(lines))
    rows = explode_series(require_usable(parsed(spark, path, packed=True)))
    assert sorted(r.timestamp for r in rows.collect()) == ["2024-01-01", "2024-01-02", "2024-01-03"]


def test_missing_folder(spark, tmp_path):
    with pytest.raises(FAILURE, match="PATH_NOT_FOUND"):
        read_landing(spark, str(tmp_path / "nowhere"))


def test_a_document_is_parsed_once(spark, tmp_path):
    path = land(tmp_path, "IBM", payload({"2024-01-02": DAY}))
    rows = explode_series(require_usable(parsed(spark, path)))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    assert "Exchange" not in plan
