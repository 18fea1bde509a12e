"""Interchange files: layout, replacement, header and line checks."""

import datetime as dt
import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starload.operators.staging import to_staging
from starload.schemas import CSV_COLUMNS
from starload.sources.prices_csv import (
    RAGGED,
    files_by_header,
    read_csv,
    read_csv_day,
    read_csv_judged,
    read_foreign_csv,
    write_csv,
)
from tests.conftest import FAILURE, raw, row, rows_of

DAY_ONE, DAY_TWO = dt.date(2024, 1, 5), dt.date(2024, 1, 6)


def test_round_trip_keeps_text(spark, tmp_path):
    rows = raw(
        spark,
        row("2024-01-02", "NA"),
        row("2024-01-02", "TRUE", price="01.50"),
        ("2024-01-02", None, "2", "0.5", "1.5", None, "000001"),
        row("2024-01-02", 'Q"U,O'),
        row("2024-01-02", "B\\S"),
        row("2024-01-02", " X "),
    )
    path = write_csv(rows, str(tmp_path), DAY_ONE)
    assert path.startswith(f"{tmp_path}/extract_date=20240105/run=")
    assert rows_of(read_csv(spark, path)) == rows_of(rows)


def test_files_have_a_header_and_ascend_by_day(spark, tmp_path):
    rows = raw(spark, *[row(f"2024-01-{d:02}", "IBM") for d in (9, 3, 7, 1)])
    files = sorted(Path(write_csv(rows, str(tmp_path), DAY_ONE)).glob("*.csv"))
    header, *lines = files[0].read_text().splitlines()
    assert header == ",".join(CSV_COLUMNS)
    assert [line[:10] for line in lines] == ["2024-01-01", "2024-01-03", "2024-01-07", "2024-01-09"]


def test_a_day_has_the_latest_run_of_each_symbol(spark, tmp_path):
    first = write_csv(raw(spark, row("2024-01-02", "A"), row("2024-01-02", "B")), str(tmp_path), DAY_ONE)
    write_csv(raw(spark, row("2024-01-02", "A")), str(tmp_path), DAY_TWO)
    second = write_csv(raw(spark, row("2024-01-03", "A")), str(tmp_path), DAY_ONE)
    assert {(r.timestamp, r.symbol) for r in read_csv_day(spark, str(tmp_path), DAY_ONE).collect()} == {
        ("2024-01-03", "A"),
        ("2024-01-02", "B"),
    }
    assert read_csv(spark, first).count() == 2
    assert read_csv(spark, second).count() == 1
    assert read_csv_day(spark, str(tmp_path), DAY_TWO).count() == 1


def test_files_do_not_grow_with_the_symbols(spark, tmp_path):
    rows = spark.range(4000).select(
        F.lit("2024-01-02").alias("timestamp"),
        *[F.lit("1").alias(c) for c in CSV_COLUMNS[1:-1]],
        F.format_string("S%d", "id").alias("symbol"),
    )
    path = write_csv(rows, str(tmp_path), DAY_ONE)
    assert len(list(Path(path).glob("*.csv"))) <= 8
    assert read_csv(spark, path).select("symbol").distinct().count() == 4000


def test_ragged_lines_are_told_from_others(spark, tmp_path):
    file = tmp_path / "x.csv"
    lines = ["2024-01-02,1,1,1,1,1,A", "2024-01-02,1,1,1", "2024-01-02,1,1,1,1,1,B,more", "2024-01-03,,,,,,C"]
    file.write_text("\n".join([",".join(CSV_COLUMNS), *lines]) + "\n")
    rows = read_csv_judged(spark, str(file)).collect()
    assert [(r.timestamp, r.symbol) for r in rows if r.reason is None] == [
        ("2024-01-02", "A"), ("2024-01-03", "C"),
    ]
    assert sorted((r.timestamp, r.symbol, r.reason) for r in rows if r.reason) == [
        (lines[1], None, RAGGED), (lines[2], None, RAGGED),
    ]


def test_a_hot_symbol_is_cut_into_ranges(spark, tmp_path):
    days = [(dt.date(2000, 1, 1) + dt.timedelta(d)).isoformat() for d in range(3000)]
    hot = [row(day, "HOT") for day in days]
    rows = raw(spark, *hot, *[row(days[0], f"S{n}") for n in range(30)])
    laid_out = rows.repartitionByRange(8, "symbol", "timestamp")
    sizes = [len(part) for part in laid_out.rdd.glom().collect()]
    assert max(sizes) < 1000


def test_reordered_header_fails_for_own_files(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text("open,timestamp,high,low,close,volume,symbol\n1,2024-01-02,1,1,1,1,A\n")
    with pytest.raises(FAILURE):
        read_csv(spark, str(file)).collect()


def test_foreign_files_are_read_by_column_name(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text(
        "open,timestamp,extra,high,low,close,volume,symbol\n1.5,2024-01-02,x,1.5,1.5,1.5,10,A\n"
    )
    assert rows_of(read_foreign_csv(spark, str(file))) == {row("2024-01-02", "A")}


def test_foreign_files_double_their_quotes(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text(f'{",".join(CSV_COLUMNS)}\n2024-01-02,1,1,1,1,1,"A""B,C"\n')
    assert [r.symbol for r in read_foreign_csv(spark, str(file)).collect()] == ['A"B,C']


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        ("timestamp,open,high,low,close,symbol\n2024-01-02,1,1,1,1,A\n", "no column volume"),
        (f"{','.join(CSV_COLUMNS)},open\n2024-01-02,1,1,1,1,1,A,2\n", "two columns open"),
        ("", "no header"),
    ],
)
def test_foreign_files_with_an_unusable_header_fail(spark, tmp_path, text, reason):
    (tmp_path / "good.csv").write_text(f"{','.join(CSV_COLUMNS)}\n2024-01-02,1,1,1,1,1,A\n")
    (tmp_path / "x.csv").write_text(text)
    with pytest.raises(ValueError, match=reason):
        read_foreign_csv(spark, str(tmp_path))


def test_foreign_files_are_read_by_their_own_headers(spark, tmp_path):
    own = row("2024-01-02", "A", "1", "1")
    (tmp_path / "a.csv").write_text(f"{','.join(CSV_COLUMNS)}\n2024-01-02,1,1,1,1,1,A\n")
    (tmp_path / "b.csv").write_text(
        "\ufeffopen,timestamp,high,low,close,volume,symbol\r\n2,2024-01-02,2,2,2,1,B\r\n"
    )
    with gzip.open(tmp_path / "c.csv.gz", "wt") as file:
        file.write('x,"x",symbol,volume,close,low,high,open,timestamp\n"a,b",,C,1,3,3,3,3,2024-01-02\n')
    (tmp_path / "d.csv").write_text(f"{','.join(CSV_COLUMNS)}\n2024-01-02,4,4,4,4,1,D\n")
    (tmp_path / "_hidden.csv").write_text("nonsense\n")
    found = read_foreign_csv(spark, str(tmp_path))
    wanted = {(own[0], p, p, p, p, "1", s) for p, s in zip("1234", "ABCD", strict=True)}
    assert rows_of(found) == wanted
    # Files with equal headers are one scan.
    assert len(files_by_header(spark, str(tmp_path))) == 3
    assert rows_of(read_foreign_csv(spark, str(tmp_path / "a.csv"))) == {own}


@pytest.mark.parametrize("line", ["1,2024-01-02,1,1,1,1", "1,2024-01-02,1,1,1,1,B,more"])
def test_ragged_lines_of_foreign_files_fail(spark, tmp_path, line):
    header = "open,timestamp,high,low,close,volume,symbol"
    (tmp_path / "x.csv").write_text(f"{header}\n1,2024-01-02,1,1,1,1,B\n{line}\n")
    with pytest.raises(FAILURE):
        read_foreign_csv(spark, str(tmp_path)).collect()


def test_ragged_line_fails(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text(f"{','.join(CSV_COLUMNS)}\n2024-01-02,1,1,1\n")
    with pytest.raises(FAILURE):
        to_staging(read_csv(spark, str(file))).collect()


def test_header_only_file_has_no_rows(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text(f"{','.join(CSV_COLUMNS)}\n")
    assert read_csv(spark, str(file)).count() == 0


def test_missing_file(spark, tmp_path):
    with pytest.raises(FAILURE, match="PATH_NOT_FOUND"):
        read_csv(spark, str(tmp_path / "nowhere.csv"))
