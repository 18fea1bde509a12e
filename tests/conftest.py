from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from starload.plans.warehouse import Warehouse
from starload.schemas import FIELDS, SERIES_KEY
from starload.session import local_session

SF_DIR = "/root/testdata/sf0.01"
# How a failed check surfaces: as a Spark error, or as the error of the aborted job.
FAILURE = (PySparkException, Py4JJavaError)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("starload-tests", shared=shared)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    """An empty warehouse that no other test sees."""
    house = Warehouse(spark, str(tmp_path / "warehouse"), prefix=f"t{abs(hash(tmp_path))}_")
    house.create()
    return house


def payload(days: dict[str, tuple]) -> str:
    """A document; a day is (open, high, low, close, volume)."""
    series = {day: dict(zip(FIELDS, map(str, values), strict=True)) for day, values in days.items()}
    return json.dumps({SERIES_KEY: series})


RUN_DATE = dt.date(2024, 1, 5)


def land(
    root: Path, symbol: str, text: str, name: str = "doc.json", day: dt.date = RUN_DATE
) -> str:
    folder = root / f"landed={day:%Y%m%d}" / f"symbol={symbol}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(root)


def raw(spark, *rows: tuple):
    """CSV-shaped text rows from (timestamp, open, high, low, close, volume, symbol)."""
    from starload.schemas import CSV_SCHEMA

    return spark.createDataFrame(list(rows), CSV_SCHEMA.replace("`", ""))


def row(day: str, symbol: str, price: str = "1.5", volume: str = "10") -> tuple:
    return (day, price, price, price, price, volume, symbol)


def rows_of(df) -> set[tuple]:
    return {tuple(r) for r in df.collect()}
