from __future__ import annotations

import os
from pathlib import Path

import pytest

from tests.conftest import SF_DIR  # noqa: F401

ROOT = str(Path(__file__).parents[2])
DOCUMENT = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture(scope="session")
def spark(spark):
    """The tests' session, with this repository on the path of Python workers."""
    environment = spark.sparkContext.environment
    paths = [ROOT, *filter(None, environment.get("PYTHONPATH", "").split(os.pathsep))]
    environment["PYTHONPATH"] = os.pathsep.join(paths)
    return spark


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of documents from (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows, **extra):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, None) for r in rows]
        table = spark.createDataFrame(full, DOCUMENT)
        for name, value in extra.items():
            from pyspark.sql import functions as F

            table = table.withColumn(name, F.lit(value))
        return table

    return make


def by_id(df, key="doc_id"):
    return {row[key]: row for row in df.collect()}


def plain_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
