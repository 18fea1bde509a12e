"""Structured Streaming over the landing folder."""

from __future__ import annotations

import datetime as dt
import hashlib
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from starload.plans.load import (
    LoadCounts,
    all_counts,
    last_landed,
    load_dimensions,
    load_fact_counted,
    load_staging_counted,
    require_sound,
    usable_documents,
)
from starload.plans.warehouse import ROWS_PER_FILE, Warehouse
from starload.schemas import CSV_COLUMNS, VERSION, names
from starload.sources.payloads import explode_series, parse_payloads, stream_landing

logger = logging.getLogger(__name__)


def ingest(
    spark: SparkSession,
    landing: str,
    warehouse: Warehouse,
    checkpoint: str,
    max_files: int | None = None,
    packed: bool = False,
    rejects: str | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    check: bool = True,
    keep: dt.timedelta = dt.timedelta(days=7),
    on_load: Callable[[int, LoadCounts], None] | None = None,
) -> StreamingQuery:
    """Load every document that landed since the last run with this checkpoint, then stop.

    Each micro-batch is a complete load, so one that is repeated after a failure changes nothing.
    Of several documents that bring a day of a symbol the one that landed last wins, in
    one batch or in several, and whichever is loaded first: a document of an earlier landing day
    that comes late fills gaps and replaces only what is older.

    One unusable document or row stops the stream, at every start, unless there is a
    `rejects` folder: then those go there, below the names of stream and batch, so that a
    repeated batch replaces what it has put aside before.

    `check` audits each batch before the fact is written; one that would break a promise of the
    data model stops the stream. Versions of staging and fact that were replaced longer than
    `keep` ago go with each batch. `on_load` is told the number of each batch and its counts.
    """
    parsed = parse_payloads(stream_landing(spark, landing, max_files, packed))
    warehouse.create()
    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def aside(kind: str, batch_id: int) -> str:
        return f"{rejects.rstrip('/')}/{kind}/stream={stream}/batch={batch_id}"

    def load(batch: DataFrame, batch_id: int) -> None:
        here = warehouse.on(batch.sparkSession)
        bad_documents = rejects and aside("documents", batch_id)
        usable, documents = usable_documents(batch, bad_documents, again=True)
        latest = last_landed(explode_series(usable)).select(*CSV_COLUMNS, *names(VERSION))
        bad_rows = rejects and aside("rows", batch_id)
        staged = load_staging_counted(here, latest, bad_rows, again=True)
        # A micro-batch has a session of its own, and sessions remember the files of a table.
        # From the staging table on nothing streams, so the rest runs in the session of the
        # warehouse, which then sees its own changes.
        warehouse.spark.catalog.refreshTable(warehouse.staging)
        load_dimensions(warehouse)
        if check:
            require_sound(warehouse)
        loaded = load_fact_counted(warehouse, rows_per_file=rows_per_file)
        warehouse.remove_old(keep)
        counts = all_counts(documents, staged, loaded)
        logger.info("batch %d: %s", batch_id, counts)
        if on_load is not None:
            on_load(batch_id, counts)

    return (
        parsed.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
