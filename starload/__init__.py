"""Star-schema loading of daily price series on Spark."""

from starload.plans.load import (
    LoadReport,
    audit_tables,
    extract,
    load_dimensions,
    load_fact,
    load_staging,
    run,
)
from starload.plans.warehouse import Warehouse
from starload.streaming.ingest import ingest

__all__ = [
    "LoadReport",
    "Warehouse",
    "audit_tables",
    "extract",
    "ingest",
    "load_dimensions",
    "load_fact",
    "load_staging",
    "run",
]
