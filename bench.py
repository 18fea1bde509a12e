"""Time the headline queries; prints one JSON line.

The bars that the queries run on are derived and stored before the clock starts, so what is
timed is the operators and not their fixture. Each run has a scratch folder of its own.

BENCH_SF_DIR   folder of the tables      (/root/testdata/sf0.1)
BENCH_CPUS     local cores               (all)
BENCH_RUNS     timed runs per query, the median counts (3, after one warm-up run)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starload.queries import registry  # noqa: E402
from starload.queries.registry import QUERIES  # noqa: E402
from starload.session import local_session, stored  # noqa: E402

HEADLINE = [
    "staging_load",
    "payload_roundtrip",
    "csv_roundtrip",
    "quarantine_rows",
    "dim_date",
    "dim_symbol",
    "fact_one_symbol",
    "fact_all_symbols",
    "fact_upsert",
    "fact_upsert_nulls",
    "constraint_audit",
    "load_all_steps",
    "incremental_stream",
]


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("starload-bench", tempfile.mkdtemp(prefix="bench-"), cores)
    spark.sparkContext.setLogLevel("ERROR")
    prepared = stored(registry.bars(spark, sf_dir), "bars")
    registry.bars = lambda spark, sf_dir: prepared
    times = {}
    for name in HEADLINE:
        seconds(QUERIES[name], spark, sf_dir)
        times[name] = round(
            statistics.median(seconds(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3
        )
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
