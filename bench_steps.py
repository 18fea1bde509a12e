"""

Takes the settings of bench.py.
"""

from __future__ import annotations

import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starload.operators.staging import to_staging  # noqa: E402
from starload.plans.load import load_dimensions, load_fact, load_staging  # noqa: E402
from starload.queries import bars as source  # noqa: E402
from starload.queries.registry import RUN_DATE, scratch_warehouse  # noqa: E402
from starload.session import local_session, scratch_dir, stored  # noqa: E402
from starload.sources.payloads import (  # noqa: E402
    explode_series,
    parse_payloads,
    read_landing,
    require_usable,
)
from starload.sources.prices_csv import read_csv, write_csv  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = local_session("starload-steps", tempfile.mkdtemp(prefix="bench-"), cores)
    spark.sparkContext.setLogLevel("ERROR")
    bars = stored(source.bars(spark, sf_dir), "bars")
    first, second = source.first_batch(bars), source.second_batch(bars)
    counts = {"all": bars.count(), "first": first.count(), "second": second.count()}
    landing = source.land(source.payloads(bars), scratch_dir(spark, "landing"), RUN_DATE)
    times: dict[str, list[float]] = {}
    rows: dict[str, int] = {}

    def step(name: str, count: int, action) -> None:
        start = time.perf_counter()
        action()
        times.setdefault(name, []).append(time.perf_counter() - start)
        rows[name] = count

    def parse() -> None:
        parsed = require_usable(parse_payloads(read_landing(spark, landing)))
        to_staging(explode_series(parsed)).write.format("noop").mode("overwrite").save()

    def csv_round_trip() -> None:
        path = write_csv(source.raw_bars(bars), scratch_dir(spark, "csv"), RUN_DATE)
        to_staging(read_csv(spark, path)).write.format("noop").mode("overwrite").save()

    for _ in range(int(os.environ.get("BENCH_RUNS", "3")) + 1):
        with scratch_warehouse(spark) as warehouse:
            step("payload parse", counts["all"], parse)
            step("CSV round trip", counts["all"], csv_round_trip)
            raw = source.raw_bars(first)
            step("staging load", counts["first"], lambda raw=raw, w=warehouse: load_staging(w, raw))
            step("dimension loads", counts["first"], lambda w=warehouse: load_dimensions(w))
            step("first fact load", counts["first"], lambda w=warehouse: load_fact(w))
            load_staging(warehouse, source.raw_bars(second))
            load_dimensions(warehouse)
            step("fact upsert, one year shared", counts["second"], lambda w=warehouse: load_fact(w))

    print("| step | rows | seconds | rows/s |\n|---|---|---|---|")
    for name, taken in times.items():
        median = statistics.median(taken[1:])
        print(f"| {name} | {rows[name]:,} | {median:.2f} | {rows[name] / median:,.0f} |")
    spark.stop()


if __name__ == "__main__":
    main()
