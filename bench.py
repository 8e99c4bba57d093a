"""Time the registered queries on the bench tables; prints one JSON line.

Every query writes all its rows to Spark's no-op sink; the best of three runs
after one untimed run counts.  Input files are written before the clock starts.  ``two_cycles`` is the
whole job: two snapshots, as files, through all layers and published, amounts in cents.  Environment: BENCH_SF_DIR, BENCH_CPUS.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from snapfold.plans import inputs, registry  # noqa: E402
from snapfold.plans.cycle import run_cycle  # noqa: E402
from snapfold.session import local_session, scratch_dir  # noqa: E402
from snapfold.sources.lake import WIDE_LAYOUTS  # noqa: E402

HEADLINE = (
    "csv_snapshot",
    "csv_snapshot_in_splits",
    "clean_names_text",
    "clean_phone_text",
    "clean_address_text",
    "conform",
    "key_violations",
    "cdc_classify",
    "cdc_counts",
    "cdc_apply",
    "cdc_apply_converging",
    "cdc_redetect",
    "avg_tenure",
    "mode_by_year",
    "department_kpi",
    "hiring_trends",
    "gold_after_cdc",
)

RUNS = 3


def timed_query(spark, sf_dir: str, name: str) -> float:
    if name in registry.SCANS:  # files are written beforehand; the whole scan counts
        write, read = registry.SCANS[name]
        path = write(spark, sf_dir, name)
        query = lambda: read(spark, path)
    else:
        query = lambda: registry.QUERIES[name](spark, sf_dir)

    def run() -> float:
        started = time.perf_counter()
        query().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    run()
    return min(run() for _ in range(RUNS))


def timed_cycles(spark, sf_dir: str) -> tuple[float, int]:
    """Seconds for two cycles over snapshot files written beforehand, and their rows."""
    days = (inputs.EARLIER, inputs.LATER)
    files = [
        registry.order_files(spark, sf_dir, day, scratch_dir(spark, f"bench_{day}"), inputs.CENTS)
        for day in days
    ]

    def run() -> tuple[float, int]:
        started = time.perf_counter()
        lake = registry.new_lake(spark, "bench", WIDE_LAYOUTS)
        n_rows = sum(run_cycle(lake, path, day).rows for path, day in zip(files, days))
        return time.perf_counter() - started, n_rows

    run()
    return min(run() for _ in range(RUNS))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    partitions = int(cpus) if cpus.isdigit() else 8
    spark = local_session(cpus, shuffle_partitions=partitions, app="bench")
    seconds = {name: round(timed_query(spark, sf_dir, name), 3) for name in HEADLINE}
    cycles, n_rows = timed_cycles(spark, sf_dir)
    seconds["two_cycles"] = round(cycles, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": cpus,
                "two_cycles_snapshot_rows": n_rows,
                "two_cycles_rows_per_sec": round(n_rows / cycles),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
