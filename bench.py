"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the no-op sink (every row computed,
nothing collected), once to warm up and then ``BENCH_RUNS`` times; the
median is reported. ``medallion_run`` is the whole job writing every layer
(Bronze -> Silver -> Gold -> quality report) to a fresh folder of the shared
checkpoint location. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlake import registry  # noqa: E402
from ledgerlake.plans.medallion import run_medallion  # noqa: E402
from ledgerlake.session import build_session, scratch_root  # noqa: E402
from ledgerlake.sources.fixtures import bronze_sources  # noqa: E402

HEADLINE = [
    "silver_transaction_details",
    "gold_user_metrics",
    "gold_channel_metrics",
    "gold_payment_method_metrics",
    "gold_summary",
    "quality_report_silver",
    "silver_rejects",
]


def _calibration() -> float:
    """Seconds for a fixed pure-Python loop: the host's speed at bench time."""
    t0 = time.perf_counter()
    total = 0
    for i in range(5_000_000):
        total += i
    return round(time.perf_counter() - t0, 3)


def _time(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="ledgerlake-bench",
        shuffle_partitions=max(cpus * 2, 8),
        conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
              "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    results: dict[str, float] = {}
    for name in HEADLINE:
        query = registry.QUERIES[name]

        def run(q=query) -> None:
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()
        results[name] = round(statistics.median(_time(run) for _ in range(runs)), 3)

    def full() -> None:
        run_medallion(spark, bronze_sources(spark, sf_dir), scratch_root(spark, "bench"), registry.RUN_DATE,
                      as_of=registry.AS_OF, processed_at=registry.PROCESSED_AT, checked_at=registry.CHECKED_AT)

    full()
    results["medallion_run"] = round(statistics.median(_time(full) for _ in range(runs)), 3)

    calibration = _calibration()
    match = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_median_sec",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "host_calibration_sec": calibration,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
