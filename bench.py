"""Benchmark the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_REPEAT`` (timed passes after one warm-up, default 2).
The plans are those of ``__spark_entry__.queries()`` minus the output
rounding that only serves the oracle comparison.  Each query is forced
through the ``noop`` sink, so the full plan runs without
moving rows to the driver; the reported time is the best timed pass.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "build_features",
    "preprocess_features",
    "drop_impact",
    "outlier_summary",
    "month_filter_summary",
    "quantile_scan",
    "build_splits",
    "ks_distance",
    "null_profile",
    "zone_centroids",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    from farelane.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app="farelane-bench")
    from farelane.plans import catalog
    from farelane.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    from farelane.sources import fixtures, sinks

    # the pipeline starts from raw monthly trip files: write the orders-derived
    # trips once in that layout (untimed), then every query scans that table
    raw = sinks.write_months(fixtures.load_trips(spark, sf_dir), sinks.shared_dir(spark, "bench_raw_trips"), files_per_month=1)
    fixtures.use_trip_table(sf_dir, raw)
    # the registered plans without the 6-decimal output rounding used for the oracle check
    qs = catalog.all_raw_queries()
    times: dict[str, float] = {}
    for k in HEADLINE:  # warm-up: JVM, code generation, file listing
        qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for k in HEADLINE:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[k] = round(best, 3)
    n_trips = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_suite_seconds",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "rows_per_sec_build_features": round(n_trips / times["build_features"], 1) if times["build_features"] else None,
                "cpus": cpus,
                "source": "monthly trip parquet (file_month=YYYY-MM) written from orders before timing",
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
