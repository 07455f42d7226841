"""Benchmark the headline catalogue queries.

Runs every query ``BENCH_WARMUPS`` times to warm up, then ``BENCH_REPS``
interleaved timed rounds, and prints one JSON line with the median seconds per
query and their sum.  Every run
executes the whole plan through the ``noop`` sink, so nothing is collected to
the driver and the timing is Spark's, not Python's.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_REPS`` (default 5), ``BENCH_WARMUPS`` (default 2),
``BENCH_QUERIES`` (comma list).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "yearly_stats",
    "clean_catalog",
    "trend_stats",
    "kpi_home",
    "type_share",
    "year_range",
    "top_quakes",
    "marker_table",
    "magnitude_histogram",
    "trend_rmse",
    "correlations",
    "depth_scaled",
    "map_clusters",
    "nearest_hav",
    "nearest_batch",
    "place_labels",
    "rf_predict",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    from tremor.plans.catalog import QUERIES
    from tremor.plans.store import build_store
    from tremor.session import build_session, shared_dir
    from tremor.sources.fixture import raw_catalog

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "5"))
    warmups = int(os.environ.get("BENCH_WARMUPS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(
        f"local[{cpus}]",
        app="tremor-bench",
        conf={
            "spark.sql.shuffle.partitions": str(max(cpus, 8)),
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
            **({"spark.buffer.pageSize": os.environ["BENCH_PAGE_SIZE"]} if os.environ.get("BENCH_PAGE_SIZE") else {}),
        },
    )
    # Warm-up rounds over every query (JIT-compiled code paths, Python
    # workers, file listings, the first build of the curated store), then timed rounds that
    # interleave the queries so machine drift spreads evenly over them.
    for _ in range(warmups):
        for name in names:
            run(QUERIES[name](spark, sf_dir))
    samples = {name: [] for name in names}
    samples["store_build"] = []
    for _ in range(reps):
        for name in names:
            t0 = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            samples[name].append(time.perf_counter() - t0)
        # Most queries read the curated store; what it costs to write it counts too.
        t0 = time.perf_counter()
        build_store(spark, raw_catalog(spark, sf_dir), f"{shared_dir(spark)}/scratch/bench-{uuid.uuid4().hex}")
        samples["store_build"].append(time.perf_counter() - t0)
    times = {name: round(statistics.median(xs), 4) for name, xs in samples.items()}
    for name, t in times.items():
        print(f"# {name}: {t:.3f}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "reps": reps,
                "warmups": warmups,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
