"""Time the queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3),
BENCH_QUERIES (comma-separated names, default all), BENCH_SMALL_DIR (a smaller scale; then the time
ratios between the two are given as well). One warm-up, which counts the rows, then the median of the runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidewright.plans.catalog import all_queries
from tidewright.session import build_session

#: A query whose warm-up takes longer than this is timed once.
LONG_S = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    small_dir = os.environ.get("BENCH_SMALL_DIR")
    spark = build_session(
        "tidewright-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds, rows, ratios = all_queries(), {}, {}, {}
    names = names.split(",") if names else list(queries)

    def timed(name: str, where: str) -> float:
        start = time.perf_counter()
        queries[name](spark, where).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in names:
        start = time.perf_counter()
        rows[name] = queries[name](spark, sf_dir).count()
        long = time.perf_counter() - start > LONG_S
        seconds[name] = round(statistics.median(timed(name, sf_dir) for _ in range(1 if long else runs)), 3)
        if small_dir:
            timed(name, small_dir)
            ratios[name] = round(seconds[name] / timed(name, small_dir), 2)
        print(name, rows[name], seconds[name], ratios.get(name, ""), file=sys.stderr, flush=True)
    result = {
        "metric": "sum of median query seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows": rows,
        "ratio_to_small": ratios,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    if "stream_ingest" in seconds:
        events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").count()
        result["stream_ingest_rows_per_s"] = round(1.5 * events / seconds["stream_ingest"])  # one and a half deliveries
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
