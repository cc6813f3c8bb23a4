"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8). Each
query runs once to warm up and then BENCH_RUNS times (default 3); the median counts. Results
go to Spark's ``noop`` sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from fieldtally import build_session
from fieldtally.plans import queries

HEADLINE = (
    "q05_avg_order_value",
    "q07_avg_order_value_tagged",
    "q09_customers_without_orders",
    "q10_order_existence",
    "q15_sssp_costs",
    "q16_sssp_paths",
    "q22_zone_exits_per_entity",
    "q23_zone_exits_total",
    "q24_step_distances",
    "q25_avg_step_sliding",
    "q26_running_best",
    "q27_best_window",
    "q29_stream_zone_exits",
    "q30_stream_avg_step",
)


def timed(query, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:] or HEADLINE
    conf = {
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.log.level": "ERROR",
    }
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=cpus, extra=conf)
    all_queries = queries()
    seconds = {}
    for name in chosen:
        timed(all_queries[name], spark, sf_dir)
        seconds[name] = round(statistics.median(timed(all_queries[name], spark, sf_dir) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    line = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "runs": runs,
        "conf": {"spark.sql.shuffle.partitions": cpus, **conf},
    }
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
