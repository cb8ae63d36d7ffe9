"""Time the query catalogue on one data set; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores, ``BENCH_QUERIES`` (comma separated)
limits the set (``all`` for every query), ``BENCH_RUNS`` sets the measured runs per query. Each
query runs once untimed, so that compilation is not measured; the median of the timed runs, plan
building included, is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from routeline.plans.catalog import QUERIES  # noqa: E402
from routeline.session import build_session  # noqa: E402

HEADLINE = [
    "bronze_json_decode", "trips_haversine", "trips_sql_variant", "fct_driver_performance",
    "driving_events", "geofence_events", "journeys", "hub_dwell", "fct_shipments",
    "fct_hub_daily", "current_status", "sla_tracking", "agent_shifts", "fct_agent_daily",
    "fct_zone_daily", "area_performance", "alerts_unified", "dq_bronze", "speed_quartiles",
    "top_agents", "hourly_rollup", "stream_status_upsert",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if names == "all" else [n for n in names.split(",") if n] or HEADLINE
    spark = build_session("routeline-bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": cpus,
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        drain(QUERIES[name](spark, root))
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            drain(QUERIES[name](spark, root))
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "catalogue_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
