"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion into Spark's ``noop`` sink (every row is
produced, nothing is collected to the driver): once cold, then three times warm
(the median counts).
Prints one JSON line: {"metric": ..., "value": warm total sec, "unit": "sec",
"queries": {warm sec per query}, "sf": ..., "cold_total": ..., "cold_queries": {...}}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import registry  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = [
    "quote_trade_analytics",
    "latest_date_analytics",
    "forward_fill_quotes",
    "trade_moving_average",
    "previous_close",
    "eod_trades_latest",
    "eod_quotes_latest",
    "csv_parse_events",
    "json_parse_events",
    "ingest_union",
    "latest_run",
    "job_status_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus)),
                          app="tidemark-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # Warm-up (class loading) on the smallest data; not timed.
    for name in HEADLINE:
        _run(spark, name, "/root/testdata/sf0.001")
    # Cold: first run at the bench scale (JIT and code generation for the
    # plan shapes AQE picks at this size).  Warm: the same query again.
    cold = {name: _run(spark, name, sf_dir) for name in HEADLINE}
    passes = [{name: _run(spark, name, sf_dir) for name in HEADLINE} for _ in range(3)]
    warm = {name: statistics.median(p[name] for p in passes) for name in HEADLINE}
    print(json.dumps({"metric": "headline_queries_total_warm",
                      "value": round(sum(warm.values()), 3), "unit": "sec",
                      "queries": warm, "sf": sf,
                      "cold_total": round(sum(cold.values()), 3), "cold_queries": cold}))


def _run(spark, name: str, sf_dir: str) -> float:
    t0 = time.time()
    registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.time() - t0, 3)


if __name__ == "__main__":
    main()
