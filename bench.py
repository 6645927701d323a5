"""Time the headline queries; prints one JSON line.

Reads ``BENCH_SF_DIR`` on ``local[BENCH_CPUS]``. Each query runs once to warm up, then
``BENCH_RUNS`` times; the median counts. Results go to the no-op sink, so every row is built.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adstrata import session  # noqa: E402
from workload import registry  # noqa: E402

HEADLINES = [
    "attr_quality_flags",
    "attr_summary",
    "attr_normalized",
    "path_conversion",
    "campaign_quality",
    "health_report",
    "recon_advertiser",
    "reach_windows",
    "reach_cumulative",
    "identity_match",
    "identity_export",
    "lld_report",
    "lld_agg",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINES
    spark = session.build(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()

    def timed(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
