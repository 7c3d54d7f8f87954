"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the local cores and
BENCH_QUERIES a comma-separated choice of queries. Every query is run in full
into the no-op sink: all rows and columns are produced and none is collected.
"""

from __future__ import annotations

import json
import os
import time

from plumbline import catalog
from plumbline.session import local_session

HEADLINE = [
    "fct_takeoffs",
    "fct_estimates",
    "mart_estimate_cost_breakdown",
    "mart_takeoff_quality_monitoring",
    "mart_estimation_dashboard",
    "estimate_rollup",
    "rpt_top_cost_codes",
    "rpt_estimate_stats",
    "dash_portfolio",
    "dq_checks_summary",
    "dq_relationships",
    "cost_library_snapshot_merge",
    "cost_library_as_of",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or HEADLINE
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        catalog.run(spark, folder, name).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
