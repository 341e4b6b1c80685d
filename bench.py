"""Time the headline queries: one warm-up run, then the median of three.

Prints one JSON line. BENCH_SF_DIR names the tables, BENCH_CPUS the local cores,
BENCH_QUERIES an optional comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from frostline.plans.marts import Marts, StoredMarts  # noqa: E402
from frostline.queries import QUERIES  # noqa: E402
from frostline.session import local_session  # noqa: E402
from frostline.sinks.tables import work_folder  # noqa: E402
from frostline.sources import telemetry as feed  # noqa: E402

#: Writing the four marts that the dashboard queries read; those are timed after it is done.
WRITE = "write_marts"
HEADLINE = [
    WRITE,
    "stg_telemetry",
    "spoilage_risk",
    "market_options",
    "spoilage_arbitrage",
    "fct_container_health",
    "rolling_risk",
    "risk_transitions",
    "rolling_decision",
    "history_series",
    "kpi_executive",
    "vd_corridor",
    "vd_commodity_var",
    "alert_feed",
    "audit_trail",
    "critical_alerts",
    "validate_events",
    "dedup_telemetry",
    "dq_not_null",
    "console_kpis",
    "scenario_sweep",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def write_marts(spark, folder: str) -> None:
    marts = StoredMarts(Marts(feed.readings(spark, folder)), work_folder(spark, "bench"))
    for table in (marts.arbitrage, marts.container_dim, marts.market_dim, marts.readings):
        table.count()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(cores)
    timings = {}
    for name in names:

        def run(name=name):
            if name == WRITE:
                write_marts(spark, folder)
                return
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

        run()
        timings[name] = round(statistics.median(seconds(run) for _ in range(3)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
