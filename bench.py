"""Time of the headline queries, one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the measured
runs after one warm-up. Each run computes the whole result into the ``noop`` sink; the
reported time is the median. The text form of dates that the SQL comparison needs is left
out of the measurement.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillhouse.queries import REGISTRY  # noqa: E402
from tillhouse.session import local_session  # noqa: E402

HEADLINE = (
    "silver_pos", "silver_inventory", "silver_crm", "silver_wtl", "merge_pos",
    "merge_inventory_moved", "envelope_decode", "sales_mart", "sales_by_store",
    "marketing_mart", "operations_mart", "customer_support_mart", "inventory_turnover",
    "restock_frequency", "stockout_alerts", "feedback_score", "interaction_volume",
    "time_to_resolution", "support_snapshot", "web_sessions_gap", "dq_profile",
    "mart_roundtrip_sales", "stream_volume_windows",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    seconds: dict[str, float] = {}
    spread: dict[str, list[float]] = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            result = REGISTRY[name].__wrapped__(spark, folder)
            result.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        measured = times[1:]
        seconds[name] = round(statistics.median(measured), 3)
        spread[name] = [round(min(measured), 3), round(max(measured), 3)]
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "range": spread,
                "sf": os.path.basename(folder.rstrip("/")),
                "cores": cores,
                "runs": runs,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
