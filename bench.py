"""Headline queries at ``$BENCH_SF_DIR``: one JSON line with seconds per query."""

from __future__ import annotations

import json
import os
import time

from stationflow.plans.catalog import CATALOG
from stationflow.session import local_session, tuned

HEADLINE = (
    "A1_slot_flow",
    "A2_distinct_devices",
    "J1_slot_grid",
    "A12_slot_series",
    "W1_lags",
    "W5_past_values",
    "W7_past_n",
    "R2_neighbour_history",
    "R3_adjacent_flow",
    "R6_linear_history",
    "F1_weekday_rule",
    "F2_weekend_rule",
    "F12_trend",
    "M1_minute_features",
    "M3_hour_features",
    "M5_weekend_features",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = tuned(local_session(cores))
    spark.sparkContext.setLogLevel("ERROR")
    # The first query of a session pays for starting it.
    CATALOG["A1_slot_flow"](spark, sf_dir).count()
    seconds = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(runs):
            began = time.perf_counter()
            CATALOG[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - began)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
