"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from dualpath.session import build_session  # noqa: E402

HEADLINE = [
    "stg_pitches",
    "stg_all_fields",
    "pitcher_game_window",
    "dedup_natural",
    "pitcher_game_fatigue",
    "game_state_events",
    "synth_event_time",
    "clean_rows",
    "late_split",
    "pace_trend",
    "signals_canonical",
    "alerts_banded",
    "alert_reconciliation",
    "signal_delta",
    "matchup_edge",
    "quality_report",
    "tumble_counts_batch",
    "tumble_counts_stream",
    "stream_features",
    "incremental_equals_full",
    "matched_alerts",
    "matchup_facts",
    "fatigue_parts",
    "kpi_signal_latency",
]

# The same query with every group of 200 rows or more called hot and cut.
HOT = {"pitcher_game_window_hot": "pitcher_game_window"}
HOT_CONF = {"spark.dualpath.measureBytes": "0", "spark.dualpath.hotRows": "200"}


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        times[name] = round(min(run(spark, name, sf_dir) for _ in range(2)), 3)
    for key, value in HOT_CONF.items():
        spark.conf.set(key, value)
    for name, query in HOT.items():
        run(spark, query, sf_dir)
        times[name] = round(min(run(spark, query, sf_dir) for _ in range(2)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, best of two after one warm-up, summed",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
