"""Times the headline queries: one warm-up, then the median of the timed runs, results fully computed.

Prints one JSON line. BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS override the defaults.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pitchline.catalog.queries import REGISTRY
from pitchline.session import get_spark

HEADLINE = [
    "inplay_features", "event_minute_counts", "inplay_from_json", "silver_events", "lineup_players_explode",
    "pregame_history", "pregame_lineup_strength", "pregame_features", "match_team_stats", "player_season_stats",
    "core_events", "core_season_stats", "upsert_replace", "temporal_split_matches", "class_distribution",
    "model_metrics", "recent_form", "coupon", "player_mapping",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(json.dumps({"metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
