"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from matchlens.plans.catalog import catalog
from matchlens.session import local_session

HEADLINE = (
    "valid_matches",
    "hero_results",
    "hero_pairs",
    "hero_counters",
    "match_simple",
    "hero_win_rate_daily",
    "pair_win_rate",
    "counter_win_rate",
    "hero_sliding_win_rate",
    "hero_count_window",
    "pair_count_window",
    "counter_count_window",
    "hero_rolling_win_rate",
    "hero_live_win_rate",
    "best_teammates",
    "best_opponents",
    "cluster_players_daily",
    "players_in_game",
    "region_players_daily",
    "player_match",
    "player_daily",
    "dau_exact",
    "dau_sorted",
    "dau_hll",
    "mau_exact",
    "mau_hll",
    "mau_from_daily_sketches",
    "newest_items",
    "json_roundtrip",
    "dump_roundtrip",
    "stream_hero_days",
    "stream_messages",
    "refresh_player_daily",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, **{"spark.sql.shuffle.partitions": cores})
    queries = catalog()
    # One unmeasured query starts the executor threads and loads the classes.
    queries["dau_exact"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    result = {"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
