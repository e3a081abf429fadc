"""Times the headline queries: one warm-up, then the median of BENCH_RUNS runs, each forced to
compute every row of the result (written to Spark's 'noop' sink). Prints one JSON line."""

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "build_disposal_daily", "cumulative_amount", "rank_by_type", "rank_grouping_sets", "tracks_bd09",
    "decode_frames", "data_bus", "join_site_500m", "join_region", "fence_violations", "trips",
    "gps_incomplete_alarms", "fence_alarms", "no_register_alarms", "vehicle_online_time",
    "vehicle_current_state", "stop_episodes", "inout_dwell", "hourly_track_counts", "off_route_alarms",
    "illegal_disposal", "trips_table_row", "ranked_enterprises",
]


def main() -> None:
    from haulwatch.plans.registry import QUERIES
    from haulwatch.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("OFF")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale),
        "cores": int(cores), "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
