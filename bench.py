"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR  folder of the input tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)
    BENCH_RUNS    runs of each query, of which the median counts (default 3)
    BENCH_BUDGET  seconds after which no further round of runs is begun (default 330)

Besides whole queries, every stage of the chain is timed once on its stored input, under ``stages``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession

from tripweave.operators import linking, trip_start, views
from tripweave.plans import daily, features
from tripweave.plans.registry import QUERIES
from tripweave.plans.sample_pings import sample_pings
from tripweave.session import clear_staged, local_session, stage

HEADLINE = [
    "tsv_scan",
    "ping_clean",
    "ping_dedup",
    "pair_classify",
    "segments",
    "modal_distance_clean",
    "route_link",
    "linked_schema",
    "encode_ids",
    "first_time",
    "short_long_union",
    "speed_filter",
    "ordered_split_80_10_10",
    "zscore",
    "baseline_eval",
    "linear_fit_score",
    "gbt_fit_score",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
BUDGET = float(os.environ.get("BENCH_BUDGET", "330"))


def seconds(build: Callable[[], DataFrame]) -> float:
    """The time to build a result and write all of it to nowhere."""
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def stages(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Each stage by itself: its input is stored before the clock starts."""
    pings = stage(sample_pings(spark, sf_dir), "pings")
    segments = stage(daily.segments(pings), "segments")
    modal = stage(daily.modal_segments(pings), "modal")
    linked = stage(daily.linked(pings), "linked")
    scaled = stage(features.scaled(linked)[0], "scaled")
    started = stage(features.started(linked)[0], "started")
    builds = {
        "pings to de-duplicated": lambda: daily.deduped(pings),
        "pings to segments": lambda: daily.segments(pings),
        "segments to modes": lambda: daily.trip_modes(daily.round_distances(segments)),
        "modal segments to routes": lambda: linking.link_routes(modal),
        "linked to encoded": lambda: features.encoded(linked),
        "scaled to trip starts": lambda: trip_start.trip_starts(scaled),
        "trip starts to union": lambda: views.short_long_union(views.commute_by_both(started)),
        "linked to model table": lambda: features.model_table(linked).rows,
    }
    return {name: seconds(build) for name, build in builds.items()}


def main() -> None:
    began = time.perf_counter()
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("tripweave-bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds(lambda: QUERIES["linked_schema"](spark, sf_dir))  # JVM warm-up, not counted
    by_stage = stages(spark, sf_dir)
    clear_staged(spark)
    times: dict[str, list[float]] = {name: [] for name in HEADLINE}
    for _ in range(RUNS):
        for name, runs in times.items():
            runs.append(seconds(lambda name=name: QUERIES[name](spark, sf_dir)))
            clear_staged(spark)
        if time.perf_counter() - began > BUDGET:
            break
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    medians = {name: round(statistics.median(runs), 3) for name, runs in times.items()}
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "stages": by_stage,
                "runs": len(times[HEADLINE[0]]),
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
