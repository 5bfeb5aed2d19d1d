"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfcast.catalog import all_queries
from shelfcast.session import local_session

HEADLINES = [
    "residual_by_node",
    "dense_spine",
    "residual_target",
    "baseline_on_days",
    "price_momentum_month",
    "roll_mean_stride235",
    "roll_stats_daily",
    "roll_median_daily",
    "lag_frame_h9",
    "encode_cutoffs",
    "hierarchy_rollup",
    "rmsse_scale",
    "scaled_weight",
    "wrmsse",
    "interval_halfwidth",
    "interval_quantiles",
    "blend_mean",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINES
    spark = local_session(cpus, shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # start-up is not measured
    times = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "sf": scale}))


if __name__ == "__main__":
    main()
