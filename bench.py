"""Time the headline queries and print one JSON line.

Every query is built and fully computed (noop sink) on $BENCH_SF_DIR with
local[$BENCH_CPUS]. One untimed run on the smallest data warms the JVM up.
"""

from __future__ import annotations

import json
import os
import sys
import time

from parcelpulse.checks.queries import QUERIES
from parcelpulse.session import local_session

HEADLINE = [
    "parcel_time_series",
    "time_series_shared_grid",
    "time_series_coarse_class",
    "run_folders",
    "rejected_ndvi",
    "write_pixel_cube",
    "join_parcel_scene",
    "join_parcel_pixel",
    "clip_pixels",
    "solar_day_mosaic",
    "clear_ratio",
    "clear_summary",
    "spatial_mean",
    "scale_bands",
    "resample_nearest",
    "project_utm",
    "filter_bbox",
    "scan_scenes",
    "scan_pixels",
    "ndvi",
]


def compute(spark, sf_dir, name) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, shuffle_partitions=8)
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in ("parcel_time_series", "solar_day_mosaic"):
            compute(spark, small, name)
    seconds = {name: round(compute(spark, sf_dir, name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "spark": spark.version,
                "cores": cores,
                "shuffle_partitions": 8,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
