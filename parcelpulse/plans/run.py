"""A whole run: every date folder to one series table and optional cubes."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelpulse.operators import faults, series
from parcelpulse.params import Params, problems_text
from parcelpulse.plans.rejected import cube_of_rejected
from parcelpulse.plans.time_series import (
    finish_series,
    masked_cube,
    search,
    usable_parcel_days,
)
from parcelpulse.schema import Grid
from parcelpulse.session import hold
from parcelpulse.sources.parcels import read_parcels
from parcelpulse.sources.results import read_cube, write_cube, write_series


logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class RunPaths:
    series: str
    cube: str | None = None
    rejected: str | None = None
    failed: str | None = None  # parcels without a result, and why


@dataclass(frozen=True)
class RunCounts:
    """What a run did. It is true when there were results."""

    points: int
    parcels_done: int
    failed: dict[str, int] = field(default_factory=dict)  # parcels by reason

    def __bool__(self) -> bool:
        return self.points > 0


def run_folders(
    spark: SparkSession,
    root: str,
    scenes: DataFrame,
    pixels: DataFrame,
    paths: RunPaths,
    params: Params,
    grid: Grid,
    *,
    classes: DataFrame | None = None,
    class_grid: Grid | None = None,
    utm: bool = False,
    file_format: str = "parquet",
) -> RunCounts:
    """Process all folders in one plan, write the results, and tell how many there were.

    The folders' dates are a column, so nothing loops over folders.
    """
    parcels = read_parcels(spark, root, file_format, keep_faulty=True)
    return run_parcels(
        parcels, scenes, pixels, paths, params, grid, classes=classes, class_grid=class_grid, utm=utm
    )


def run_parcels(
    parcels: DataFrame,
    scenes: DataFrame,
    pixels: DataFrame,
    paths: RunPaths,
    params: Params,
    grid: Grid,
    *,
    classes: DataFrame | None = None,
    class_grid: Grid | None = None,
    utm: bool = False,
) -> RunCounts:
    """The same for a parcel table with dates of its own.

    A parcel with a faulty row, or without a scene, a clear day or a value, has no series and
    leaves the others alone; it is counted by reason, and listed in ``paths.failed``. When the
    masked cube is saved, the means are taken from the saved table and the pixels are read only
    once.
    """
    lacking = [
        f"'{name}' is switched on but has no path"
        for name, path in (("save_cube", paths.cube), ("debug_cloud", paths.rejected))
        if getattr(params, name) and path is None
    ]
    if classes is not None and class_grid is None:
        lacking.append("'classes' come without their 'class_grid'")
    if lacking:
        raise ValueError(problems_text(lacking))
    found = search(parcels, scenes, params, utm=utm)
    coarse = {"classes": classes, "class_grid": class_grid}
    usable = usable_parcel_days(pixels, found, params, grid, **coarse)
    usable = hold(usable, "usable")
    cube, days = masked_cube(pixels, found, usable, params, grid, **coarse)
    if params.save_cube:
        stamped = series.stamp(cube, days, found.parcels)
        write_cube(stamped, paths.cube)
        saved = read_cube(parcels.sparkSession, paths.cube, schema=stamped.schema)
        mine = found.parcels.select(
            *(F.col(c).alias(f"own_{c}") for c in ("parcel_key", *series.PROVENANCE))
        )
        same = [saved[c].eqNullSafe(mine[f"own_{c}"]) for c in ("parcel_key", *series.PROVENANCE)]
        # Merged, as parcels would be broadcast by the size of their files.
        cube = saved.join(mine.hint("merge"), same, "left_semi").select(*cube.columns)
    if params.debug_cloud:
        write_cube(
            cube_of_rejected(pixels, found, usable, params, grid, **coarse),
            paths.rejected,
        )
    means = hold(finish_series(cube, days, found.parcels, params), "series")
    write_series(means, paths.series, held=True)
    lacking = faults.without_result(found.parcels, found.days, usable, means)
    failed = hold(found.faulty.unionByName(lacking), "failed")
    if paths.failed is not None:
        failed.write.mode("overwrite").parquet(paths.failed)
    by_reason = {r["reason"]: r["count"] for r in failed.groupBy("reason").count().collect()}
    for reason, n in sorted(by_reason.items()):
        logger.warning("%d parcel(s) without a result: %s", n, reason)
    done = means.agg(F.count("*"), F.count_distinct("parcel_key")).first()
    return RunCounts(done[0], done[1], by_reason)
