"""Pixels of the parcels that fail the clear-sky test, for inspection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.functions.dates import utc_day
from parcelpulse.functions.indices import add_indices
from parcelpulse.operators import series
from parcelpulse.params import Params
from parcelpulse.plans.time_series import (
    Search,
    search,
    spectral_cube,
    usable_parcel_days,
)
from parcelpulse.schema import CLASS_BAND, Grid
from parcelpulse.session import hold

REJECTED_BANDS = ["red", "nir"]


def cube_of_rejected(
    pixels: DataFrame,
    found: Search,
    usable: DataFrame,
    params: Params,
    grid: Grid,
    classes: DataFrame | None = None,
    class_grid: Grid | None = None,
) -> DataFrame:
    """Red, nir (scaled, clipped, not masked) and class of all dates of rejected parcels."""
    days = hold(found.days.join(usable.hint("merge"), "parcel_key", "left_anti"), "rejected-days")
    cube = spectral_cube(
        pixels, found, days, grid, REJECTED_BANDS, params.per_item_scale, classes, class_grid
    )
    return series.stamp(cube, days, found.parcels)


def rejected_cube(
    parcels: DataFrame,
    scenes: DataFrame,
    pixels: DataFrame,
    *,
    collection: str,
    grid: Grid,
    start=None,
    end=None,
    classes: DataFrame | None = None,
    class_grid: Grid | None = None,
    utm: bool = False,
    **options,
) -> DataFrame:
    params = Params(indices=["NDVI"], collection=collection, **options)
    found = search(parcels, scenes, params, start, end, utm)
    usable = usable_parcel_days(pixels, found, params, grid, classes, class_grid)
    return cube_of_rejected(pixels, found, usable, params, grid, classes, class_grid)


def rejected_ndvi(cube: DataFrame) -> DataFrame:
    """Unmasked NDVI per pixel beside the class, its date, and the parcel's date count.

    Takes a rejected cube, as computed or read back. A cube without red or nir has nothing
    to show. It is held: the rows and the counts would each compute it. The two are merged:
    held, even a cube may be small enough as files to be broadcast, its rows are not.
    """
    missing = [b for b in REJECTED_BANDS if b not in cube.columns]
    if missing:
        raise ValueError(f"the cube lacks {missing}")
    cube = hold(cube, "rejected")
    shown = add_indices(cube, ["NDVI"]).withColumn(
        "day", utc_day(F.col("time"))
    )
    counts = cube.groupBy("parcel_key").agg(F.count_distinct("time").alias("n_dates"))
    return shown.hint("merge").join(counts, "parcel_key").select(
        *series.PROVENANCE, "parcel_key", "day", "y", "x", CLASS_BAND, "NDVI", "n_dates"
    )
