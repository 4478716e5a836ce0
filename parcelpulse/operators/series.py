"""Spatial means, provenance, result clean-up and counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.functions.geometry import is_polygon
from parcelpulse.functions.indices import require_indices
from parcelpulse.operators.clarity import PARCEL_DAY
from parcelpulse.operators.spatial import BATCH

PROVENANCE = ["parcel_id", "source_file", "date_range"]


def spatial_mean(cube: DataFrame, columns: list[str], keys=None) -> DataFrame:
    """Mean of every band and index over the cells of a parcel and day, skipping missing.

    Partial sums are formed before the shuffle, so only one row per parcel, day and task
    moves, whatever the size of the parcel.
    """
    return cube.groupBy(*(keys or PARCEL_DAY)).agg(*[F.avg(c).alias(c) for c in columns])


def day_times(days: DataFrame) -> DataFrame:
    """Time stamp of a solar day's group: that of its first item."""
    return days.groupBy(*PARCEL_DAY).agg(F.min("datetime").alias("time"))


def stamp_provenance(df: DataFrame, parcels: DataFrame) -> DataFrame:
    """Add parcel_id, source_file and date_range by parcel row, not by parcel id.

    Merged: a held parcel table is many times larger than its files, by which Catalyst would
    broadcast it.
    """
    return df.join(parcels.select("parcel_key", *PROVENANCE).hint("merge"), "parcel_key")


def stamp(df: DataFrame, days: DataFrame, parcels: DataFrame) -> DataFrame:
    """Add time and provenance to rows of parcels and solar days, such as the cells of a cube.

    Parcel days get both first, as they are fewer, so that ``df`` is joined once. Merged, as
    all tables with a row per parcel and day: held days are small as files only.
    """
    times = stamp_provenance(day_times(days), parcels)
    return df.join(times.hint("merge"), PARCEL_DAY)


def assemble_cube(df: DataFrame, bands: list[str], indices: list[str], keys: list[str]) -> DataFrame:
    """Bands and indices per cell, without the class band."""
    return df.select(*keys, *bands, *indices)


def drop_all_null(df: DataFrame, indices: list[str]) -> DataFrame:
    """Drop a row only when every requested index is missing."""
    require_indices(df, indices)
    return df.dropna(how="all", subset=list(indices))


def concat_results(frames: list[DataFrame]) -> DataFrame:
    """Stack results by column name; columns that one lacks are missing there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def parcel_column(columns: list[str]) -> str:
    """The first column whose name mentions an id or a parcel."""
    for name in columns:
        if "id" in name or "parcel" in name:
            return name
    raise ValueError(f"no parcel id column among {columns}")


def project_series(series: DataFrame, index: str = "NDVI") -> DataFrame:
    """The lines of a chart: parcel, time and one index, in plotting order."""
    require_indices(series, [index])
    parcel = parcel_column(series.columns)
    return series.select(parcel, "time", index).orderBy(parcel, "time")


def run_counters(batched: DataFrame, items: DataFrame, series: DataFrame) -> DataFrame:
    """Per batch: items found, parcels, parcels without a polygon, parcels done, points.

    ``batched`` has parcel_key, rings and the batch columns, ``items`` the batch columns and
    n_items (see ``spatial.count_in_boxes``), ``series`` parcel_key. Parcels without a polygon are dropped from a run and
    have no batch_id; they are counted per file and date range.
    """
    points = series.groupBy("parcel_key").agg(F.count("*").alias("points"))
    valid = F.expr(is_polygon("rings"))
    parcels = (
        batched.select("parcel_key", *BATCH, valid.alias("valid"))
        .join(points, "parcel_key", "left")
        .groupBy(*BATCH)
        .agg(
            F.count("*").alias("n_parcels"),
            F.count_if(~F.col("valid")).alias("n_dropped"),
            F.count("points").alias("n_done"),
            F.coalesce(F.sum("points"), F.lit(0)).cast("long").alias("n_points"),
        )
    )
    return parcels.join(items, BATCH, "left").fillna(0, ["n_items"])
