"""Scene catalogue: clean-up of items and the search filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpulse.functions import dates, geometry
from parcelpulse.operators import layout
from parcelpulse.schema import DEFAULT_OFFSET, DEFAULT_SCALE, MAX_CLOUD_COVER


def item_cloud_cover(properties: Column) -> Column:
    return F.get_json_object(properties, "$['eo:cloud_cover']").try_cast("double")


def item_scale(assets: Column) -> tuple[Column, Column]:
    """(scale, offset) of the red asset's first raster band, with defaults."""
    band = "$.red['raster:bands'][0]"
    scale = F.get_json_object(assets, f"{band}.scale").try_cast("double")
    offset = F.get_json_object(assets, f"{band}.offset").try_cast("double")
    return F.coalesce(scale, F.lit(DEFAULT_SCALE)), F.coalesce(offset, F.lit(DEFAULT_OFFSET))


def filter_collection(scenes: DataFrame, collection: str) -> DataFrame:
    return scenes.where(F.col("collection") == collection)


def filter_cloud_cover(scenes: DataFrame, limit: float = MAX_CLOUD_COVER) -> DataFrame:
    """Strictly below the limit; a scene without the property does not match."""
    return scenes.where(F.col("cloud_cover") < F.lit(limit))


def filter_valid_items(scenes: DataFrame) -> DataFrame:
    return scenes.where(F.col("rings").isNotNull() & F.col("datetime").isNotNull())


def filter_date_range(scenes: DataFrame, start, end) -> DataFrame:
    """start and end are dates (or ISO strings); the whole end day is included."""
    start, end = F.lit(start).cast("date"), F.lit(end).cast("date")
    return scenes.where(
        (F.col("datetime") >= start.cast("timestamp_ntz"))
        & (F.col("datetime") < F.date_add(end, 1).cast("timestamp_ntz"))
    )


def boxes_overlap(a: str, b: str) -> Column:
    """Bounds of two aliased frames overlap; touching counts."""
    return (
        (F.col(f"{a}.minx") <= F.col(f"{b}.maxx"))
        & (F.col(f"{b}.minx") <= F.col(f"{a}.maxx"))
        & (F.col(f"{a}.miny") <= F.col(f"{b}.maxy"))
        & (F.col(f"{b}.miny") <= F.col(f"{a}.maxy"))
    )


def with_box(scenes: DataFrame) -> DataFrame:
    """Add the footprint's bounds, unless the table stores them."""
    stored = all(c in scenes.columns for c in geometry.BOUNDS)
    return scenes if stored else scenes.withColumns(geometry.bounds("rings"))


def with_cell(scenes: DataFrame) -> DataFrame:
    """Add the footprint's bounds and the one cell it is filed in, unless the table stores them."""
    boxed = with_box(scenes)
    if "cell" in boxed.columns:
        return boxed
    return layout.add_cell(boxed)


def filter_bbox(scenes: DataFrame, minx, miny, maxx, maxy) -> DataFrame:
    """Footprint bounds overlap one fixed box; touching counts.

    Scenes that carry their bounds as columns are skipped in the scan.
    """
    boxed = with_box(scenes)
    return boxed.where(
        (F.col("minx") <= maxx)
        & (F.col("maxx") >= minx)
        & (F.col("miny") <= maxy)
        & (F.col("maxy") >= miny)
    ).select(*scenes.columns)


def search(
    scenes: DataFrame,
    collection: str,
    max_cloud: float = MAX_CLOUD_COVER,
    start=None,
    end=None,
) -> DataFrame:
    """The catalogue search: collection, cloud, validity and, when given, dates.

    Parcels with dates of their own are matched to scenes by date in the spatial join.
    """
    if start is not None and end is not None:
        scenes = filter_date_range(scenes, start, end)
    scenes = filter_collection(filter_valid_items(scenes), collection)
    return filter_cloud_cover(scenes, max_cloud)


def with_days(scenes: DataFrame) -> DataFrame:
    """Add utc_day and solar_day (both DATE).

    The longitude is the item's own ``solar_lon`` or else its footprint's centroid.
    """
    own = "solar_lon" in scenes.columns
    lon = F.col("solar_lon") if own else F.expr(geometry.centroid("rings"))["x"]
    return scenes.withColumns(
        {
            "utc_day": F.to_date("datetime"),
            "solar_day": dates.solar_day(F.col("datetime"), lon),
        }
    )


def with_item_seq(scenes: DataFrame) -> DataFrame:
    """Add item_seq, a LONG that increases in (datetime, item_id) order.

    A global sort is range-partitioned, and the generated id grows with the partition
    and the row in it, so no single task sees all scenes. A primitive order key lets the
    mosaic use hash aggregation and keeps its shuffle rows short.
    """
    return scenes.orderBy("datetime", "item_id").withColumn(
        "item_seq", F.monotonically_increasing_id()
    )


def union_chunks(scenes: DataFrame, start, end) -> DataFrame:
    """All search chunks' items appended, with the chunk each came from.

    The chunks tile the range, so the chunk number is arithmetic on the item's day and the
    union needs neither a join nor a duplicate check.
    """
    found = filter_date_range(filter_valid_items(scenes), start, end)
    return found.withColumn(
        "chunk_idx",
        dates.chunk_of(F.to_date("datetime"), F.lit(start).cast("date")),
    )
