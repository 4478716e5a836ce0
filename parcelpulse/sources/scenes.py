"""Scene catalogue: STAC items as JSON lines, or the flat table made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelpulse.operators.catalogue import item_cloud_cover, item_scale, with_cell
from parcelpulse.schema import STAC_ITEM

_POLYGON = "array<array<array<double>>>"


def _rings(geometry: Column) -> Column:
    """Rings of a GeoJSON polygon or multipolygon; other types and NULL give NULL."""
    coordinates = geometry["coordinates"]
    nested = F.when(
        geometry["type"] == "Polygon", F.from_json(coordinates, _POLYGON)
    ).when(
        geometry["type"] == "MultiPolygon",
        F.flatten(F.from_json(coordinates, f"array<{_POLYGON}>")),
    )

    def vertex(position):
        return F.struct(
            F.get(position, F.lit(0)).alias("x"), F.get(position, F.lit(1)).alias("y")
        )

    return F.transform(nested, lambda ring: F.transform(ring, vertex))


def in_utc(text: Column) -> Column:
    """Time stamp in UTC; without an offset it is one already, and no time stamp is missing."""
    offset = F.regexp_extract(text, r"[+-]\d\d:?\d\d$", 0)
    minutes = F.substring(offset, 2, 2).try_cast("int") * 60 + F.substring(offset, -2, 2).try_cast("int")
    late = F.when(offset.startswith("-"), -minutes).otherwise(minutes)
    clock = F.regexp_replace(text, r"(Z|[+-]\d\d:?\d\d)$", "").try_cast("timestamp_ntz")
    return clock - F.make_dt_interval(mins=F.coalesce(late, F.lit(0)))


def flatten_items(items: DataFrame) -> DataFrame:
    """STAC items to the scene table: the searched properties become real columns.

    Written as Parquet, the cloud limit, the dates and the place are then pushed into the scan,
    which a property inside a JSON string never is. Times with another offset than UTC are
    turned to UTC; those without one are UTC. ``minx`` to ``maxy`` and ``cell`` file the scene by
    its footprint, and ``epsg`` is the zone its pixels are stored in, if the item says so.
    """
    scale, offset = item_scale(F.col("assets"))
    acquired = F.get_json_object("properties", "$.datetime")
    projected = F.coalesce(
        F.get_json_object("properties", "$['proj:epsg']"),
        F.regexp_extract(F.get_json_object("properties", "$['proj:code']"), "^EPSG:([0-9]+)$", 1),
    )
    flat = items.select(
        F.col("id").alias("item_id"),
        "collection",
        in_utc(acquired).alias("datetime"),
        _rings(F.col("geometry")).alias("rings"),
        item_cloud_cover(F.col("properties")).alias("cloud_cover"),
        scale.alias("scale"),
        offset.alias("offset"),
        projected.try_cast("int").alias("epsg"),
    )
    return with_cell(flat)


def write_scenes(scenes: DataFrame, path: str) -> None:
    """Store the flat scene table sorted by cell and time, so that a search reads ranges of both."""
    filed = with_cell(scenes)
    (
        filed.repartitionByRange("cell", "datetime")
        .sortWithinPartitions("cell", "datetime")
        .write.mode("overwrite")
        .parquet(path)
    )


def read_scenes(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """``json`` reads STAC items, one per line; ``parquet`` the flat scene table."""
    if file_format == "json":
        return flatten_items(spark.read.schema(STAC_ITEM).json(path))
    return spark.read.format(file_format).load(path)
