"""Parcels, scenes and pixels derived from supplier, orders and lineitem.

The derivation is deterministic integer arithmetic, written a second time as SQL in
``oracles.py``. Pixel cells lie on one shared grid of 0.01 degrees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelpulse.functions import utm
from parcelpulse.operators.catalogue import item_cloud_cover, item_scale
from parcelpulse.schema import Grid

COLLECTION = "l2a"
# All orders, so all scenes, lie between these days.
START, END = "1995-01-01", "2001-12-31"
GRID = Grid(10, 1000)
COARSE_GRID = Grid(20, 1000)
UTM_GRID = Grid(1000)

# Ring of a parcel in milli-degrees from its origin, and of a scene
# footprint in degrees from its corner.
PARCEL_RING = ((1, 2), (49, 11), (41, 48), (21, 19), (12, 41))
FOOTPRINT = ((0.0, 0.0), (5.5, 0.3), (5.2, 5.5), (-0.3, 5.2))
# Date folders that the parcels are spread over by key.
RANGES = (
    ("1995-01-01", "1997-06-30"),
    ("1997-07-01", "2001-12-31"),
    ("1995-01-01", "2001-12-31"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ring(vertices):
    return F.array(F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in vertices]))


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One concave five-vertex parcel per supplier."""
    key = F.col("s_suppkey")
    ring = [
        (
            F.expr(f"cast((s_suppkey * 37) % 1400 * 10 - 5000 + {dx} AS double) / 1000"),
            F.expr(f"cast((s_suppkey * 53) % 900 * 10 + 42000 + {dy} AS double) / 1000"),
        )
        for dx, dy in PARCEL_RING
    ]

    def by_key(choices):
        first, second, third = (F.lit(c) for c in choices)
        return F.when(key % 3 == 0, first).when(key % 3 == 1, second).otherwise(third)

    return table(spark, sf_dir, "supplier").select(
        key.alias("parcel_key"),
        key.cast("string").alias("parcel_id"),
        F.when(key % 2 == 0, "a.parquet").otherwise("b.parquet").alias("source_file"),
        by_key(["_".join(r) for r in RANGES]).alias("date_range"),
        by_key([r[0] for r in RANGES]).cast("date").alias("start"),
        by_key([r[1] for r in RANGES]).cast("date").alias("end"),
        _ring(ring).alias("rings"),
    )


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scene item per order, with its nested documents and the columns from them."""
    ring = [(F.col("lon0") + dx, F.col("lat0") + dy) for dx, dy in FOOTPRINT]
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    base = orders.selectExpr(
        "o_orderkey AS item_id",
        "CASE WHEN o_orderkey % 7 = 0 THEN 'l2a-old' ELSE 'l2a' END AS collection",
        "timestampadd(HOUR, cast(o_orderkey % 24 AS int),"
        " cast(trunc(o_orderdate, 'month') AS timestamp_ntz)) AS datetime",
        "CASE WHEN o_orderkey % 10 = 3 THEN '{}' ELSE concat("
        "'{\"eo:cloud_cover\":', cast((o_orderkey * 17) % 100 AS string), '}')"
        " END AS properties",
        "CASE WHEN o_orderkey % 50 <> 1"
        " THEN cast((o_custkey % 3) * 5 - 6 AS double) END AS lon0",
        "cast((o_custkey % 2) * 5 + 41 AS double) AS lat0",
        "CASE WHEN o_orderkey % 5 = 2 THEN '{\"red\":{\"raster:bands\":[{}]}}'"
        " WHEN o_orderkey % 3 = 0"
        " THEN '{\"red\":{\"raster:bands\":[{\"scale\":0.0001,\"offset\":-0.1}]}}'"
        " ELSE '{\"red\":{\"raster:bands\":[{\"scale\":0.0001,\"offset\":0}]}}'"
        " END AS assets",
    )
    scale, offset = item_scale(F.col("assets"))
    return base.select(
        "item_id",
        "collection",
        "datetime",
        F.when(F.col("lon0").isNotNull(), _ring(ring)).alias("rings"),
        F.col("lon0").alias("solar_lon"),
        "properties",
        "assets",
        item_cloud_cover(F.col("properties")).alias("cloud_cover"),
        scale.alias("scale"),
        offset.alias("offset"),
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw sample per line item, on five by five cells over the parcel's box."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"
    )
    return (
        lines
        .selectExpr(
            "l_suppkey AS parcel_key",
            "l_orderkey AS item_id",
            "l_linenumber % 5 + (l_suppkey * 53) % 900 + 4200 AS y",
            "l_partkey % 5 + (l_suppkey * 37) % 1400 - 500 AS x",
            "l_orderkey * 31 + l_partkey * 7 + l_linenumber * 11 AS px_seq",
        )
        .selectExpr(
            "parcel_key",
            "item_id",
            "y",
            "x",
            "px_seq",
            "CASE WHEN px_seq % 41 = 0 THEN 0 ELSE (px_seq * 7) % 3000 + 1 END AS red",
            "(px_seq * 11) % 3500 + 1 AS green",
            "(px_seq * 5) % 2500 + 1 AS blue",
            "(px_seq * 19) % 6000 + 1 AS nir",
            "(px_seq * 29) % 5000 + 1 AS swir16",
            "(px_seq * 13) % 4000 + 1 AS rededge1",
            "(px_seq * 17) % 4500 + 1 AS rededge2",
            "(px_seq * 23) % 5500 + 1 AS rededge3",
            "CASE WHEN px_seq % 20 < 12 THEN px_seq % 20"
            " WHEN px_seq % 20 < 17 THEN 4 ELSE 5 END AS scl",
        )
    )


def cloudy_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pixels, with every third parcel under clouds whenever it would be clear."""
    return pixels(spark, sf_dir).withColumn(
        "scl", F.expr("CASE WHEN parcel_key % 3 = 1 AND scl IN (4, 5) THEN 8 ELSE scl END")
    )


def far_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parcels, every fifth of them forty degrees east, where no scene lies."""
    away = F.expr("CASE WHEN parcel_key % 5 = 2 THEN 40e0 ELSE 0e0 END")

    def moved(ring):
        return F.transform(ring, lambda v: F.struct((v["x"] + away).alias("x"), v["y"].alias("y")))

    return parcels(spark, sf_dir).withColumn("rings", F.transform("rings", moved))


def damaged_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The far parcels, some of them with rows that no run can use."""
    spoiled = {
        "rings": "CASE parcel_key % 11 WHEN 1 THEN NULL"
        " WHEN 3 THEN transform(rings, r -> slice(r, 1, 2))"
        " WHEN 4 THEN transform(rings, r -> transform(r, v ->"
        " named_struct('x', v.x, 'y', v.y * double('nan'))))"
        " WHEN 5 THEN transform(rings, r -> transform(r, v -> named_struct('x', v.x, 'y', v.y + 60)))"
        " WHEN 6 THEN transform(rings, r -> transform(r, v -> named_struct('x', v.x, 'y', 45e0)))"
        " ELSE rings END",
        "start": "CASE parcel_key % 11 WHEN 8 THEN NULL WHEN 9 THEN date'2002-01-01' ELSE start END",
    }
    dated = far_parcels(spark, sf_dir).withColumns(
        {"start": F.lit(START).cast("date"), "end": F.lit(END).cast("date")}
    )
    return dated.withColumns({name: F.expr(text) for name, text in spoiled.items()})


def utm_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scenes with the zone their pixels are stored in: one or the other that they touch."""
    zone = (
        "CASE solar_lon WHEN -6 THEN 32630 WHEN -1 THEN 32630 + item_id % 2"
        " WHEN 4 THEN 32631 + item_id % 2 END"
    )
    return scenes(spark, sf_dir).withColumn("epsg", F.expr(zone).cast("int"))


def utm_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples on a grid of a kilometre in the zone of their scene, without a parcel."""
    zones = utm_scenes(spark, sf_dir).where("epsg IS NOT NULL").select("item_id", "epsg")
    res = UTM_GRID.resolution
    placed = (
        pixels(spark, sf_dir)
        .drop("parcel_key")
        .join(zones, "item_id")
        .withColumns({"lon": F.expr(GRID.centre("x")), "lat": F.expr(GRID.centre("y"))})
    )
    return (
        utm.add_projected(placed, "lon", "lat", "epsg", "easting", "northing")
        .withColumns({"y": F.floor(F.col("northing") / res), "x": F.floor(F.col("easting") / res)})
        .drop("lon", "lat", "easting", "northing")
    )


def coarse_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A class table on the grid of twice the cell size: per item and parcel, the class of
    the first sample (by cell and px_seq) that falls in the coarse cell."""
    fine = pixels(spark, sf_dir)
    return fine.groupBy(
        "parcel_key",
        "item_id",
        F.floor(F.col("y") / 2).alias("y"),
        F.floor(F.col("x") / 2).alias("x"),
    ).agg(
        F.min_by(
            "scl", F.struct(fine["y"].alias("fy"), fine["x"].alias("fx"), "px_seq")
        ).alias("scl")
    )
