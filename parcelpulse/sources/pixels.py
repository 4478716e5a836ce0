"""Pixel samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelpulse.operators import layout
from parcelpulse.plans.time_series import sample_columns
from parcelpulse.schema import CLASS_BAND


def read_pixels(spark: SparkSession, path: str, bands: list[str]) -> DataFrame:
    """The identity columns, the class band and only the bands asked for.

    The projection reaches the Parquet scan. Tables of ``write_pixels`` also carry their block
    key and tile, by which a run skips what lies between its parcels.
    """
    table = spark.read.parquet(path)
    absent = [b for b in bands if b not in table.columns]
    if absent:
        raise ValueError(f"{path}: no band {', '.join(absent)}")
    classes = [CLASS_BAND] if CLASS_BAND in table.columns else []
    return sample_columns(table, [*bands, *classes])


def write_pixels(pixels: DataFrame, path: str, day: str = "acq_day") -> None:
    """Store samples for scanning: a folder per day and tile, files sorted by block.

    Adds ``block_key``, which grows along a space-filling curve over the blocks of a zone, and
    ``tile``, its leading bits. A run reads ranges of both, so that folders, files and row groups
    between its parcels are skipped.
    """
    placed = layout.add_block(pixels.drop("block_key", "tile"))
    keyed = layout.add_block_key(placed).drop("block_y", "block_x")
    keyed = keyed.withColumn("tile", layout.tile_of(F.col("block_key")))
    folders = [day, "tile"]
    (
        keyed.repartitionByRange(*folders, "block_key")
        .sortWithinPartitions(*folders, "block_key", "y", "x")
        .write.mode("overwrite")
        .partitionBy(*folders)
        .parquet(path)
    )
