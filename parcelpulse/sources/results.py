"""Result tables: time series, and pixel cubes of kept or rejected parcels."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from parcelpulse.session import hold

logger = logging.getLogger(__name__)

FOLDERS = ("date_range", "source_file", "parcel_id")
CUBE_ORDER = ["date_range", "parcel_key", "time", "y", "x"]


def write_series(series: DataFrame, path: str, held: bool = False) -> bool:
    """Overwrite the result table; an empty result writes nothing and returns False.

    The result is held in the shared folder first (unless it is a held table already), so
    looking whether it is empty does not compute the run a second time.
    """
    table = series if held else hold(series, "series")
    if table.isEmpty():
        logger.warning("no parcel gave a result; nothing written to %s", path)
        return False
    table.write.mode("overwrite").parquet(path)
    return True


def read_series(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_cube(cube: DataFrame, path: str, by_parcel: bool = False) -> None:
    """Store a pixel cube, replacing the parcel files (or parcels) it holds.

    By default there is one folder per date range and parcel file, with data sorted by
    parcel, date and cell: a parcel is found by row group statistics, and the number of
    folders does not grow with the parcels. A run covers whole files, so it replaces what
    it made before and leaves the cubes of other files. ``by_parcel`` makes a folder per
    parcel below each date range. Range partitioning on the full sort key splits a large
    parcel over several files. A folder costs more than its few rows: with ``by_parcel`` the
    ranges are not put together by their bytes, so that all tasks make folders.
    """
    folders = ["date_range", "parcel_id" if by_parcel else "source_file"]
    order = folders[1:] + CUBE_ORDER
    spark = cube.sparkSession
    ranges = [int(spark.conf.get("spark.sql.shuffle.partitions"))] if by_parcel else []
    (
        hold(cube, "cube")  # the ranges are sampled first, which would compute the cube twice
        .repartitionByRange(*ranges, *order)
        .sortWithinPartitions("date_range", *[c for c in order if c != "date_range"])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .parquet(path)
    )


def read_cube(
    spark: SparkSession,
    path: str,
    required=("red", "nir"),
    schema: StructType | None = None,
) -> DataFrame:
    """All cubes below a folder. Folder values stay text, with leading zeros.

    A cube without rows has no file to read a schema from; pass the one it was written with.
    """
    fields = schema or spark.read.parquet(path).schema
    text = StructType(
        [StructField(f.name, StringType()) if f.name in FOLDERS else f for f in fields]
    )
    cube = spark.read.schema(text).parquet(path)
    absent = [b for b in required if b not in cube.columns]
    if absent:
        raise ValueError(f"{path}: the cube lacks {', '.join(absent)}")
    return cube
