"""Parcel files below one folder per date range."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from parcelpulse.functions.dates import parse_date_range
from parcelpulse.operators.spatial import drop_invalid_parcels
from parcelpulse.schema import PARCEL_FILE, WGS84

# Date folder and parcel file at the end of a path; a file may be a folder of part files.
PLACE = r"/([0-9]+-[0-9]+-[0-9]+_[0-9]+-[0-9]+-[0-9]+)/([^/]+)(?:/[^/]+)?$"


def _place(path: Column, part: int) -> Column:
    """Name of the date folder (1) or file (2), taken from the end of the path.

    So it is the same for any spelling of the root. File paths in the metadata are
    URL-encoded, with a plus sign left as it is.
    """
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(plain, PLACE, part)


def schema_groups(spark: SparkSession, files: list[str]) -> list[tuple[StructType, list[str]]]:
    """Files in groups whose columns agree in type, with the types of each group.

    Spark reads the footers of a group in parallel and merges them. Where types differ, the
    group is halved: files of one type cost one job, however many they are.
    """
    try:
        return [(spark.read.option("mergeSchema", "true").parquet(*files).schema, files)]
    except (PySparkException, Py4JJavaError) as error:
        if len(files) == 1 or "CANNOT_MERGE" not in str(error):
            raise
    half = len(files) // 2
    return schema_groups(spark, files[:half]) + schema_groups(spark, files[half:])


def _literal(path: str) -> str:
    """A listed path as a reader takes it: decoded, with no character left to match others."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(path))


def _as_contract(frame: DataFrame) -> DataFrame:
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in PARCEL_FILE]
    return frame.select(*columns, F.col("_metadata.file_path").alias("file_path"))


def _read_each_type(spark: SparkSession, found: DataFrame) -> DataFrame:
    """Parquet files read with the types they have, and turned to those of the contract.

    Ids may be numbers in one file and text in another.
    """
    files = [_literal(f) for f in sorted(found.inputFiles())]
    if not files:
        return _as_contract(found)
    by_types: dict[tuple, list[str]] = {}
    for schema, group in schema_groups(spark, files):
        own = {f.name: f.dataType for f in schema}
        types = tuple(own.get(f.name, f.dataType) for f in PARCEL_FILE)
        by_types.setdefault(types, []).extend(group)
    frames = [
        _as_contract(
            spark.read.schema(
                StructType([StructField(f.name, t) for f, t in zip(PARCEL_FILE, types, strict=True)])
            ).parquet(*group)
        )
        for types, group in by_types.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def scan_date_folders(spark: SparkSession, root: str, file_format="parquet") -> DataFrame:
    """Raw parcel rows with date_range, start, end and source_file from their path.

    Files lie directly in a folder named ``YYYY-MM-DD_YYYY-MM-DD``; a file may also be a
    folder of part files that Spark wrote. Other folder names, and those that begin with
    an underscore, are left out. The path conditions only use file metadata, which Spark
    prunes files by. The columns of Parquet files may be of any type that casts to the
    contract's, and differ between files.
    """
    found = (
        spark.read.schema(PARCEL_FILE)
        .format(file_format)
        .load(f"{root.rstrip('/')}/[^_]*/[^_.]*")
    )
    raw = _read_each_type(spark, found) if file_format == "parquet" else _as_contract(found)
    named = raw.withColumns(
        {
            "date_range": _place(F.col("file_path"), 1),
            "source_file": _place(F.col("file_path"), 2),
        }
    )
    start, end = parse_date_range(F.col("date_range"))
    return named.withColumns({"start": start, "end": end}).where(
        F.col("start").isNotNull() & F.col("end").isNotNull()
    )


def check_parcel_files(spark: SparkSession, raw: DataFrame, file_format="parquet") -> None:
    """Raise for a file without an ID_PARCEL column or in a CRS other than WGS84.

    One aggregation finds the files in doubt (no id at all, or a foreign CRS); only those
    are opened to see their columns.
    """
    doubtful = (
        raw.groupBy("file_path")
        .agg(
            F.count("ID_PARCEL").alias("ids"),
            F.max(F.coalesce("epsg", F.lit(WGS84)) != WGS84).alias("foreign"),
        )
        .where((F.col("ids") == 0) | F.col("foreign"))
    )
    for row in doubtful.toLocalIterator():
        if row["foreign"]:
            raise ValueError(f"{row['file_path']}: parcels must be in EPSG:{WGS84}")
        columns = spark.read.format(file_format).load(row["file_path"]).columns
        if "ID_PARCEL" not in columns:
            raise ValueError(
                f"{row['file_path']}: no parcel ids, the columns are {columns} without ID_PARCEL"
            )


def read_parcels(
    spark: SparkSession,
    root: str,
    file_format="parquet",
    validate: bool = True,
    keep_faulty: bool = False,
) -> DataFrame:
    """The parcel table of every date folder.

    Rows without a polygon are dropped, unless a run is to report them (``keep_faulty``).

    parcel_key identifies the row, because two rows may share an ID_PARCEL. It depends on
    the order of the file splits only, which stays the same while the files do.
    """
    raw = scan_date_folders(spark, root, file_format)
    if validate:
        check_parcel_files(spark, raw, file_format)
    keyed = raw.select(
        F.monotonically_increasing_id().alias("parcel_key"),
        F.col("ID_PARCEL").alias("parcel_id"),
        "source_file",
        "date_range",
        "start",
        "end",
        F.coalesce("epsg", F.lit(WGS84)).alias("epsg"),
        "rings",
    )
    return keyed if keep_faulty else drop_invalid_parcels(keyed)
