"""Day keys and date ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a search chunk runs from its first day to 365 days later, both included.
CHUNK_SPAN_DAYS = 365


def utc_day(datetime: Column) -> Column:
    """ISO text of the day. A cast keeps clear of the session's time zone, which
    date_format would apply to a TIMESTAMP_NTZ."""
    return datetime.cast("date").cast("string")


def solar_day(datetime: Column, lon: Column) -> Column:
    """Local solar date: UTC time moved by four minutes per degree of longitude."""
    shift = F.floor(lon * 240).cast("int")
    return F.timestamp_add("SECOND", shift, datetime).cast("date")


def format_date_range(start: Column, end: Column) -> Column:
    return F.concat_ws("_", start.cast("string"), end.cast("string"))


def parse_date_range(name: Column) -> tuple[Column, Column]:
    """(start, end) of a folder name; NULLs unless it is exactly two dates."""
    parts = F.split(name, "_")
    named = (F.size(parts) == 2) & ~name.startswith("_")
    start, end = (
        F.when(named, F.try_to_date(F.get(parts, i), "yyyy-MM-dd")) for i in (0, 1)
    )
    return start, end


def split_date_range(df: DataFrame, start="start", end="end") -> DataFrame:
    """One row per search chunk: adds chunk_idx, chunk_start, chunk_end.

    A range that starts after it ends gives no chunk.
    """
    step = CHUNK_SPAN_DAYS + 1
    return (
        df.where(F.col(start) <= F.col(end))
        .withColumn(
            "chunk_idx",
            F.explode(
                F.sequence(
                    F.lit(0).cast("long"),
                    F.floor(F.date_diff(F.col(end), F.col(start)) / step),
                )
            ),
        )
        .withColumn(
            "chunk_start",
            F.date_add(F.col(start), (F.col("chunk_idx") * step).cast("int")),
        )
        .withColumn(
            "chunk_end",
            F.least(F.date_add(F.col("chunk_start"), CHUNK_SPAN_DAYS), F.col(end)),
        )
    )


def chunk_of(day: Column, start: Column) -> Column:
    """Index of the chunk a day falls in; the chunks tile the range without overlap."""
    return F.floor(F.date_diff(day, start) / (CHUNK_SPAN_DAYS + 1))
