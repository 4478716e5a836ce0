"""Why a parcel has no result: faults of its own row, and what the run did not find for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpulse.functions import geometry
from parcelpulse.operators.series import PROVENANCE

FAILED = ["parcel_key", *PROVENANCE, "reason"]

_POINTS = "flatten(rings)"
_FINITE = "v.x IS NOT NULL AND v.y IS NOT NULL AND abs(v.x) < 1e300 AND abs(v.y) < 1e300"
_ON_EARTH = "abs(v.x) <= 180 AND abs(v.y) <= 90"

# Conditions in the order in which they are looked at, and what the report calls them. Each one
# may rely on those before it.
ROW_FAULTS = (
    ("rings IS NULL OR size(rings) = 0 OR exists(rings, r -> r IS NULL)", "no polygon"),
    ("exists(rings, r -> size(r) < 3)", "a ring of fewer than three vertices"),
    (f"exists({_POINTS}, v -> v IS NULL OR NOT ({_FINITE}))", "a vertex without a position"),
    (f"exists({_POINTS}, v -> NOT ({_ON_EARTH}))", "a vertex outside longitude and latitude"),
    (f"{geometry.centroid('rings')} IS NULL", "a polygon without area"),
    ("`start` IS NULL OR `end` IS NULL", "no dates"),
    ("`start` > `end`", "dates that end before they start"),
)
NO_SCENE = "no scene covers the parcel"
NO_USABLE_DAY = "no day is clear enough"
NO_INDEX = "no index has a value"


def row_fault() -> Column:
    """The first fault of a parcel row with dates; missing when there is none."""
    cases = " ".join(f"WHEN {holds} THEN '{reason}'" for holds, reason in ROW_FAULTS)
    return F.expr(f"CASE {cases} END")


def faulty(judged: DataFrame) -> DataFrame:
    """Of parcels with the ``reason`` of ``row_fault``, those that have one."""
    return judged.where("reason IS NOT NULL").select(*FAILED)


def without_result(
    parcels: DataFrame, days: DataFrame, usable: DataFrame, series: DataFrame
) -> DataFrame:
    """Sound parcels that have no row in ``series``, with what they lack first.

    Merged: held days and points are small as files only.
    """

    def known(df: DataFrame, flag: str) -> DataFrame:
        return df.select("parcel_key", F.lit(True).alias(flag)).distinct().hint("merge")

    reason = (
        F.when(F.col("has_scene").isNull(), NO_SCENE)
        .when(F.col("has_day").isNull(), NO_USABLE_DAY)
        .otherwise(NO_INDEX)
    )
    return (
        parcels.select("parcel_key", *PROVENANCE)
        .join(series.select("parcel_key").hint("merge"), "parcel_key", "left_anti")
        .join(known(days, "has_scene"), "parcel_key", "left")
        .join(known(usable, "has_day"), "parcel_key", "left")
        .withColumn("reason", reason)
        .select(*FAILED)
    )
