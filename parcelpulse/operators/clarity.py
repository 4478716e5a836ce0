"""Clear-sky test per parcel and day, and the parcels that pass or fail it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.functions.indices import clear_share
from parcelpulse.schema import MIN_CLEAR_RATIO

PARCEL_DAY = ["parcel_key", "solar_day"]


def clear_ratio(class_mosaic: DataFrame, keys=None) -> DataFrame:
    """Share of clear cells among those with data; missing when none has data."""
    return class_mosaic.groupBy(*(keys or PARCEL_DAY)).agg(
        F.avg(clear_share()).alias("clear_ratio")
    )


def usable_days(ratios: DataFrame, min_clear: float = MIN_CLEAR_RATIO) -> DataFrame:
    """Days with a ratio strictly above the limit; a missing ratio does not pass."""
    return ratios.where(F.col("clear_ratio") > F.lit(min_clear))


def clear_summary(
    ratios: DataFrame, days: DataFrame, min_clear: float = MIN_CLEAR_RATIO
) -> DataFrame:
    """Per parcel: usable and total dates, best ratio, mean ratio of the usable dates.

    Every date with an item counts towards the total, also one without a valid pixel.
    """
    dated = days.select(*PARCEL_DAY).distinct().join(ratios, PARCEL_DAY, "left")
    usable = F.col("clear_ratio") > F.lit(min_clear)
    return dated.groupBy("parcel_key").agg(
        F.count_if(usable).alias("n_usable"),
        F.count("*").alias("n_dates"),
        F.coalesce(F.max("clear_ratio"), F.lit(0.0)).alias("max_ratio"),
        F.avg(F.when(usable, F.col("clear_ratio"))).alias("mean_usable_ratio"),
    )


def keep_usable(items: DataFrame, usable: DataFrame, utc_day_match: bool = False) -> DataFrame:
    """Items (or parcel days) on usable days.

    By default days match as they were grouped, by solar day. With ``utc_day_match`` an
    item is kept when its UTC day equals the UTC day of the first item of some usable
    group, which loses items whose group began on the UTC day before. Merged: a held table of
    usable days is many times larger than its files, by which Catalyst would broadcast it.
    """
    usable = usable.hint("merge")
    if not utc_day_match:
        return items.join(usable, PARCEL_DAY, "left_semi")
    first = items.groupBy(*PARCEL_DAY).agg(F.to_date(F.min("datetime")).alias("utc_day"))
    days = first.join(usable, PARCEL_DAY, "left_semi").select("parcel_key", "utc_day")
    return items.join(days.hint("merge"), ["parcel_key", "utc_day"], "left_semi")


def without_scene(parcels: DataFrame, matched: DataFrame) -> DataFrame:
    """Parcels that no scene intersects."""
    return parcels.join(matched.hint("merge"), "parcel_key", "left_anti")


def rejected(parcels: DataFrame, matched: DataFrame, usable: DataFrame) -> DataFrame:
    """Parcels with scenes but without a usable day."""
    return parcels.join(matched.hint("merge"), "parcel_key", "left_semi").join(
        usable.hint("merge"), "parcel_key", "left_anti"
    )
