"""Same-day mosaics and the scale that belongs to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpulse.schema import NODATA

CELL_DAY = ["parcel_key", "solar_day", "y", "x"]


def item_order(df: DataFrame) -> str:
    """Order of items in a mosaic; repeated samples of one item follow px_seq."""
    return "struct(item_seq, px_seq)" if "px_seq" in df.columns else "item_seq"


def first_valid(band: str, order: str, value: str, fill: str) -> Column:
    """Aggregate: the value in the first item whose raw band is not nodata, or the fill."""
    chosen = f"min_by({value}, CASE WHEN {band} <> {NODATA} THEN {order} END)"
    return F.expr(f"coalesce({chosen}, {fill})").alias(band)


def solar_day_mosaic(pixels: DataFrame, bands: list[str], keys=None) -> DataFrame:
    """Merge the items of a solar day: per cell and band the first valid raw value.

    A cell without a valid value keeps 0. The key spreads one parcel over its cells and
    days, and partial aggregation runs before the shuffle, so neither a large parcel nor
    a busy day ends up in one task.
    """
    order = item_order(pixels)
    return pixels.groupBy(*(keys or CELL_DAY)).agg(
        *[first_valid(b, order, b, str(NODATA)) for b in bands]
    )


def reflectance_mosaic(
    pixels: DataFrame, bands: list[str], classes: list[str], keys=None
) -> DataFrame:
    """The mosaic with the spectral bands scaled by the row's own scale and offset.

    Nodata is judged on the raw value, and a cell without a valid value keeps a scaled 0,
    that is, the offset. Class bands stay raw.
    """
    order = item_order(pixels)
    fill = f"min_by(offset, {order})"
    return pixels.groupBy(*(keys or CELL_DAY)).agg(
        *[
            first_valid(b, order, f"cast({b} AS double) * scale + offset", fill)
            for b in bands
        ],
        *[first_valid(c, order, c, str(NODATA)) for c in classes],
    )


def first_item_scale(items: DataFrame, keys=("parcel_key",)) -> DataFrame:
    """Scale and offset of the first item (datetime, item_id order) per parcel.

    Takes either parcel-item pairs or parcel days, which name their first item.
    """
    first = F.min(F.struct("datetime", "item_id", "scale", "offset"))
    return (
        items.groupBy(*keys)
        .agg(first.alias("first"))
        .select(*keys, "first.scale", "first.offset")
    )
