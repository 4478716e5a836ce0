"""Spectral indices and per-pixel band arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelpulse.schema import CLASS_BAND, CLEAR_CLASSES, INDICES, NODATA


def safe_ratio(num: str, den: str) -> str:
    """SQL text of num / den: IEEE signs at zero, but NULL (missing) for 0/0, not NaN."""
    return (
        f"(CASE WHEN {den} <> 0 THEN {num} / {den} WHEN {num} > 0 THEN double('Infinity')"
        f" WHEN {num} < 0 THEN double('-Infinity') END)"
    )


def index_value(name: str) -> Column:
    """The index over the band columns of the frame it is used in."""
    index = INDICES[name]
    a, b = f"cast({index.plus} AS double)", f"cast({index.minus} AS double)"
    if index.soil:
        ratio = safe_ratio(f"({a} - {b})", f"({a} + {b} + {index.soil}D)")
        return F.expr(f"{ratio} * {1 + index.soil}D")
    return F.expr(safe_ratio(f"({a} - {b})", f"({a} + {b})"))


def computable(df: DataFrame, indices) -> list[str]:
    """Requested indices whose bands exist, in the fixed order."""
    present = set(df.columns)
    return [n for n in INDICES if n in indices and set(INDICES[n].bands) <= present]


def add_indices(df: DataFrame, indices) -> DataFrame:
    """Append the computable indices; others get no column."""
    return df.select("*", *[index_value(n).alias(n) for n in computable(df, indices)])


def require_indices(df: DataFrame, indices) -> None:
    """Raise when a requested index has no column, naming what is missing."""
    absent = [n for n in indices if n not in df.columns]
    if absent:
        needs = {n: [b for b in INDICES[n].bands if b not in df.columns] for n in absent}
        raise ValueError(f"indices without a column (missing bands): {needs}")


def is_clear(scl: Column | None = None) -> Column:
    scl = F.col(CLASS_BAND) if scl is None else scl
    return scl.isin(*CLEAR_CLASSES)


def clear_share(scl: Column | None = None) -> Column:
    """1.0 clear, 0.0 not clear, NULL for no data: its mean is the clear ratio."""
    scl = F.col(CLASS_BAND) if scl is None else scl
    return F.when(scl != NODATA, is_clear(scl).cast("double"))


def mask_clear(df: DataFrame, bands) -> DataFrame:
    """Bands become missing where the pixel is not clear; no row is dropped."""
    classes = ", ".join(map(str, CLEAR_CLASSES))
    return df.withColumns(
        {b: F.expr(f"CASE WHEN {CLASS_BAND} IN ({classes}) THEN {b} END") for b in bands}
    )


def scale_bands(df: DataFrame, bands, scale="scale", offset="offset") -> DataFrame:
    """Raw value to reflectance for the given bands; every other column is unchanged."""
    return df.withColumns(
        {b: F.expr(f"cast({b} AS double) * {scale} + {offset}") for b in bands}
    )
