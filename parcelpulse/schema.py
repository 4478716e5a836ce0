"""Table contracts and the closed list of bands and indices.

Tables that the plans take:

parcels  parcel_key LONG (unique per row), parcel_id STRING, source_file STRING,
         date_range STRING, start DATE, end DATE, rings RINGS
scenes   item_id (any type), collection STRING, datetime TIMESTAMP_NTZ, rings RINGS,
         cloud_cover DOUBLE, scale DOUBLE, offset DOUBLE, optional solar_lon DOUBLE, epsg INT
         (the zone that the pixels are stored in), and minx, miny, maxx, maxy DOUBLE, cell LONG
         (where the scene is filed, as write_scenes stores it)
pixels   item_id, y LONG, x LONG, one column per band, scl; one row per item and cell.
         Optional columns: parcel_key (samples already cut to a parcel window), epsg
         (the grid's UTM code), acq_day DATE (UTC day, best as partition column),
         px_seq LONG (order of repeated samples of one item and cell), and block_key, tile LONG
         (where the pixel is stored, as write_pixels makes them)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

VERTEX = T.StructType(
    [T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]
)
# One entry per ring. Holes and further parts are further rings: point tests use the
# odd-even rule over all of them.
RINGS = T.ArrayType(T.ArrayType(VERTEX))

PARCEL_FILE = T.StructType(
    [
        T.StructField("ID_PARCEL", T.StringType()),
        T.StructField("epsg", T.IntegerType()),
        T.StructField("rings", RINGS),
    ]
)

# A catalogue item as the public STAC specification lays it out. Coordinates stay text
# here because their nesting depth depends on the geometry type.
STAC_ITEM = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("collection", T.StringType()),
        T.StructField(
            "geometry",
            T.StructType(
                [
                    T.StructField("type", T.StringType()),
                    T.StructField("coordinates", T.StringType()),
                ]
            ),
        ),
        T.StructField("properties", T.StringType()),
        T.StructField("assets", T.StringType()),
    ]
)

WGS84 = 4326
CLASS_BAND = "scl"

# Class codes of clear pixels (vegetation, bare soil) and of no data.
CLEAR_CLASSES = (4, 5)
NODATA = 0

# Reflectance scaling used when an item carries none.
DEFAULT_SCALE = 0.0001
DEFAULT_OFFSET = 0.0

# Scene cloud limit in percent, parcel clear limit as a share.
MAX_CLOUD_COVER = 80
MIN_CLEAR_RATIO = 0.5

BASE_BANDS = ("red", "green", "blue", "nir")
SPECTRAL_BANDS = BASE_BANDS + ("swir16", "rededge1", "rededge2", "rededge3")


@dataclass(frozen=True)
class Index:
    """(plus - minus) / (plus + minus + soil) * (1 + soil)."""

    plus: str
    minus: str
    soil: float = 0.0

    @property
    def bands(self) -> tuple[str, str]:
        return (self.plus, self.minus)


# The indices, in output order.
INDICES = {
    "NDVI": Index("nir", "red"),
    "NDWI": Index("green", "nir"),
    "SAVI": Index("nir", "red", soil=0.5),
    "NBR": Index("nir", "swir16"),
    "NDBI": Index("swir16", "nir"),
    "NDRE1": Index("nir", "rededge1"),
    "NDRE2": Index("nir", "rededge2"),
    "NDRE3": Index("nir", "rededge3"),
}


def bands_for(indices) -> list[str]:
    """Spectral bands to load: the four base bands, then those the indices add."""
    wanted = {band for name in indices for band in INDICES[name].bands}
    return [b for b in SPECTRAL_BANDS if b in BASE_BANDS or b in wanted]


@dataclass(frozen=True)
class Grid:
    """Square pixel grid; cell k covers [k, k + 1) * step / denom on either axis.

    ``step`` and ``denom`` are kept apart so that a decimal resolution such as 0.01
    gives centres that are exact quotients of integers.
    """

    step: float
    denom: float = 1.0

    @property
    def resolution(self) -> float:
        return self.step / self.denom

    def centre(self, k: str) -> str:
        """SQL text of the centre of cell k."""
        return f"(({k} * {float(self.step)!r}D + {self.step / 2!r}D) / {float(self.denom)!r}D)"
