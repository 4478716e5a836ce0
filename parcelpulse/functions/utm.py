"""UTM zone choice, projection and its inverse (Krueger series to the third order in n)."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# WGS84 ellipsoid, UTM scale factor and false origin.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
SCALE_FACTOR = 0.9996
FALSE_EASTING = 500000.0
FALSE_NORTHING_SOUTH = 10000000.0

_N = FLATTENING / (2 - FLATTENING)
_RADIUS = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ECC = 2 * math.sqrt(_N) / (1 + _N)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16,
    13 * _N**2 / 48 - 3 * _N**3 / 5,
    61 * _N**3 / 240,
)

_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96,
    _N**2 / 48 + _N**3 / 15,
    17 * _N**3 / 480,
)
_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3,
    7 * _N**2 / 3 - 8 * _N**3 / 5,
    56 * _N**3 / 15,
)


def utm_epsg(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """EPSG code of the six-degree zone at the centre of the bounds."""
    lon = (minx + maxx) / 2
    lat = (miny + maxy) / 2
    zone = F.least(F.floor((lon + 180) / 6) + 1, F.lit(60).cast("long"))
    return (F.when(lat < 0, F.lit(32700)).otherwise(F.lit(32600)) + zone).cast("int")


_SCALE = SCALE_FACTOR * _RADIUS


def _south(epsg: str) -> str:
    return f"CASE WHEN {epsg} >= 32700 THEN {FALSE_NORTHING_SOUTH!r}D ELSE 0D END"


def _centre(epsg: str) -> str:
    return f"({epsg} % 100 * 6 - 183)"


def _series(start: str, sign: str, weights, trig: str, hyperbolic: str, xi: str, eta: str) -> str:
    terms = (
        f" {sign} {w!r}D * {trig}({2 * j} * {xi}) * {hyperbolic}({2 * j} * {eta})"
        for j, w in enumerate(weights, start=1)
    )
    return start + "".join(terms)


# Each way is a chain of steps: names, and SQL text over the names before. A step is written
# out once, so expressions stay short.


def _forward(lon: str, lat: str, epsg: str) -> list[dict[str, str]]:
    return [
        {"s": f"sin(radians({lat}))", "d": f"radians({lon} - {_centre(epsg)})"},
        {"t": f"sinh(atanh(s) - {_ECC!r}D * atanh({_ECC!r}D * s))", "d": "d"},
        {"xi": "atan2(t, cos(d))", "eta": "atanh(sin(d) / sqrt(1 + t * t))"},
        {
            "x": f"{FALSE_EASTING!r}D + {_SCALE!r}D * ({_series('eta', '+', _ALPHA, 'cos', 'sinh', 'xi', 'eta')})",
            "y": f"{_south(epsg)} + {_SCALE!r}D * ({_series('xi', '+', _ALPHA, 'sin', 'cosh', 'xi', 'eta')})",
        },
    ]


def _backward(easting: str, northing: str, epsg: str) -> list[dict[str, str]]:
    lat = "chi" + "".join(f" + {w!r}D * sin({2 * j} * chi)" for j, w in enumerate(_DELTA, start=1))
    return [
        {
            "xi": f"({northing} - ({_south(epsg)})) / {_SCALE!r}D",
            "eta": f"({easting} - {FALSE_EASTING!r}D) / {_SCALE!r}D",
        },
        {
            "u": _series("xi", "-", _BETA, "sin", "cosh", "xi", "eta"),
            "v": _series("eta", "-", _BETA, "cos", "sinh", "xi", "eta"),
        },
        {"chi": "asin(sin(u) / cosh(v))", "u": "u", "v": "v"},
        {"x": f"degrees(atan2(sinh(v), cos(u))) + {_centre(epsg)}", "y": f"degrees({lat})"},
    ]


def _add(df: DataFrame, steps: list[dict[str, str]], x: str, y: str) -> DataFrame:
    """``df`` with the chain's x and y; every step is a projection of its own."""
    kept = df.columns
    for step in steps:
        df = df.select(*(F.col(c) for c in kept), *(F.expr(_prefixed(text)).alias(f"_tm_{name}") for name, text in step.items()))
    return df.select(*kept, F.col("_tm_x").alias(x), F.col("_tm_y").alias(y))


def _prefixed(text: str) -> str:
    return re.sub(r"\b(s|d|t|xi|eta|u|v|chi)\b", r"_tm_\1", text)


def add_projected(df: DataFrame, lon: str, lat: str, epsg: str, x: str, y: str) -> DataFrame:
    """Add easting and northing in metres in the UTM zone that the EPSG code names."""
    return _add(df, _forward(lon, lat, epsg), x, y)


def add_unprojected(df: DataFrame, easting: str, northing: str, epsg: str, x: str, y: str) -> DataFrame:
    """Add longitude and latitude in degrees of a point in metres."""
    return _add(df, _backward(easting, northing, epsg), x, y)


def zones_near(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """EPSG codes of all zones in which imagery with these bounds may be stored.

    Tiles reach over the border of their zone and over the equator, so one more zone on each
    side counts, and the other hemisphere within a degree.
    """
    first, last = (F.floor((lon + 180) / 6) for lon in (minx, maxx))
    numbers = F.transform(F.sequence(first - 1, last + 1), lambda z: (F.pmod(z, F.lit(60)) + 1).cast("int"))

    def codes(base: int) -> Column:
        return F.transform(numbers, lambda z: z + base)

    none = F.array().cast("array<int>")
    north, south = F.when(maxy > -1, codes(32600)), F.when(miny < 1, codes(32700))
    return F.array_distinct(F.concat(F.coalesce(north, none), F.coalesce(south, none)))


def project_rings(rings: str, epsg: str) -> Column:
    """The rings in metres in the UTM zone that the EPSG code names."""
    first, *steps = _forward("v.x", "v.y", epsg)
    body = ", ".join(f"'{name}', {text}" for name, text in first.items())
    vertices = f"transform(r, v -> named_struct({body}))"
    for step in steps:
        body = ", ".join(f"'{name}', " + re.sub(r"\b(s|d|t|xi|eta)\b", r"w.\1", text) for name, text in step.items())
        vertices = f"transform({vertices}, w -> named_struct({body}))"
    return F.expr(f"transform({rings}, r -> {vertices})")
