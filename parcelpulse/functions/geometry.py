"""Planar polygon geometry on ``rings`` columns, as built-in array expressions.

The functions take SQL text (mostly a column name) and give SQL text, so that they nest
inside the lambdas of array functions; ``F.expr`` makes a column of the result. An edge is
STRUCT<x1, y1, x2, y2>. A ring may or may not repeat its first vertex at the end; the
closing edge is then of length zero, which none of the tests below count.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOUNDS = ("minx", "miny", "maxx", "maxy")


def is_polygon(rings: str) -> str:
    """At least one ring, and every ring has three vertices or more."""
    return f"coalesce(size({rings}) > 0 AND forall({rings}, r -> size(r) >= 3), false)"


def edges(rings: str) -> str:
    following = "concat(slice(r, 2, size(r)), slice(r, 1, 1))"
    edge = "named_struct('x1', a.x, 'y1', a.y, 'x2', b.x, 'y2', b.y)"
    return f"flatten(transform({rings}, r -> zip_with(r, {following}, (a, b) -> {edge})))"


def ring_starts(rings: str) -> str:
    """One vertex per ring: enough to tell containment once no edges touch."""
    return f"transform({rings}, r -> get(r, 0))"


def bounds(rings: str) -> dict[str, Column]:
    def extreme(pick, axis):
        return F.expr(f"array_{pick}(transform(flatten({rings}), v -> v.{axis}))")

    return {
        "minx": extreme("min", "x"),
        "miny": extreme("min", "y"),
        "maxx": extreme("max", "x"),
        "maxy": extreme("max", "y"),
    }


def straddles(e: str, py: str) -> str:
    """The edge passes the horizontal line at py (half-open, so vertices count once)."""
    return f"(({e}.y1 > {py}) <> ({e}.y2 > {py}))"


def crossing_x(e: str, py: str) -> str:
    """Where the edge meets the line at py; NULL for a horizontal edge."""
    return (
        f"(CASE WHEN {e}.y1 <> {e}.y2 THEN "
        f"({e}.x2 - {e}.x1) * ({py} - {e}.y1) / ({e}.y2 - {e}.y1) + {e}.x1 END)"
    )


def row_crossings(polygon_edges: str, py: str) -> str:
    """Where the polygon's outline meets the horizontal line at py."""
    return (
        f"transform(filter({polygon_edges}, e -> {straddles('e', py)}), "
        f"e -> {crossing_x('e', py)})"
    )


def right_of(crossings: str, px: str) -> str:
    """Odd-even rule: an odd number of crossings lies to the right of px."""
    return f"(size(filter({crossings}, c -> {px} < c)) % 2 = 1)"


def contains(polygon_edges: str, px: str, py: str) -> str:
    """Ray casting on one point."""
    hit = f"{straddles('e', py)} AND {px} < {crossing_x('e', py)}"
    return f"(size(filter({polygon_edges}, e -> {hit})) % 2 = 1)"


def segments_touch(a: str, b: str) -> str:
    """The two segments share a point; meeting at an end counts."""

    def side(s, t, end):
        return (
            f"(({s}.x2 - {s}.x1) * ({t}.y{end} - {s}.y1)"
            f" - ({s}.y2 - {s}.y1) * ({t}.x{end} - {s}.x1))"
        )

    def spans(s, t, axis):
        return (
            f"least({s}.{axis}1, {s}.{axis}2) <= greatest({t}.{axis}1, {t}.{axis}2)"
            f" AND least({t}.{axis}1, {t}.{axis}2) <= greatest({s}.{axis}1, {s}.{axis}2)"
        )

    return (
        f"({spans(a, b, 'x')} AND {spans(a, b, 'y')}"
        f" AND {side(a, b, 1)} * {side(a, b, 2)} <= 0"
        f" AND {side(b, a, 1)} * {side(b, a, 2)} <= 0)"
    )


def intersects(a_edges: str, a_starts: str, b_edges: str, b_starts: str) -> str:
    """Polygons share a point: one holds a vertex of the other, or edges touch.

    The cheap test that settles most parcels (parcel corner inside the scene) is first.
    """
    return (
        f"(exists({a_starts}, v -> {contains(b_edges, 'v.x', 'v.y')})"
        f" OR exists({a_edges}, f -> exists({b_edges}, g -> {segments_touch('f', 'g')}))"
        f" OR exists({b_starts}, v -> {contains(a_edges, 'v.x', 'v.y')}))"
    )


def centroid(rings: str) -> str:
    """Planar centroid as STRUCT<x, y>; NULL for zero area.

    Sums run over coordinates relative to the first vertex, which keeps small parcels far
    from the origin accurate. Holes must turn the other way than outer rings, as GeoJSON
    asks for.
    """
    ox, oy = (f"get(get({rings}, 0), 0).{axis}" for axis in "xy")
    cross = f"((e.x1 - {ox}) * (e.y2 - {oy}) - (e.x2 - {ox}) * (e.y1 - {oy}))"
    zero = "named_struct('area2', 0e0, 'mx', 0e0, 'my', 0e0)"
    add = (
        f"named_struct('area2', s.area2 + {cross}, "
        f"'mx', s.mx + (e.x1 + e.x2 - 2 * {ox}) * {cross}, "
        f"'my', s.my + (e.y1 + e.y2 - 2 * {oy}) * {cross})"
    )
    centre = (
        f"named_struct('x', s.mx / (s.area2 * 3) + {ox}, "
        f"'y', s.my / (s.area2 * 3) + {oy})"
    )
    return (
        f"aggregate({edges(rings)}, {zero}, (s, e) -> {add}, "
        f"s -> CASE WHEN s.area2 <> 0 THEN {centre} END)"
    )


def batch_key(rings: str, size_deg: float) -> Column:
    """Grid key of the centroid, latitude first, rounded half to even."""
    size = F.lit(float(size_deg))
    centre = F.expr(centroid(rings))
    lat, lon = ((F.rint(centre[axis] / size) * size).cast("string") for axis in "yx")
    return F.concat(lat, F.lit("_"), lon)
