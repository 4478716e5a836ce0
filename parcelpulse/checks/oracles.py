"""The registered queries as plain SQL over the raw test tables, for DuckDB.

Each statement starts with the same views as common table expressions; unused ones cost
nothing.
"""

from __future__ import annotations

from parcelpulse.schema import INDICES, SPECTRAL_BANDS, bands_for

ALL = list(INDICES)
START, END = "1995-01-01", "2001-12-31"

# Raw tables to parcels, vertices, edges, scenes, footprint edges and pixels.
TABLES = """
fx_parcel AS (
  SELECT s_suppkey AS parcel_key, CAST(s_suppkey AS VARCHAR) AS parcel_id,
         CASE WHEN s_suppkey % 2 = 0 THEN 'a.parquet' ELSE 'b.parquet' END AS source_file,
         CASE s_suppkey % 3 WHEN 0 THEN '1995-01-01_1997-06-30'
              WHEN 1 THEN '1997-07-01_2001-12-31'
              ELSE '1995-01-01_2001-12-31' END AS date_range,
         ((s_suppkey * 37) % 1400) * 10 - 5000 AS ox,
         ((s_suppkey * 53) % 900) * 10 + 42000 AS oy
  FROM supplier),
fx_vertex AS (
  SELECT p.parcel_key, v.seq, CAST(p.ox + v.dx AS DOUBLE) / 1000 AS lon,
         CAST(p.oy + v.dy AS DOUBLE) / 1000 AS lat
  FROM fx_parcel p
  CROSS JOIN (VALUES (0, 1, 2), (1, 49, 11), (2, 41, 48), (3, 21, 19), (4, 12, 41))
    AS v(seq, dx, dy)),
fx_edge AS (
  SELECT a.parcel_key, a.seq, a.lon AS x1, a.lat AS y1, b.lon AS x2, b.lat AS y2
  FROM fx_vertex a JOIN fx_vertex b
    ON a.parcel_key = b.parcel_key AND b.seq = (a.seq + 1) % 5),
fx_scene AS (
  SELECT o_orderkey AS item_id,
         CASE WHEN o_orderkey % 7 = 0 THEN 'l2a-old' ELSE 'l2a' END AS collection,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS utc_day,
         o_orderkey % 24 AS hour,
         CAST(date_trunc('month', o_orderdate) AS TIMESTAMP)
           + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS dt,
         CASE WHEN o_orderkey % 10 = 3 THEN NULL
              ELSE CAST((o_orderkey * 17) % 100 AS DOUBLE) END AS cloud_cover,
         CASE WHEN o_orderkey % 50 = 1 THEN NULL
              ELSE CAST((o_custkey % 3) * 5 - 6 AS DOUBLE) END AS lon0,
         CAST((o_custkey % 2) * 5 + 41 AS DOUBLE) AS lat0,
         CAST(0.0001 AS DOUBLE) AS scale,
         CASE WHEN o_orderkey % 5 <> 2 AND o_orderkey % 3 = 0
              THEN CAST(-0.1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS shift
  FROM orders),
valid_scene AS (
  SELECT *, utc_day + CAST(floor((hour + lon0 / 15) / 24) AS INTEGER) AS solar_day
  FROM fx_scene WHERE lon0 IS NOT NULL),
fx_foot_edge AS (
  SELECT f.lon0, f.lat0, v.seq, f.lon0 + v.dx AS x1, f.lat0 + v.dy AS y1,
         f.lon0 + v.dx2 AS x2, f.lat0 + v.dy2 AS y2
  FROM (SELECT DISTINCT lon0, lat0 FROM valid_scene) f
  CROSS JOIN (VALUES (0, 0.0e0, 0.0e0, 5.5e0, 0.3e0), (1, 5.5e0, 0.3e0, 5.2e0, 5.5e0),
                     (2, 5.2e0, 5.5e0, -0.3e0, 5.2e0), (3, -0.3e0, 5.2e0, 0.0e0, 0.0e0))
    AS v(seq, dx, dy, dx2, dy2)),
fx_pixel AS (
  SELECT parcel_key, item_id, y, x, h AS px_seq,
         CASE WHEN h % 41 = 0 THEN 0 ELSE (h * 7) % 3000 + 1 END AS red,
         (h * 11) % 3500 + 1 AS green, (h * 5) % 2500 + 1 AS blue,
         (h * 19) % 6000 + 1 AS nir, (h * 29) % 5000 + 1 AS swir16,
         (h * 13) % 4000 + 1 AS rededge1, (h * 17) % 4500 + 1 AS rededge2,
         (h * 23) % 5500 + 1 AS rededge3,
         CASE WHEN h % 20 < 12 THEN h % 20 WHEN h % 20 < 17 THEN 4 ELSE 5 END AS scl
  FROM (SELECT l_suppkey AS parcel_key, l_orderkey AS item_id,
               l_linenumber % 5 + (l_suppkey * 53) % 900 + 4200 AS y,
               l_partkey % 5 + (l_suppkey * 37) % 1400 - 500 AS x,
               l_orderkey * 31 + l_partkey * 7 + l_linenumber * 11 AS h
        FROM lineitem) t),
fx_box AS (
  SELECT parcel_key, min(lon) AS minx, min(lat) AS miny, max(lon) AS maxx, max(lat) AS maxy
  FROM fx_vertex GROUP BY parcel_key),
fx_centre AS (
  SELECT e.parcel_key,
         sum((e.x1 + e.x2 - 2 * o.lon) * c) / (3 * sum(c)) + any_value(o.lon) AS cx,
         sum((e.y1 + e.y2 - 2 * o.lat) * c) / (3 * sum(c)) + any_value(o.lat) AS cy
  FROM (SELECT e.*, (e.x1 - o.lon) * (e.y2 - o.lat) - (e.x2 - o.lon) * (e.y1 - o.lat) AS c
        FROM fx_edge e JOIN fx_vertex o ON o.parcel_key = e.parcel_key AND o.seq = 0) e
  JOIN fx_vertex o ON o.parcel_key = e.parcel_key AND o.seq = 0
  GROUP BY e.parcel_key),
fx_batch AS (
  SELECT p.*, b.minx, b.miny, b.maxx, b.maxy,
         concat(CAST(round_even(c.cy / 2, 0) * 2 AS VARCHAR), '_',
                CAST(round_even(c.cx / 2, 0) * 2 AS VARCHAR)) AS batch_id
  FROM fx_parcel p JOIN fx_centre c USING (parcel_key) JOIN fx_box b USING (parcel_key)),
batch_box AS (
  SELECT source_file, date_range, batch_id, min(minx) AS minx, min(miny) AS miny,
         max(maxx) AS maxx, max(maxy) AS maxy, count(*) AS n_parcels
  FROM fx_batch GROUP BY source_file, date_range, batch_id),
batch_zone AS (
  SELECT *, 32600 + CAST(floor(((minx + maxx) / 2 + 180) / 6) AS BIGINT) + 1 AS epsg
  FROM batch_box),
foot_box AS (
  SELECT lon0, lat0, min(x1) AS minx, min(y1) AS miny, max(x1) AS maxx, max(y1) AS maxy
  FROM fx_foot_edge GROUP BY lon0, lat0)
"""

# Polygon tests: which parcels touch which footprint, and which cells a parcel holds.
GEOMETRY = """
edge_touch AS (
  SELECT DISTINCT p.parcel_key, f.lon0, f.lat0
  FROM fx_edge p JOIN fx_foot_edge f
    ON least(p.x1, p.x2) <= greatest(f.x1, f.x2) AND least(f.x1, f.x2) <= greatest(p.x1, p.x2)
   AND least(p.y1, p.y2) <= greatest(f.y1, f.y2) AND least(f.y1, f.y2) <= greatest(p.y1, p.y2)
   AND ((p.x2 - p.x1) * (f.y1 - p.y1) - (p.y2 - p.y1) * (f.x1 - p.x1))
     * ((p.x2 - p.x1) * (f.y2 - p.y1) - (p.y2 - p.y1) * (f.x2 - p.x1)) <= 0
   AND ((f.x2 - f.x1) * (p.y1 - f.y1) - (f.y2 - f.y1) * (p.x1 - f.x1))
     * ((f.x2 - f.x1) * (p.y2 - f.y1) - (f.y2 - f.y1) * (p.x2 - f.x1)) <= 0),
parcel_in_foot AS (
  SELECT p.parcel_key, f.lon0, f.lat0
  FROM (SELECT * FROM fx_vertex WHERE seq = 0) p JOIN fx_foot_edge f
    ON (f.y1 > p.lat) <> (f.y2 > p.lat)
   AND p.lon < (f.x2 - f.x1) * (p.lat - f.y1) / (f.y2 - f.y1) + f.x1
  GROUP BY p.parcel_key, f.lon0, f.lat0 HAVING count(*) % 2 = 1),
foot_in_parcel AS (
  SELECT p.parcel_key, f.lon0, f.lat0
  FROM (SELECT * FROM fx_foot_edge WHERE seq = 0) f JOIN fx_edge p
    ON (p.y1 > f.y1) <> (p.y2 > f.y1)
   AND f.x1 < (p.x2 - p.x1) * (f.y1 - p.y1) / (p.y2 - p.y1) + p.x1
  GROUP BY p.parcel_key, f.lon0, f.lat0 HAVING count(*) % 2 = 1),
touch AS (
  SELECT * FROM edge_touch UNION SELECT * FROM parcel_in_foot
  UNION SELECT * FROM foot_in_parcel),
box_cell AS (
  SELECT p.parcel_key, p.oy // 10 + r.i AS y, p.ox // 10 + c.i AS x,
         CAST(p.oy + 10 * r.i + 5 AS DOUBLE) / 1000 AS py,
         CAST(p.ox + 10 * c.i + 5 AS DOUBLE) / 1000 AS px
  FROM fx_parcel p CROSS JOIN range(5) r(i) CROSS JOIN range(5) c(i)),
inside AS (
  SELECT c.parcel_key, c.y, c.x
  FROM box_cell c JOIN fx_edge e
    ON e.parcel_key = c.parcel_key AND (e.y1 > c.py) <> (e.y2 > c.py)
   AND c.px < (e.x2 - e.x1) * (c.py - e.y1) / (e.y2 - e.y1) + e.x1
  GROUP BY c.parcel_key, c.y, c.x HAVING count(*) % 2 = 1)
"""

COARSE = """
coarse_class AS (
  SELECT parcel_key, item_id, CAST(floor(y / 2) AS BIGINT) AS y,
         CAST(floor(x / 2) AS BIGINT) AS x, arg_min(scl, ROW(y, x, px_seq)) AS scl
  FROM fx_pixel GROUP BY 1, 2, 3, 4)
"""


def found(start=START, end=END, cloud=80) -> str:
    return f"""
found AS (
  SELECT * FROM valid_scene
  WHERE collection = 'l2a' AND cloud_cover < {cloud}
    AND dt >= TIMESTAMP '{start} 00:00:00' AND dt < TIMESTAMP '{end} 00:00:00' + INTERVAL 1 DAY),
pairs AS (
  SELECT t.parcel_key, f.* FROM touch t JOIN found f USING (lon0, lat0))
"""


# The same with each parcel's own dates.
FOUND_BY_FOLDER = """
found AS (
  SELECT * FROM valid_scene WHERE collection = 'l2a' AND cloud_cover < 80),
pairs AS (
  SELECT t.parcel_key, f.*
  FROM touch t JOIN found f USING (lon0, lat0) JOIN fx_parcel p USING (parcel_key)
  WHERE f.utc_day BETWEEN CAST(split_part(p.date_range, '_', 1) AS DATE)
                      AND CAST(split_part(p.date_range, '_', 2) AS DATE))
"""


# The pixels with every third parcel under clouds.
CLOUDY = """
cloudy AS (
  SELECT * REPLACE (CASE WHEN parcel_key % 3 = 1 AND scl IN (4, 5) THEN 8 ELSE scl END AS scl)
  FROM fx_pixel)
"""


def first_valid(band: str, order="ROW(dt, item_id, px_seq)") -> str:
    return f"coalesce(arg_min({band}, {order}) FILTER (WHERE {band} <> 0), 0)"


SHARE = (
    "CASE WHEN scl <> 0 THEN CASE WHEN scl IN (4, 5) THEN 1e0 ELSE 0e0 END END"
)
INSIDE_BY_KEY = "JOIN inside c USING (parcel_key, y, x)"


def index_sql(name: str) -> str:
    index = INDICES[name]
    a, b = (f"CAST({c} AS DOUBLE)" for c in index.bands)
    if index.soil:
        return f"({a} - {b}) / ({a} + {b} + {index.soil}e0) * {1 + index.soil}e0"
    return f"({a} - {b}) / ({a} + {b})"


def clear_pass(pixel_from: str | None = None) -> str:
    """Class mosaic, ratios, usable days."""
    source = pixel_from or f"fx_pixel q JOIN pairs USING (parcel_key, item_id) {INSIDE_BY_KEY}"
    return f"""
class_mosaic AS (
  SELECT parcel_key, solar_day, y, x, {first_valid('scl')} AS scl
  FROM {source} GROUP BY parcel_key, solar_day, y, x),
ratio AS (
  SELECT parcel_key, solar_day, avg({SHARE}) AS clear_ratio
  FROM class_mosaic GROUP BY parcel_key, solar_day),
usable AS (SELECT * FROM ratio WHERE clear_ratio > 0.5)
"""


# Coarse class cells of half the grid whose centre lies in the parcel.
COARSE_CLEAR = """
coarse_cell AS (
  SELECT DISTINCT parcel_key, r.i + CAST(floor(oy / 20) AS BIGINT) AS y,
         c.i + CAST(floor(ox / 20e0) AS BIGINT) AS x
  FROM fx_parcel CROSS JOIN range(4) r(i) CROSS JOIN range(4) c(i)),
inside_coarse AS (
  SELECT c.parcel_key, c.y, c.x
  FROM (SELECT *, (y * 20 + 10) / 1000e0 AS py, (x * 20 + 10) / 1000e0 AS px
        FROM coarse_cell) c
  JOIN fx_edge e
    ON e.parcel_key = c.parcel_key AND (e.y1 > c.py) <> (e.y2 > c.py)
   AND c.px < (e.x2 - e.x1) * (c.py - e.y1) / (e.y2 - e.y1) + e.x1
  GROUP BY c.parcel_key, c.y, c.x HAVING count(*) % 2 = 1)
"""


CLOUDY_CLEAR = f"cloudy q JOIN pairs USING (parcel_key, item_id) {INSIDE_BY_KEY}"


def spectral_pass(
    bands, *, rejected=False, per_item=False, shared=False, coarse=False, warped=False,
    pixel="fx_pixel",
) -> str:
    """Days kept, their scale and time, and the scaled mosaic on them."""
    keep = (
        "parcel_key NOT IN (SELECT parcel_key FROM usable)"
        if rejected
        else "(parcel_key, solar_day) IN (SELECT (parcel_key, solar_day) FROM usable)"
    )
    if per_item:
        def value(b):
            return (
                f"coalesce(arg_min({b} * scale + shift, ROW(dt, item_id, px_seq))"
                f" FILTER (WHERE {b} <> 0), arg_min(shift, ROW(dt, item_id, px_seq)))"
            )
    else:
        def value(b):
            return f"{first_valid(b)} * any_value(first_scale) + any_value(first_shift)"

    if coarse:
        raw = ", ".join(f"f.{b}" for b in bands)
        pixel = f"""(SELECT f.parcel_key, f.item_id, f.y, f.x, f.px_seq, {raw}, k.scl
           FROM fx_pixel f LEFT JOIN coarse_class k
             ON k.parcel_key = f.parcel_key AND k.item_id = f.item_id
            AND k.y = floor(f.y / 2) AND k.x = floor(f.x / 2))"""
    if warped:
        source = """upixel q JOIN gather g USING (epsg, sy, sx)
          JOIN kept USING (parcel_key, item_id)"""
    elif shared:
        source = f"""(SELECT * EXCLUDE (parcel_key) FROM {pixel}) q
          JOIN inside USING (y, x) JOIN kept USING (parcel_key, item_id)"""
    else:
        source = f"{pixel} q JOIN kept USING (parcel_key, item_id) {INSIDE_BY_KEY}"
    mosaic = ", ".join(f"{value(b)} AS {b}" for b in bands)
    return f"""
kept_pairs AS (SELECT * FROM pairs WHERE {keep}),
first_scale AS (
  SELECT parcel_key, arg_min(scale, ROW(dt, item_id)) AS first_scale,
         arg_min(shift, ROW(dt, item_id)) AS first_shift
  FROM kept_pairs GROUP BY parcel_key),
kept AS (SELECT * FROM kept_pairs JOIN first_scale USING (parcel_key)),
day_time AS (
  SELECT parcel_key, solar_day, min(dt) AS dt FROM kept_pairs GROUP BY parcel_key, solar_day),
cube AS (
  SELECT parcel_key, solar_day, y, x, {mosaic}, {first_valid('scl')} AS scl
  FROM {source} GROUP BY parcel_key, solar_day, y, x)
"""


def means(bands, indices) -> str:
    masked = ", ".join(f"CASE WHEN scl IN (4, 5) THEN {b} END AS {b}" for b in bands)
    index = ", ".join(f"{index_sql(n)} AS {n}" for n in indices)
    averages = ", ".join(f"avg({c}) AS {c}" for c in [*bands, *indices])
    return f"""
masked AS (SELECT parcel_key, solar_day, y, x, {masked} FROM cube),
indexed AS (SELECT *, {index} FROM masked),
series AS (
  SELECT * FROM (SELECT parcel_key, solar_day, {averages} FROM indexed
                 GROUP BY parcel_key, solar_day)
  WHERE coalesce({', '.join(indices)}) IS NOT NULL),
stamped AS (
  SELECT * FROM series JOIN day_time USING (parcel_key, solar_day)
  JOIN fx_parcel USING (parcel_key))
"""


def statement(ctes, final: str) -> str:
    return "WITH " + ",".join([TABLES, GEOMETRY, *ctes]) + final


def r9(columns) -> str:
    return ", ".join(f"round({c}, 9) + 0e0 AS {c}" for c in columns)


TIME = "strftime(dt, '%Y-%m-%d %H:%M:%S') AS time"
DAY = "CAST(solar_day AS VARCHAR) AS solar_day"
FROM_WHERE = "parcel_id, source_file, date_range"
SHARED_CLEAR = """(SELECT * EXCLUDE (parcel_key) FROM fx_pixel) q
  JOIN inside USING (y, x) JOIN pairs USING (parcel_key, item_id)"""
COARSE_CLEAR_FROM = """(SELECT *, 0 AS px_seq FROM coarse_class) q
  JOIN pairs USING (parcel_key, item_id) JOIN inside_coarse USING (parcel_key, y, x)"""


def series_statement(indices=ALL, search=None, final=None, clear=None, extra=(), **passes):
    bands = bands_for(indices)
    ctes = [
        search or found(),
        *extra,
        clear_pass(clear),
        spectral_pass(bands, **passes),
        means(bands, indices),
    ]
    shown = f"SELECT {TIME}, {r9([*bands, *indices])}, {FROM_WHERE} FROM stamped"
    return statement(ctes, final or shown)


def rejected_statement(final):
    ctes = [
        found(),
        CLOUDY,
        clear_pass(CLOUDY_CLEAR),
        spectral_pass(["red", "nir"], rejected=True, pixel="cloudy"),
    ]
    stamped = """,
rejected AS (
  SELECT * FROM cube JOIN day_time USING (parcel_key, solar_day)
  JOIN fx_parcel USING (parcel_key))
"""
    return statement(ctes, stamped + final)


def ratio_statement(final):
    source = "fx_pixel q JOIN found USING (item_id) " + INSIDE_BY_KEY
    return statement([found(), clear_pass(source)], final)


def utm_sql() -> str:
    """Vertices in the UTM zone of their batch; the series is written out term by term."""
    f = 1 / 298.257223563
    n = f / (2 - f)
    k = 0.9996 * 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    ecc = 2 * n**0.5 / (1 + n)
    a1 = n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16
    a2 = 13 * n**2 / 48 - 3 * n**3 / 5
    a3 = 61 * n**3 / 240
    return f""",
placed AS (
  SELECT v.parcel_key, v.seq, z.epsg, sin(radians(v.lat)) AS s,
         radians(v.lon - (z.epsg % 100 * 6 - 183)) AS d
  FROM fx_vertex v JOIN fx_batch b USING (parcel_key)
  JOIN batch_zone z USING (source_file, date_range, batch_id)),
conformal AS (
  SELECT *, sinh(atanh(s) - CAST({ecc!r} AS DOUBLE) * atanh(CAST({ecc!r} AS DOUBLE) * s)) AS t
  FROM placed),
gauss AS (
  SELECT *, atan2(t, cos(d)) AS xi, atanh(sin(d) / sqrt(1 + t * t)) AS eta FROM conformal)
SELECT parcel_key, epsg, CAST(seq AS BIGINT) AS seq,
       round(500000e0 + CAST({k!r} AS DOUBLE) * (eta
         + CAST({a1!r} AS DOUBLE) * cos(2 * xi) * sinh(2 * eta)
         + CAST({a2!r} AS DOUBLE) * cos(4 * xi) * sinh(4 * eta)
         + CAST({a3!r} AS DOUBLE) * cos(6 * xi) * sinh(6 * eta)), 4) AS easting,
       round(CAST({k!r} AS DOUBLE) * (xi
         + CAST({a1!r} AS DOUBLE) * sin(2 * xi) * cosh(2 * eta)
         + CAST({a2!r} AS DOUBLE) * sin(4 * xi) * cosh(4 * eta)
         + CAST({a3!r} AS DOUBLE) * sin(6 * xi) * cosh(6 * eta)), 4) AS northing
FROM gauss"""


def to_utm(source: str, zone: str) -> str:
    """The rows of a table with lon and lat, with east and north in the zone."""
    f = 1 / 298.257223563
    n = f / (2 - f)
    k = 0.9996 * 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    ecc = 2 * n**0.5 / (1 + n)
    a = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    east = " + ".join(f"{c!r}::DOUBLE * cos({2 * j} * u) * sinh({2 * j} * v)" for j, c in enumerate(a, 1))
    north = " + ".join(f"{c!r}::DOUBLE * sin({2 * j} * u) * cosh({2 * j} * v)" for j, c in enumerate(a, 1))
    return f"""(SELECT * EXCLUDE (s, d, t, u, v), 500000e0 + {k!r}::DOUBLE * (v + {east}) AS east,
         {k!r}::DOUBLE * (u + {north}) AS north
  FROM (SELECT *, atan2(t, cos(d)) AS u, atanh(sin(d) / sqrt(1 + t * t)) AS v
        FROM (SELECT *, sinh(atanh(s) - {ecc!r}::DOUBLE * atanh({ecc!r}::DOUBLE * s)) AS t
              FROM (SELECT *, sin(radians(lat)) AS s, radians(lon - ({zone} % 100 * 6 - 183)) AS d
                    FROM {source}))))"""


def from_utm(source: str, zone: str) -> str:
    """The rows of a table with e and n in the zone, with lon and lat; north of the equator."""
    f = 1 / 298.257223563
    n = f / (2 - f)
    k = 0.9996 * 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    b = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    d = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    up = " - ".join(["u", *(f"{c!r}::DOUBLE * sin({2 * j} * u) * cosh({2 * j} * v)" for j, c in enumerate(b, 1))])
    on = " - ".join(["v", *(f"{c!r}::DOUBLE * cos({2 * j} * u) * sinh({2 * j} * v)" for j, c in enumerate(b, 1))])
    lat = " + ".join(["chi", *(f"{c!r}::DOUBLE * sin({2 * j} * chi)" for j, c in enumerate(d, 1))])
    return f"""(SELECT * EXCLUDE (u, v, p, q, chi), degrees({lat}) AS lat,
         {zone} % 100 * 6 - 183 + degrees(atan2(sinh(q), cos(p))) AS lon
  FROM (SELECT *, asin(sin(p) / cosh(q)) AS chi
        FROM (SELECT *, {up} AS p, {on} AS q
              FROM (SELECT *, n / {k!r}::DOUBLE AS u, (e - 500000e0) / {k!r}::DOUBLE AS v
                    FROM {source}))))"""


PIXEL_PLACES = """(SELECT * EXCLUDE (parcel_key, y, x), (x * 10 + 5) / 1000e0 AS lon,
                 (y * 10 + 5) / 1000e0 AS lat FROM fx_pixel JOIN item_zone USING (item_id))"""
VERTEX_PLACES = """(SELECT v.parcel_key, v.seq, v.lon, v.lat, z.epsg AS own
                  FROM fx_vertex v JOIN fx_batch USING (parcel_key)
                  JOIN batch_zone z USING (source_file, date_range, batch_id))"""
CELL_PLACES = f"(SELECT * FROM {from_utm('uinside', 'own')} JOIN parcel_zone USING (parcel_key))"

# Samples by zone, the cells of each parcel in its batch's zone, and where each of these is stored.
WARPED = f"""
item_zone AS (
  SELECT item_id, CASE lon0 WHEN -6 THEN 32630 WHEN -1 THEN 32630 + item_id % 2
                  ELSE 32631 + item_id % 2 END AS epsg FROM valid_scene),
upixel AS (
  SELECT *, CAST(floor(north / 1000) AS BIGINT) AS sy, CAST(floor(east / 1000) AS BIGINT) AS sx
  FROM {to_utm(PIXEL_PLACES, "epsg")}),
uvertex AS (SELECT * FROM {to_utm(VERTEX_PLACES, "own")}),
uedge AS (
  SELECT a.parcel_key, a.own, a.east AS x1, a.north AS y1, b.east AS x2, b.north AS y2
  FROM uvertex a JOIN uvertex b ON a.parcel_key = b.parcel_key AND b.seq = (a.seq + 1) % 5),
urow AS (
  SELECT parcel_key, own, low, high, unnest(range(bottom, top + 1)) AS y
  FROM (SELECT parcel_key, own, CAST(floor(min(x1) / 1000) AS BIGINT) AS low,
               CAST(floor(max(x1) / 1000) AS BIGINT) AS high,
               CAST(floor(min(y1) / 1000) AS BIGINT) AS bottom,
               CAST(floor(max(y1) / 1000) AS BIGINT) AS top
        FROM uedge GROUP BY parcel_key, own)),
ucell AS (
  SELECT parcel_key, own, y, x, x * 1000e0 + 500 AS e, y * 1000e0 + 500 AS n
  FROM (SELECT parcel_key, own, y, unnest(range(low, high + 1)) AS x FROM urow)),
uinside AS (
  SELECT c.parcel_key, c.own, c.y, c.x, c.e, c.n
  FROM ucell c JOIN uedge e
    ON e.parcel_key = c.parcel_key AND (e.y1 > c.n) <> (e.y2 > c.n)
   AND c.e < (e.x2 - e.x1) * (c.n - e.y1) / (e.y2 - e.y1) + e.x1
  GROUP BY ALL HAVING count(*) % 2 = 1),
parcel_zone AS (
  SELECT DISTINCT parcel_key, epsg FROM pairs JOIN item_zone USING (item_id)),
gather AS (
  SELECT parcel_key, epsg, y, x,
         CASE WHEN epsg = own THEN y ELSE CAST(floor(north / 1000) AS BIGINT) END AS sy,
         CASE WHEN epsg = own THEN x ELSE CAST(floor(east / 1000) AS BIGINT) END AS sx
  FROM {to_utm(CELL_PLACES, "epsg")})
"""
WARPED_CLEAR = """upixel q JOIN gather g USING (epsg, sy, sx)
  JOIN pairs USING (parcel_key, item_id)"""

# The first fault of a damaged parcel.
FAULT = """CASE parcel_key % 11 WHEN 1 THEN 'no polygon'
  WHEN 3 THEN 'a ring of fewer than three vertices' WHEN 4 THEN 'a vertex without a position'
  WHEN 5 THEN 'a vertex outside longitude and latitude' WHEN 6 THEN 'a polygon without area'
  WHEN 8 THEN 'no dates' WHEN 9 THEN 'dates that end before they start' END"""

BANDS = ", ".join(SPECTRAL_BANDS)
SCALED = ", ".join(f"round({b} * scale + shift, 9) + 0e0 AS {b}" for b in SPECTRAL_BANDS)
MASKED = ", ".join(
    f"CASE WHEN scl IN (4, 5) THEN CAST({b} AS DOUBLE) END AS {b}" for b in SPECTRAL_BANDS
)
SAMPLE = "parcel_key, item_id, y, x, px_seq"
SUITABLE = [n for n in ALL if not {"swir16", "rededge3"} & set(INDICES[n].bands)]
FOLDER = """CASE s_suppkey % 6 WHEN 0 THEN '1996-01-01_1996-12-31'
  WHEN 1 THEN '1997-01-01_1998-12-31' WHEN 5 THEN '1999-01-01_1999-06-30' END"""
RANGED = """,
ranged AS (
  SELECT l_suppkey AS parcel_key, CAST(min(l_shipdate) AS DATE) AS start_day,
         CAST(max(l_shipdate) AS DATE) AS end_day
  FROM lineitem GROUP BY l_suppkey)
"""


def masked_item_means(columns) -> str:
    index = ", ".join(f"{index_sql(n)} AS {n}" for n in ALL)
    averages = ", ".join(f"round(avg({c}), 9) + 0e0 AS {c}" for c in columns)
    return f"""
SELECT parcel_key, item_id, {averages}
FROM (SELECT parcel_key, item_id, {BANDS}, {index}
      FROM (SELECT parcel_key, item_id, {MASKED} FROM fx_pixel))
GROUP BY parcel_key, item_id"""


def one_index(name: str) -> str:
    bands = ", ".join(f"{b} * scale + shift AS {b}" for b in INDICES[name].bands)
    return statement(
        [],
        f"SELECT {SAMPLE}, round({index_sql(name)}, 9) + 0e0 AS {name} FROM"
        f" (SELECT {SAMPLE}, {bands} FROM fx_pixel JOIN fx_scene USING (item_id))",
    )


def kept_items(match: str, key: str) -> str:
    return statement(
        [found(), clear_pass()],
        f""",
first_day AS (
  SELECT parcel_key, solar_day, CAST(min(dt) AS DATE) AS utc_day
  FROM pairs GROUP BY parcel_key, solar_day),
good AS (SELECT DISTINCT parcel_key, {key} FROM first_day
         WHERE (parcel_key, solar_day) IN (SELECT (parcel_key, solar_day) FROM usable))
SELECT parcel_key, CAST({match} AS VARCHAR) AS {key}, count(*) AS n_items
FROM pairs JOIN good USING (parcel_key, {key}) GROUP BY ALL""",
    )


ORACLES = {
    "parcel_time_series": series_statement(),
    "run_folders": series_statement(
        ["NDVI", "NDBI"], search=FOUND_BY_FOLDER, clear=SHARED_CLEAR, shared=True
    ),
    "rejected_ndvi": rejected_statement(
        f"""SELECT {FROM_WHERE}, parcel_key, strftime(dt, '%Y-%m-%d') AS day, y, x, scl,
       round({index_sql('NDVI')}, 9) + 0e0 AS NDVI, n_dates
FROM rejected JOIN (SELECT parcel_key, count(DISTINCT dt) AS n_dates
                    FROM rejected GROUP BY parcel_key) USING (parcel_key)"""
    ),
    "time_series_per_item_scale": series_statement(["NDVI"], per_item=True),
    "time_series_shared_grid": series_statement(["NDVI"], clear=SHARED_CLEAR, shared=True),
    "time_series_coarse_class": series_statement(
        ["NDVI"], extra=(COARSE, COARSE_CLEAR), clear=COARSE_CLEAR_FROM, coarse=True
    ),
    "time_series_zone_border": series_statement(
        ["NDVI"], extra=(WARPED,), clear=WARPED_CLEAR, warped=True
    ),
    "run_failures": series_statement(
        ["NDVI"],
        extra=(CLOUDY,),
        clear=CLOUDY_CLEAR,
        pixel="cloudy",
        final=f""",
reasons AS (
  SELECT p.*, coalesce({FAULT},
    CASE WHEN parcel_key % 5 = 2 OR parcel_key NOT IN (SELECT parcel_key FROM pairs)
         THEN 'no scene covers the parcel'
         WHEN parcel_key NOT IN (SELECT parcel_key FROM usable) THEN 'no day is clear enough'
         WHEN parcel_key NOT IN (SELECT parcel_key FROM stamped) THEN 'no index has a value' END) AS reason
  FROM fx_parcel p)
SELECT r.parcel_key, r.reason, CASE WHEN reason IS NULL THEN n END AS n_points,
       {", ".join(f"CASE WHEN reason IS NOT NULL THEN {c} END AS {c}" for c in FROM_WHERE.split(", "))}
FROM reasons r LEFT JOIN (SELECT parcel_key, count(*) AS n FROM stamped GROUP BY parcel_key) USING (parcel_key)""",
    ),
    "scan_parcels_any_id": statement([], f"SELECT {FROM_WHERE} FROM fx_parcel"),
    "scan_date_folders": statement(
        [],
        f"""SELECT parcel_id, source_file, folder AS date_range,
       split_part(folder, '_', 1) AS start_day, split_part(folder, '_', 2) AS end_day
FROM (SELECT p.*, {FOLDER} AS folder FROM fx_parcel p JOIN supplier ON s_suppkey = parcel_key)
WHERE folder IS NOT NULL""",
    ),
    "scan_parcels": statement(
        [],
        f"""SELECT parcel_id, source_file, folder AS date_range, CAST(4326 AS BIGINT) AS epsg,
       CAST(5 AS BIGINT) AS n_vertices, {r9(['minx', 'miny', 'maxx', 'maxy'])}
FROM (SELECT p.*, {FOLDER} AS folder FROM fx_parcel p JOIN supplier ON s_suppkey = parcel_key)
JOIN fx_box USING (parcel_key) WHERE folder IS NOT NULL""",
    ),
    "scan_scenes": statement(
        [],
        """SELECT CAST(item_id AS VARCHAR) AS item_id, collection,
       strftime(dt, '%Y-%m-%d %H:%M:%S') AS acquired, round(minx, 6) AS minx,
       round(maxy, 6) AS maxy, cloud_cover, scale, shift AS "offset"
FROM fx_scene LEFT JOIN foot_box USING (lon0, lat0)""",
    ),
    "scan_pixels": statement(
        [],
        f"""SELECT {SAMPLE}, red, green, blue, nir, swir16, scl,
       CAST(utc_day AS VARCHAR) AS acq_day FROM fx_pixel JOIN fx_scene USING (item_id)""",
    ),
    "write_time_series": series_statement(),
    "write_pixel_cube": series_statement(
        ["NDVI", "NBR"],
        final=f"""SELECT {TIME}, parcel_key, y, x,
       {r9([*bands_for(['NDVI', 'NBR']), 'NDVI', 'NBR'])}, {FROM_WHERE}
FROM indexed JOIN day_time USING (parcel_key, solar_day) JOIN fx_parcel USING (parcel_key)""",
    ),
    "write_rejected_cube": rejected_statement(
        f"SELECT {TIME}, parcel_key, y, x, {r9(['red', 'nir'])}, scl, {FROM_WHERE} FROM rejected"
    ),
    "scan_time_series": series_statement(
        ["NDVI", "NDWI"],
        final="""SELECT parcel_id, count(*) AS n_points, round(min(NDVI), 9) + 0e0 AS min_ndvi,
       round(max(NDWI), 9) + 0e0 AS max_ndwi FROM stamped GROUP BY parcel_id""",
    ),
    "scan_cube": rejected_statement(
        """SELECT date_range, parcel_id, count(DISTINCT dt) AS n_dates, count(*) AS n_cells
FROM rejected GROUP BY date_range, parcel_id"""
    ),
    "filter_collection": statement(
        [], "SELECT item_id, collection FROM fx_scene WHERE collection = 'l2a'"
    ),
    "filter_bbox": statement(
        [],
        """SELECT b.source_file, b.date_range, b.batch_id, s.item_id
FROM batch_box b JOIN foot_box f
  ON f.minx <= b.maxx AND f.maxx >= b.minx AND f.miny <= b.maxy AND f.maxy >= b.miny
JOIN valid_scene s ON s.lon0 = f.lon0 AND s.lat0 = f.lat0""",
    ),
    "filter_date_range": statement(
        [],
        f"""SELECT item_id, strftime(dt, '%Y-%m-%d %H:%M:%S') AS acquired FROM fx_scene
WHERE utc_day BETWEEN DATE '{START}' AND DATE '{END}'""",
    ),
    "filter_cloud_cover": statement(
        [], "SELECT item_id, cloud_cover FROM fx_scene WHERE cloud_cover < 80"
    ),
    "filter_valid_items": statement(
        [],
        """SELECT item_id, strftime(dt, '%Y-%m-%d %H:%M:%S') AS acquired
FROM fx_scene WHERE lon0 IS NOT NULL""",
    ),
    "mask_clear": statement([], f"SELECT {SAMPLE}, {MASKED} FROM fx_pixel"),
    "mask_nodata": statement(
        [],
        f"""SELECT parcel_key, y, x, count({SHARE}) AS n_valid,
       CAST(sum({SHARE}) AS BIGINT) AS n_clear FROM fx_pixel GROUP BY parcel_key, y, x""",
    ),
    "drop_all_null": statement(
        [],
        f"""SELECT * FROM ({masked_item_means(['NDVI', 'NBR'])})
WHERE NDVI IS NOT NULL OR NBR IS NOT NULL""",
    ),
    "scale_bands": statement(
        [], f"SELECT {SAMPLE}, {SCALED}, scl FROM fx_pixel JOIN fx_scene USING (item_id)"
    ),
    "bands_for_indices": statement(
        [],
        f"SELECT {SAMPLE}, red, green, blue, nir, swir16, rededge2, scl FROM fx_pixel",
    ),
    "stamp_provenance": statement(
        [],
        f"""SELECT parcel_key, n, {FROM_WHERE}
FROM (SELECT parcel_key, count(*) AS n FROM fx_pixel GROUP BY parcel_key)
JOIN fx_parcel USING (parcel_key)""",
    ),
    "project_indices": statement(
        [],
        "SELECT " + SAMPLE + ", "
        + ", ".join(f"round({index_sql(n)}, 9) + 0e0 AS {n}" for n in SUITABLE)
        + " FROM fx_pixel",
    ),
    "assemble_cube": statement(
        [],
        f"SELECT {SAMPLE}, red, green, blue, nir, rededge1, "
        + ", ".join(f"round({index_sql(n)}, 9) + 0e0 AS {n}" for n in ("SAVI", "NDRE1"))
        + " FROM fx_pixel",
    ),
    "project_series": series_statement(
        ["NDVI"], final=f"SELECT parcel_id, {TIME}, round(NDVI, 9) + 0e0 AS NDVI FROM stamped"
    ),
    "split_date_range": statement(
        [],
        RANGED
        + """SELECT parcel_key, i AS chunk_idx,
       CAST(start_day + CAST(i * 366 AS INTEGER) AS VARCHAR) AS chunk_start,
       CAST(least(start_day + CAST(i * 366 + 365 AS INTEGER), end_day) AS VARCHAR) AS chunk_end
FROM ranged, unnest(range(CAST((end_day - start_day) // 366 + 1 AS BIGINT))) u(i)""",
    ),
    "batch_key": statement(
        [],
        """SELECT parcel_key,
       concat(CAST(round_even(cy / 0.5e0, 0) * 0.5e0 AS VARCHAR), '_',
              CAST(round_even(cx / 0.5e0, 0) * 0.5e0 AS VARCHAR)) AS half_degree,
       concat(CAST(round_even(cy / 2e0, 0) * 2e0 AS VARCHAR), '_',
              CAST(round_even(cx / 2e0, 0) * 2e0 AS VARCHAR)) AS two_degrees
FROM fx_centre""",
    ),
    "ring_centroid": statement(
        [], "SELECT parcel_key, round(cx, 9) + 0e0 AS cx, round(cy, 9) + 0e0 AS cy FROM fx_centre"
    ),
    "ring_bounds": statement([], "SELECT parcel_key, minx, miny, maxx, maxy FROM fx_box"),
    "utm_zone": statement([], "SELECT source_file, date_range, batch_id, epsg FROM batch_zone"),
    "project_utm": statement([], utm_sql()),
    "utc_day": statement([], "SELECT item_id, CAST(utc_day AS VARCHAR) AS day FROM fx_scene"),
    "solar_day": statement([], f"SELECT item_id, {DAY} FROM valid_scene"),
    "item_scale": """
SELECT item_id, coalesce(CAST(json_extract(assets, '$.red."raster:bands"[0].scale') AS DOUBLE),
                         0.0001e0) AS scale,
       coalesce(CAST(json_extract(assets, '$.red."raster:bands"[0].offset') AS DOUBLE),
                0e0) AS "offset"
FROM (SELECT o_orderkey AS item_id,
             CASE WHEN o_orderkey % 5 = 2 THEN '{"red":{"raster:bands":[{}]}}'
                  WHEN o_orderkey % 3 = 0
                  THEN '{"red":{"raster:bands":[{"scale":0.0001,"offset":-0.1}]}}'
                  ELSE '{"red":{"raster:bands":[{"scale":0.0001,"offset":0}]}}' END AS assets
      FROM orders)""",
    "format_date_range": statement(
        [],
        RANGED
        + """SELECT parcel_key, concat(CAST(start_day AS VARCHAR), '_', CAST(end_day AS VARCHAR))
       AS date_range FROM ranged""",
    ),
    "join_parcel_scene": statement([found()], "SELECT parcel_key, item_id FROM pairs"),
    "join_parcel_pixel": statement(
        [found()],
        """SELECT w.parcel_key, w.item_id, w.y, w.x, w.px_seq, w.scl
FROM (SELECT b.parcel_key, q.item_id, q.y, q.x, q.px_seq, q.scl
      FROM (SELECT *, (x * 10 + 5) / 1000e0 AS px, (y * 10 + 5) / 1000e0 AS py
            FROM fx_pixel) q
      JOIN fx_box b ON q.px BETWEEN b.minx - 0.0025e0 AND b.maxx + 0.0025e0
                   AND q.py BETWEEN b.miny - 0.0025e0 AND b.maxy + 0.0025e0) w
WHERE (w.parcel_key, w.item_id) IN (SELECT (parcel_key, item_id) FROM pairs)""",
    ),
    "clip_pixels": statement(
        [],
        """SELECT c.parcel_key, q.item_id, q.y, q.x, q.px_seq, q.red, q.scl
FROM fx_pixel q JOIN inside c ON c.y = q.y AND c.x = q.x""",
    ),
    "semi_join_usable_days": kept_items("solar_day", "solar_day"),
    "semi_join_utc_days": kept_items("utc_day", "utc_day"),
    "anti_join_no_scene": statement(
        [found()],
        f"""SELECT parcel_key, {FROM_WHERE} FROM fx_parcel
WHERE parcel_key % 5 = 2 OR parcel_key NOT IN (SELECT parcel_key FROM pairs)""",
    ),
    "anti_join_rejected": statement(
        [found(), CLOUDY, clear_pass(CLOUDY_CLEAR)],
        f"""SELECT parcel_key, {FROM_WHERE} FROM fx_parcel
WHERE parcel_key IN (SELECT parcel_key FROM pairs)
  AND parcel_key NOT IN (SELECT parcel_key FROM usable)""",
    ),
    "join_item_scale": statement(
        [found()],
        f""",
first_scale AS (
  SELECT parcel_key, arg_min(scale, ROW(dt, item_id)) AS scale,
         arg_min(shift, ROW(dt, item_id)) AS shift FROM pairs GROUP BY parcel_key)
SELECT {SAMPLE}, round(red * scale + shift, 9) + 0e0 AS red, round(nir * scale + shift, 9) + 0e0 AS nir, scl
FROM fx_pixel JOIN first_scale USING (parcel_key)""",
    ),
    "resample_nearest": statement(
        [COARSE],
        """SELECT f.parcel_key, f.item_id, f.y, f.x, f.px_seq, k.scl
FROM fx_pixel f LEFT JOIN coarse_class k
  ON k.parcel_key = f.parcel_key AND k.item_id = f.item_id
 AND k.y = floor(f.y / 2) AND k.x = floor(f.x / 2)""",
    ),
    "clear_ratio": ratio_statement(
        f"SELECT parcel_key, {DAY}, round(clear_ratio, 9) + 0e0 AS clear_ratio FROM ratio"
    ),
    "usable_days": ratio_statement(
        f"SELECT parcel_key, {DAY}, round(clear_ratio, 9) + 0e0 AS clear_ratio FROM usable"
    ),
    "spatial_mean": statement([], masked_item_means([*SPECTRAL_BANDS, *ALL])),
    "batch_bounds": statement(
        [],
        "SELECT source_file, date_range, batch_id, minx, miny, maxx, maxy FROM batch_box",
    ),
    "batch_group": statement(
        [],
        """SELECT source_file, date_range, batch_id, n_parcels,
       count(*) OVER (PARTITION BY source_file, date_range) AS n_batches FROM batch_box""",
    ),
    "clear_summary": statement(
        [found(), clear_pass()],
        """SELECT d.parcel_key,
       count(*) FILTER (WHERE clear_ratio > 0.5) AS n_usable, count(*) AS n_dates,
       round(coalesce(max(clear_ratio), 0), 9) + 0e0 AS max_ratio,
       round(avg(clear_ratio) FILTER (WHERE clear_ratio > 0.5), 9) + 0e0 AS mean_usable_ratio
FROM (SELECT DISTINCT parcel_key, solar_day FROM pairs) d
LEFT JOIN ratio r ON r.parcel_key = d.parcel_key AND r.solar_day = d.solar_day
GROUP BY d.parcel_key""",
    ),
    "solar_day_mosaic": statement(
        [found()],
        f"SELECT parcel_key, {DAY}, y, x, "
        + ", ".join(f"{first_valid(b)} AS {b}" for b in [*SPECTRAL_BANDS, "scl"])
        + " FROM fx_pixel JOIN found USING (item_id) GROUP BY parcel_key, found.solar_day, y, x",
    ),
    "first_item_scale": statement(
        [found()],
        """SELECT parcel_key, arg_min(scale, ROW(dt, item_id)) AS scale,
       arg_min(shift, ROW(dt, item_id)) AS "offset" FROM pairs GROUP BY parcel_key""",
    ),
    "run_counters": series_statement(
        ["NDVI"],
        final=""",
debt AS (
  SELECT b.*, s_acctbal < 0 AS debt FROM fx_batch b JOIN supplier ON s_suppkey = b.parcel_key),
solvent_box AS (
  SELECT source_file, date_range, batch_id, min(minx) AS minx, min(miny) AS miny,
         max(maxx) AS maxx, max(maxy) AS maxy
  FROM debt WHERE NOT debt GROUP BY source_file, date_range, batch_id),
batch_items AS (
  SELECT b.source_file, b.date_range, b.batch_id, count(*) AS n_items
  FROM solvent_box b JOIN foot_box f
    ON f.minx <= b.maxx AND f.maxx >= b.minx AND f.miny <= b.maxy AND f.maxy >= b.miny
  JOIN found s ON s.lon0 = f.lon0 AND s.lat0 = f.lat0
  GROUP BY b.source_file, b.date_range, b.batch_id),
points AS (SELECT parcel_key, count(*) AS points FROM stamped GROUP BY parcel_key),
counted AS (
  SELECT source_file, date_range, CASE WHEN NOT debt THEN batch_id END AS batch_id,
         count(*) AS n_parcels, count(*) FILTER (WHERE debt) AS n_dropped,
         count(points) FILTER (WHERE NOT debt) AS n_done,
         CAST(coalesce(sum(points) FILTER (WHERE NOT debt), 0) AS BIGINT) AS n_points
  FROM debt LEFT JOIN points USING (parcel_key)
  GROUP BY ALL)
SELECT c.*, coalesce(n_items, 0) AS n_items
FROM counted c LEFT JOIN batch_items USING (source_file, date_range, batch_id)""",
    ),
    "union_chunks": statement(
        [],
        f"""SELECT item_id, CAST((utc_day - DATE '{START}') // 366 AS BIGINT) AS chunk_idx
FROM valid_scene WHERE utc_day BETWEEN DATE '{START}' AND DATE '{END}'""",
    ),
    "concat_results": statement(
        [],
        f"""SELECT parcel_key, item_id, NDVI, CAST(NULL AS DOUBLE) AS NBR, 'NDVI' AS part
FROM ({masked_item_means(['NDVI'])})
UNION ALL
SELECT parcel_key, item_id, CAST(NULL AS DOUBLE), NBR, 'NBR'
FROM ({masked_item_means(['NBR'])})""",
    ),
} | {name.lower(): one_index(name) for name in ALL}
