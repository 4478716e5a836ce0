import random

import pytest
from pyspark.sql import functions as F

from parcelpulse.functions import geometry, utm
from parcelpulse.operators import spatial
from parcelpulse.schema import RINGS, Grid

SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
HOLE = [(1.0, 1.0), (1.0, 3.0), (3.0, 3.0), (3.0, 1.0)]
CONCAVE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]


def shifted(ring, dx, dy, k=1.0):
    return [(x * k + dx, y * k + dy) for x, y in ring]


def even_odd(rings, px, py):
    """Textbook ray casting in plain Python."""
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                inside = not inside
    return inside


def polygons(spark, shapes):
    return spark.createDataFrame(list(enumerate(shapes)), f"k long, rings {RINGS.simpleString()}")


@pytest.mark.parametrize("rings", [[SQUARE], [CONCAVE], [SQUARE, HOLE], [SQUARE, shifted(SQUARE, 9, 9)]])
def test_contains_matches_ray_casting(spark, rings):
    rnd = random.Random(3)
    points = [(rnd.uniform(-1, 14), rnd.uniform(-1, 14)) for _ in range(300)]
    df = polygons(spark, [rings]).withColumn("e", F.expr(geometry.edges("rings")))
    pts = spark.createDataFrame(points, "px double, py double")
    rows = df.crossJoin(pts).select(
        "px", "py", F.expr(geometry.contains("e", "px", "py")).alias("inside")
    ).collect()
    assert all(r["inside"] == even_odd(rings, r["px"], r["py"]) for r in rows)


@pytest.mark.parametrize(
    "a, b, expected",
    [
        (SQUARE, shifted(SQUARE, 2, 2), True),
        (SQUARE, shifted(SQUARE, 5, 0), False),
        (SQUARE, shifted(SQUARE, 4, 0), True),  # shared edge
        (SQUARE, shifted(SQUARE, 4, 4), True),  # shared corner
        (SQUARE, shifted(SQUARE, 1, 1, 0.25), True),  # b inside a
        (shifted(SQUARE, 1, 1, 0.25), SQUARE, True),  # a inside b
        (CONCAVE, shifted(SQUARE, 1.5, 3.0, 0.25), False),  # in the notch
        ([(-1.0, 1.0), (5.0, 1.0), (5.0, 2.0), (-1.0, 2.0)], SQUARE, True),  # no vertex inside
        (SQUARE + SQUARE[:1], shifted(SQUARE, 4, 0), True),  # closed ring
    ],
)
def test_intersects(spark, a, b, expected):
    df = polygons(spark, [[a]]).selectExpr(
        f"{geometry.edges('rings')} AS ae", f"{geometry.ring_starts('rings')} AS as"
    ).crossJoin(
        polygons(spark, [[b]]).selectExpr(
            f"{geometry.edges('rings')} AS be", f"{geometry.ring_starts('rings')} AS bs"
        )
    )
    assert df.selectExpr(f"{geometry.intersects('ae', '`as`', 'be', 'bs')} AS t").first()["t"] == expected


def test_centroid_bounds_and_batch(spark):
    df = polygons(spark, [[SQUARE], [shifted(SQUARE, 100, 45, 0.01)], [SQUARE, HOLE]])
    rows = (
        spatial.with_bounds(df)
        .withColumn("c", F.expr(geometry.centroid("rings")))
        .withColumn("b", geometry.batch_key("rings", 2))
        .orderBy("k")
        .collect()
    )
    assert (rows[0]["c"]["x"], rows[0]["c"]["y"], rows[0]["b"]) == (2.0, 2.0, "2.0_2.0")
    assert rows[1]["c"]["x"] == pytest.approx(100.02) and rows[1]["b"] == "46.0_100.0"
    assert rows[2]["c"]["x"] == pytest.approx(2.0)
    assert [rows[0][c] for c in geometry.BOUNDS] == [0, 0, 4, 4]
    flat = polygons(spark, [[[(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)]]])
    assert flat.select(F.expr(geometry.centroid("rings")).alias("c")).first()["c"] is None


def test_rounding_is_half_to_even(spark):
    df = polygons(spark, [[shifted(SQUARE, -1, -1)], [shifted(SQUARE, 1, 1)]])
    keys = df.select(geometry.batch_key("rings", 2.0).alias("b")).collect()
    assert [r["b"] for r in keys] == ["0.0_0.0", "4.0_4.0"]


def test_invalid_parcels_are_dropped(spark):
    df = polygons(spark, [None, [], [[(0.0, 0.0), (1.0, 1.0)]], [SQUARE]])
    assert [r["k"] for r in spatial.drop_invalid_parcels(df).collect()] == [3]


def test_known_utm_point(spark):
    df = spark.createDataFrame([(2.2945, 48.8583, 32631)], "lon double, lat double, epsg int")
    row = utm.add_projected(df, "lon", "lat", "epsg", "e", "n").first()
    assert row["e"] == pytest.approx(448251.898, abs=2e-3)
    assert row["n"] == pytest.approx(5411943.794, abs=2e-3)


def test_utm_zone_south_and_edges(spark):
    rows = [(2.0, 45.0, 3.0, 46.0), (-180.0, -10.0, -179.0, -9.0), (179.0, 1.0, 181.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    out = df.select(utm.utm_epsg(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("z"))
    assert [r["z"] for r in out.collect()] == [32631, 32701, 32660]


@pytest.mark.parametrize("rings", [[CONCAVE], [SQUARE, HOLE]])
def test_cells_match_brute_force(spark, rings):
    grid = Grid(0.23)
    rings = [shifted(r, 0.017, -0.031) for r in rings]
    df = polygons(spark, [rings]).withColumnRenamed("k", "parcel_key")
    got = {(r["y"], r["x"]) for r in spatial.parcel_cells(df, grid).collect()}
    want = {
        (y, x)
        for y in range(-3, 25)
        for x in range(-3, 25)
        if even_odd(rings, (x + 0.5) * 0.23, (y + 0.5) * 0.23)
    }
    assert got == want


def test_footprints_match_brute_force(spark):
    """Random parcels and footprints, over several coarse cells, each pair once."""
    rnd = random.Random(11)

    def triangle(size):
        cx, cy = rnd.uniform(-3, 3), rnd.uniform(-3, 3)
        return [(cx + rnd.uniform(0, size), cy + rnd.uniform(0, size)) for _ in range(3)]

    parcels = [triangle(0.5) for _ in range(40)]
    scenes = [triangle(4) for _ in range(15)]

    def cross(o, a, b):
        return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])

    def touch(p, q):
        pe = list(zip(p, p[1:] + p[:1]))
        qe = list(zip(q, q[1:] + q[:1]))
        proper = any(
            cross(a, b, c) * cross(a, b, d) < 0 and cross(c, d, a) * cross(c, d, b) < 0
            for a, b in pe
            for c, d in qe
        )
        return proper or even_odd([q], *p[0]) or even_odd([p], *q[0])

    left = polygons(spark, [[p] for p in parcels]).selectExpr(
        "k AS parcel_key", "rings", "DATE'2024-01-01' AS start", "DATE'2024-02-01' AS end"
    )
    right = polygons(spark, [[s] for s in scenes]).withColumnRenamed("k", "footprint_id")
    rows = spatial.match_footprints(left, right).collect()
    got = [(r["parcel_key"], r["footprint_id"]) for r in rows]
    want = {
        (i, j) for i, p in enumerate(parcels) for j, s in enumerate(scenes) if touch(p, s)
    }
    assert len(got) == len(set(got)) and set(got) == want
