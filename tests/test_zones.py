"""Pixels stored in several UTM zones, brought to the grid of a parcel's own zone."""

import math
import random

import pytest
from brute import ndvi_series, utm
from pyspark.sql import functions as F
from test_geometry import even_odd
from test_plans import as_dict, assert_close, make_items, parcel_table, pixel_table, scene_table

from parcelpulse import parcel_time_series
from parcelpulse.functions import utm as projection
from parcelpulse.schema import Grid

RES = 10


def back(east, north, zone):
    """Longitude and latitude by Newton steps on the forward series."""
    lon, lat, step = zone * 6 - 183.0, north / 111_000, 1e-6
    for _ in range(30):
        x, y = utm(lon, lat, zone)
        dx, dy = east - x, north - y
        x1, y1 = utm(lon + step, lat, zone)
        x2, y2 = utm(lon, lat + step, zone)
        a, b, c, d = (x1 - x) / step, (x2 - x) / step, (y1 - y) / step, (y2 - y) / step
        det = a * d - b * c
        lon, lat = lon + (d * dx - b * dy) / det, lat + (a * dy - c * dx) / det
        if abs(dx) + abs(dy) < 1e-7:
            break
    return lon, lat


def square(lon, lat, size=0.0012):
    return [(lon, lat), (lon + size, lat + size / 9), (lon + size * 0.9, lat + size), (lon + size / 7, lat + size * 0.8)]


def own_cells(ring, zone):
    """Cells whose centre lies in the ring, on the zone's grid."""
    edge = [utm(*v, zone) for v in ring]
    xs, ys = ([int(v[k] // RES) for v in edge] for k in (0, 1))
    return [
        (y, x)
        for y in range(min(ys) - 1, max(ys) + 2)
        for x in range(min(xs) - 1, max(xs) + 2)
        if even_odd([edge], (x + 0.5) * RES, (y + 0.5) * RES)
    ]


def samples(rnd, cells, items):
    return [
        (i, y, x, rnd.randint(1500, 4000), rnd.randint(1500, 6000), rnd.choice([4, 4, 4, 5, 8, 0]))
        for i in items
        for y, x in cells
    ]


def around(ring, zone, margin=3):
    edge = [utm(*v, zone) for v in ring]
    xs, ys = ([int(v[k] // RES) for v in edge] for k in (0, 1))
    return [
        (y, x)
        for y in range(min(ys) - margin, max(ys) + margin + 1)
        for x in range(min(xs) - margin, max(xs) + margin + 1)
    ]


def run(spark, rings, scenes, pixels, **options):
    out = parcel_time_series(
        parcel_table(spark, rings), scenes, pixels, ["NDVI"],
        collection="l2a", grid=Grid(RES), utm=True, **options,
    )
    return as_dict(out)


@pytest.mark.parametrize("epsg", [32601, 32631, 32632, 32660, 32733])
def test_inverse_projection(spark, epsg):
    """There and back, also from points far in the neighbouring zones, is exact to a hair."""
    rnd = random.Random(epsg)
    centre = epsg % 100 * 6 - 183
    south = epsg >= 32700
    rows = [(centre + rnd.uniform(-9, 9), rnd.uniform(-80, 0) if south else rnd.uniform(0, 84)) for _ in range(300)]
    df = spark.createDataFrame(rows, "lon double, lat double").withColumn("epsg", F.lit(epsg))
    there = projection.add_projected(df, "lon", "lat", "epsg", "east", "north")
    for r in projection.add_unprojected(there, "east", "north", "epsg", "lon2", "lat2").collect():
        metres = math.hypot((r["lon2"] - r["lon"]) * 111_320 * math.cos(math.radians(r["lat"])), (r["lat2"] - r["lat"]) * 111_320)
        assert metres < 0.005


@pytest.mark.parametrize("batch", [0.5, 2.0, 20.0])
def test_parcels_on_both_sides_of_a_border(spark, batch):
    """Each has clear pixels in its own zone only, and a series whatever the batch."""
    rnd = random.Random(1)
    rings = {1: square(5.95, 45.0), 2: square(6.40, 45.0)}
    items = make_items()
    scenes = scene_table(spark, items)
    parts = []
    for key, zone in ((1, 31), (2, 32)):
        cells = around(rings[key], zone, 60 if batch > 2 else 3)
        parts.append(
            pixel_table(spark, [(i, y, x, rnd.randint(1, 4000), 5000, 4) for i in items for y, x in cells], epsg=32600 + zone)
        )
    found = run(spark, rings, scenes, parts[0].union(parts[1]), batch_size_deg=batch)
    days = {when.date() for when, *_ in items.values()}
    assert set(found) == {(k, d) for k in rings for d in days}


def test_a_scene_of_the_next_zone_serves_the_parcel(spark):
    """Every cell of the parcel's grid takes the stored cell that its centre falls in."""
    rnd = random.Random(4)
    ring = square(5.9, 45.3)
    items = make_items()
    stored = {(i, y, x): rest for i, y, x, *rest in samples(rnd, around(ring, 32, 6), items)}
    pixels = [(*key, *rest) for key, rest in stored.items()]
    cells = own_cells(ring, 31)
    moved, sources = [], set()
    for y, x in cells:
        east, north = utm(*back((x + 0.5) * RES, (y + 0.5) * RES, 31), 32)
        source = (math.floor(north / RES), math.floor(east / RES))
        sources.add(source)
        moved += [(i, y, x, *stored[(i, *source)]) for i in items]
    assert len(cells) > 50 and sources != set(cells)
    want = ndvi_series(
        {1: [[utm(*v, 31) for v in ring]]}, items, moved, lambda y, x: ((x + 0.5) * RES, (y + 0.5) * RES)
    )
    table = pixel_table(spark, pixels, epsg=32632)
    plain = scene_table(spark, items)
    assert_close(run(spark, {1: ring}, plain, table), want)
    # The same when the catalogue names the zone, and when the table is stored by block.
    assert_close(run(spark, {1: ring}, plain.withColumn("epsg", F.lit(32632)), table), want)
    from parcelpulse.session import new_folder
    from parcelpulse.sources.pixels import read_pixels, write_pixels

    path = new_folder(spark, "px")
    days = {i: when.date() for i, (when, *_) in items.items()}
    day_of = F.create_map(*[F.lit(v) for pair in days.items() for v in pair])
    write_pixels(table.withColumn("acq_day", day_of[F.col("item_id")]), path)
    assert_close(run(spark, {1: ring}, plain, read_pixels(spark, path, ["red", "green", "blue", "nir"])), want)


def test_day_from_both_zones_is_one_mosaic(spark):
    """Half of a parcel is stored in each zone, by two scenes of one day: one date, all cells."""
    ring = square(5.99, 45.3)
    items = {k: v for k, v in make_items().items() if k in ("s0", "s1")}
    middle = 5.99 + 0.0006
    rows = {31: [], 32: []}
    for item, zone in (("s0", 31), ("s1", 32)):
        for y, x in around(ring, zone, 4):
            lon, _ = back((x + 0.5) * RES, (y + 0.5) * RES, zone)
            if (lon < middle) == (zone == 31):
                rows[zone].append((item, y, x, 1000, 3000, 4))
    pixels = pixel_table(spark, rows[31], epsg=32631).union(pixel_table(spark, rows[32], epsg=32632))
    from parcelpulse.params import Params
    from parcelpulse.plans import time_series as ts

    found = ts.search(parcel_table(spark, {1: ring}), scene_table(spark, items), Params(indices=["NDVI"], collection="l2a"), utm=True)
    classes = ts.class_mosaic(pixels, found, Grid(RES))
    got = {(r["y"], r["x"]) for r in classes.collect()}
    cells = set(own_cells(ring, 31))
    assert len(cells - got) <= len(cells) // 10  # cells on the seam may have no sample
    assert classes.select("solar_day").distinct().count() == 1


def test_utm_needs_the_zone_of_the_pixels(spark):
    items = make_items()
    with pytest.raises(ValueError, match="epsg"):
        run(spark, {1: square(5.9, 45.3)}, scene_table(spark, items), pixel_table(spark, [("s0", 1, 1, 1, 1, 4)]))
