"""Space-filling keys, scene cells, and what they keep a run from reading."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_plans import make_items, parcel_table, pixel_table, scene_table

from parcelpulse.operators import layout, spatial
from parcelpulse.params import Params
from parcelpulse.plans import time_series as ts
from parcelpulse.schema import RINGS, Grid
from parcelpulse.session import new_folder
from parcelpulse.sources.pixels import read_pixels, write_pixels
from parcelpulse.sources.scenes import read_scenes, write_scenes


def plain_interleaved(y, x, bits=layout.AXIS_BITS):
    out = 0
    y, x = y + (1 << (bits - 1)), x + (1 << (bits - 1))
    for k in range(bits):
        out |= (x >> k & 1) << (2 * k) | (y >> k & 1) << (2 * k + 1)
    return out


def test_keys_interleave_bits(spark):
    rnd = random.Random(1)
    limit = 1 << (layout.AXIS_BITS - 1)
    rows = [(rnd.randint(-limit, limit - 1), rnd.randint(-limit, limit - 1)) for _ in range(300)]
    rows += [(-limit, -limit), (limit - 1, limit - 1), (0, 0), (-1, 0)]
    df = spark.createDataFrame(rows, "y long, x long")
    for r in layout.add_interleaved(df, "y", "x", "key").collect():
        assert r["key"] == plain_interleaved(r["y"], r["x"])
    zoned = layout.add_interleaved(df.withColumn("epsg", F.lit(32631)), "y", "x", "key", "epsg")
    for r in zoned.collect():
        assert r["key"] == 32631 << 44 | plain_interleaved(r["y"], r["x"])


@pytest.mark.parametrize("limit", [1, 4, 50, 1000])
def test_ranges_hold_all_keys(spark, limit):
    rnd = random.Random(limit)
    keys = [rnd.randrange(1 << 60) for _ in range(200)] + list(range(5_000, 5_200))
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "key long")
    ranges = layout.key_ranges(df, "key", 60, limit)
    assert 0 < len(ranges) <= limit
    assert all(any(a <= k <= b for a, b in ranges) for k in keys)
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    inside = df.where(layout.in_ranges(F.col("key"), ranges)).count()
    assert inside == len(keys)
    assert layout.key_ranges(df.where("false"), "key", 60, limit) == []
    assert df.where(layout.in_ranges(F.col("key"), [])).count() == 0


def boxes(rnd, n, sizes):
    out = []
    for k in range(n):
        size = rnd.choice(sizes)
        x, y = rnd.uniform(-180, 180 - size), rnd.uniform(-90, 90 - min(size, 90))
        out.append((k, x, y, x + size * rnd.random(), y + min(size, 90) * rnd.random()))
    return out


def overlaps(a, b):
    return a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4]


def test_scenes_in_boxes_equal_brute_force(spark):
    """Tiny to world-wide scenes and boxes; counting without listing agrees."""
    rnd = random.Random(3)
    scenes = boxes(rnd, 400, [0.01, 0.4, 1, 5, 60, 300]) + [(400, -180.0, -90.0, 180.0, 90.0), (401, 1.0, 1.0, 1.0, 1.0)]
    asked = boxes(rnd, 60, [0.001, 0.5, 3, 80]) + [(60, 1.0, 1.0, 2.0, 2.0), (61, -180.0, -90.0, 180.0, 90.0)]
    ring = [[(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]]
    left = spark.createDataFrame(
        [(*s, ring) for s in scenes],
        "item_id long, minx double, miny double, maxx double, maxy double, rings " + RINGS.simpleString(),
    )
    right = spark.createDataFrame(asked, "box long, minx double, miny double, maxx double, maxy double")
    found = spatial.scenes_in_boxes(left, right, ["box"]).collect()
    wanted = sorted((b[0], s[0]) for b in asked for s in scenes if overlaps(b, s))
    assert sorted((r["box"], r["item_id"]) for r in found) == wanted
    counts = {r["box"]: r["n_items"] for r in spatial.count_in_boxes(left, right, ["box"]).collect()}
    want = {}
    for box, _ in wanted:
        want[box] = want.get(box, 0) + 1
    assert counts == want


def metric(df, name):
    """A metric of the plan's scans, after it ran."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        return [
            leaves.apply(k).metrics().apply(name).value()
            for k in range(leaves.size())
            if leaves.apply(k).metrics().contains(name)
        ]
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        df.sparkSession.conf.unset("spark.sql.maxMetadataStringLength")


def far_pixels(spark, items):
    """Rows of blocks from one parcel to the other, twenty degrees on."""
    rows = [(i, 402_000, x, 1, 2, 4) for i in items for x in range(500, 206_000, 500)]
    table = pixel_table(spark, rows)
    days = {i: when.date() for i, (when, *_) in items.items()}
    day_of = F.create_map(*[F.lit(v) for pair in days.items() for v in pair])
    return table.withColumn("acq_day", day_of[F.col("item_id")])


def test_files_between_far_parcels_are_not_read(spark):
    rings = {k: [(lon, 40.0), (lon + 0.5, 40.0), (lon + 0.25, 40.5)] for k, lon in ((1, 0.05), (2, 20.05))}
    items, grid = make_items(), Grid(1, 10_000)
    path = new_folder(spark, "px")
    write_pixels(far_pixels(spark, items), path)
    stored = read_pixels(spark, path, ["red"])
    everywhere = metric(stored.select("red"), "numFiles")[0]
    found = ts.search(parcel_table(spark, rings), scene_table(spark, items), Params(indices=["NDVI"], collection="l2a"))
    near = ts.prune_pixels(stored, found, found.days, grid).select("x", "red")
    scans = metric(near, "numFiles")
    read = max(scans)
    assert 0 < read <= everywhere * 0.6
    inside = {r["x"] for r in near.collect()}
    left, right = range(0, 6_100), range(200_000, 206_100)
    assert inside and all(x in left or x in right for x in inside)
    # The two parcels are read, not their common box.
    plan = plan_of(near)
    assert "tile" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "block_key" in plan.split("PushedFilters")[1].split("ReadSchema")[0]


def test_search_reads_the_scenes_near_each_parcel(spark):
    """One parcel in France and one in Chile: scenes of the places between fall out in the scan."""
    rows = []
    for k, lon in enumerate(range(-75, 12)):
        for lat in range(-35, 50, 5):
            ring = [(lon, lat), (lon + 1.0, lat), (lon + 1.0, lat + 1.0), (float(lon), lat + 1.0)]
            rows.append((f"{lon}/{lat}", "l2a", datetime(2024, 5, 2, 10), [[(float(x), float(y)) for x, y in ring]], 1.0, 1e-4, 0.0, 0.0))
    table = spark.createDataFrame(
        rows,
        "item_id string, collection string, datetime timestamp_ntz,"
        f" rings {RINGS.simpleString()}, cloud_cover double, scale double, offset double, solar_lon double",
    )
    path = new_folder(spark, "scenes")
    write_scenes(table.repartition(8), path)
    rings = {1: [(2.2, 45.2), (2.3, 45.2), (2.3, 45.3)], 2: [(-70.8, -34.8), (-70.7, -34.8), (-70.7, -34.7)]}
    parcels = parcel_table(spark, rings)
    scenes = read_scenes(spark, path)
    found = ts.search(parcels, scenes, Params(indices=["NDVI"], collection="l2a"))
    got = {r["item_id"] for r in found.items.select("item_id").collect()}
    assert got == {"2/45", "-71/-35"}
    near = spatial.scenes_near(ts.catalogue.search(scenes, "l2a"), parcels)
    assert near.count() <= 40
    assert "cell" in plan_of(near).split("PushedFilters")[1].split("ReadSchema")[0]
    assert ts.catalogue.search(scenes, "l2a").count() == len(rows)


def test_busy_squares_and_wide_footprints(spark, monkeypatch):
    """Many parcels in one square under one continent-wide footprint: its copies follow the parcels."""
    n = 30_000
    parcels = spark.range(n).selectExpr(
        "id AS parcel_key",
        "date'2024-05-01' AS start",
        "date'2024-06-01' AS end",
        "array(array(struct(10 + id / 1e6 AS x, 45e0 AS y), struct(10.0001 + id / 1e6 AS x, 45e0 AS y),"
        " struct(10.0001 + id / 1e6 AS x, 45.0001e0 AS y))) AS rings",
    )
    wide = [(-30.0, 20.0), (60.0, 20.0), (60.0, 75.0), (-30.0, 75.0)]
    small = [(10.0, 44.9), (10.01, 44.9), (10.01, 45.1), (10.0, 45.1)]
    away = [(100.0, 44.9), (100.01, 44.9), (100.01, 45.1)]
    footprints = spark.createDataFrame(
        [([wide], "wide"), ([small], "small"), ([away], "away")], f"rings {RINGS.simpleString()}, footprint_id string"
    )
    rows = spatial.match_footprints(parcels, footprints).groupBy("footprint_id").count().collect()
    counts = {r["footprint_id"]: r["count"] for r in rows}
    assert counts["wide"] == n and 9_900 < counts["small"] < 10_100 and "away" not in counts
    copies = spatial.footprints_in_slots(parcels, footprints).groupBy("footprint_id").count().collect()
    slots = -(-n // spatial.ROWS_PER_TASK)
    assert {r["footprint_id"]: r["count"] for r in copies}["wide"] <= 4 * slots

