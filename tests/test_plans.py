import random
from datetime import date, datetime, timedelta

import pytest
from brute import ndvi_series, utm
from compare import differences, duck
from pyspark.sql import functions as F
from test_queries import ORACLES, QUERIES, SF_DIR

from parcelpulse import parcel_time_series
from parcelpulse.operators import mosaic, spatial
from parcelpulse.params import Params
from parcelpulse.plans import time_series as ts
from parcelpulse.schema import RINGS, Grid
from parcelpulse.session import new_folder
from parcelpulse.sources.pixels import read_pixels, write_pixels
from parcelpulse.sources.scenes import read_scenes

WORLD = [(-20.0, 30.0), (30.0, 30.0), (30.0, 60.0), (-20.0, 60.0)]


def parcel_table(spark, rings):
    rows = [
        (k, f"id{k}", "f.parquet", "2024-05-01_2024-06-30", date(2024, 5, 1), date(2024, 6, 30), [r])
        for k, r in rings.items()
    ]
    return spark.createDataFrame(
        rows,
        "parcel_key long, parcel_id string, source_file string, date_range string, start date,"
        f" end date, rings {RINGS.simpleString()}",
    )


def scene_table(spark, items):
    rows = [
        (i, "l2a", when, [WORLD], 10.0, scale, offset, 0.0)
        for i, (when, _, scale, offset) in items.items()
    ]
    return spark.createDataFrame(
        rows,
        "item_id string, collection string, datetime timestamp_ntz,"
        f" rings {RINGS.simpleString()}, cloud_cover double, scale double, offset double,"
        " solar_lon double",
    )


def make_items():
    days = [datetime(2024, 5, 2, 10), datetime(2024, 5, 2, 10, 5), datetime(2024, 5, 9, 10),
            datetime(2024, 5, 16, 10), datetime(2024, 5, 16, 10)]
    return {
        f"s{n}": (t, t.date(), 0.0001, -0.1 if n in (1, 3) else 0.0) for n, t in enumerate(days)
    }


def random_pixels(rnd, items, ys, xs, scl=True):
    return [
        (i, y, x, rnd.choice([0, rnd.randint(1, 4000)]) if rnd.random() < 0.2 else rnd.randint(1500, 4000),
         rnd.randint(1500, 6000), rnd.choice([0, 3, 4, 4, 4, 5, 8]) if scl else None)
        for i in items
        for y in ys
        for x in xs
        if rnd.random() < 0.9
    ]


def pixel_table(spark, pixels, **constants):
    df = spark.createDataFrame(
        pixels, "item_id string, y long, x long, red int, nir int, scl int"
    ).withColumns({"green": F.lit(1), "blue": F.lit(1)})
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def as_dict(df):
    return {
        (r["parcel_key"], r["solar_day"]): (r["red"], r["NDVI"]) for r in df.collect()
    }


def assert_close(got, want):
    assert set(got) == set(want) and want
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-9)


def test_utm_run_with_coarse_class_table(spark):
    rnd = random.Random(5)
    lonlat = {
        1: [(2.2901, 48.8501), (2.2923, 48.8503), (2.2921, 48.8517), (2.2911, 48.8506)],
        2: [(2.2915, 48.8500), (2.2930, 48.8500), (2.2930, 48.8512)],
    }
    rings = {k: [[utm(lon, lat, 31) for lon, lat in r]] for k, r in lonlat.items()}
    items = make_items()
    flat = [v for r in rings.values() for v in r[0]]
    ys = range(int(min(v[1] for v in flat) // 10) - 1, int(max(v[1] for v in flat) // 10) + 2)
    xs = range(int(min(v[0] for v in flat) // 10) - 1, int(max(v[0] for v in flat) // 10) + 2)
    pixels = random_pixels(rnd, items, ys, xs, scl=False)
    coarse = {
        (i, y, x): rnd.choice([0, 3, 4, 4, 4, 5, 8])
        for i in items
        for y in range(ys[0] // 2, ys[-1] // 2 + 1)
        for x in range(xs[0] // 2, xs[-1] // 2 + 1)
    }
    classes = spark.createDataFrame(
        [(*k, s) for k, s in coarse.items()], "item_id string, y long, x long, scl int"
    ).withColumn("epsg", F.lit(32631))
    out = parcel_time_series(
        parcel_table(spark, lonlat),
        scene_table(spark, items),
        pixel_table(spark, pixels, epsg=32631).drop("scl"),
        ["NDVI"],
        collection="l2a",
        grid=Grid(10),
        classes=classes,
        class_grid=Grid(20),
        utm=True,
    )
    want = ndvi_series(
        rings, items, pixels, lambda y, x: ((x + 0.5) * 10, (y + 0.5) * 10),
        coarse, lambda y, x: ((x + 0.5) * 20, (y + 0.5) * 20),
    )
    assert_close(as_dict(out), want)
    first = out.where("solar_day = '2024-05-02'").first()
    assert first is None or first["time"] == datetime(2024, 5, 2, 10)


def test_one_parcel_holds_most_pixels(spark, monkeypatch):
    """A large parcel, small ones beside it, and sort-merge joins that AQE may split."""
    rnd = random.Random(9)
    rings = {0: [(0.05, 40.05), (3.05, 40.05), (3.05, 43.05), (0.05, 43.05)]}
    for k in range(1, 9):
        rings[k] = [(3.2 + k / 3, 40.02), (3.4 + k / 3, 40.02), (3.3 + k / 3, 40.33)]
    items = make_items()
    ys, xs = range(398, 434), range(-2, 66)
    pixels = random_pixels(rnd, items, ys, xs)
    want = ndvi_series(
        {k: [r] for k, r in rings.items()}, items, pixels,
        lambda y, x: ((x * 10 + 5) / 100, (y * 10 + 5) / 100),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        out = parcel_time_series(
            parcel_table(spark, rings), scene_table(spark, items), pixel_table(spark, pixels),
            ["NDVI"], collection="l2a", grid=Grid(10, 100),
        )
        assert_close(as_dict(out), want)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_result_does_not_depend_on_broadcasts(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["parcel_time_series"](spark, SF_DIR)
        assert differences(df, ORACLES["parcel_time_series"], duck(SF_DIR)) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def executed(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_flagship_plan_shape(spark):
    """No nested loops, no Python workers, hash aggregation, and a narrow, pruned scan."""
    items, rings = make_items(), {1: [(0.05, 40.05), (0.95, 40.05), (0.5, 40.95)]}
    path = new_folder(spark, "px")
    days = {i: when.date() for i, (when, *_) in items.items()}
    day_of = F.create_map(*[F.lit(v) for pair in days.items() for v in pair])
    write_pixels(
        pixel_table(
            spark, random_pixels(random.Random(1), items, range(398, 412), range(-2, 12))
        ).withColumns(
            {"swir16": F.lit(1), "rededge1": F.lit(1), "acq_day": day_of[F.col("item_id")]}
        ),
        path,
    )
    out = parcel_time_series(
        parcel_table(spark, rings), scene_table(spark, items),
        read_pixels(spark, path, ["red", "green", "blue", "nir", "swir16"]),
        ["NDVI"], collection="l2a", grid=Grid(10, 100),
    )
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = executed(out)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    for word in ("NestedLoop", "Cartesian", "Python", "Pandas", "Window"):
        assert word not in plan
    scan = next(line for line in plan.splitlines() if path in line)
    assert "swir16" not in scan and "rededge1" not in scan
    assert "acq_day" in scan.split("PartitionFilters")[1].split("]")[0]
    assert "block_key" in scan.split("PushedFilters")[1]


def test_mosaic_adds_one_exchange_and_aggregates_before_it(spark):
    df = spark.range(1000).selectExpr(
        "id % 3 AS parcel_key", "date'2024-05-01' AS solar_day", "id % 7 AS y", "id % 5 AS x",
        "id AS item_seq", "id % 11 AS red",
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = executed(mosaic.solar_day_mosaic(df, ["red"]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2


def test_search_reaches_the_scan(spark):
    path = new_folder(spark, "scenes")
    scene_table(spark, make_items()).write.parquet(path)
    found = ts.catalogue.search(read_scenes(spark, path), "l2a", 80, "2024-05-01", "2024-05-10")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = executed(found.select("item_id"))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):]
    for word in ("LessThan(cloud_cover,80.0)", "EqualTo(collection,l2a)", "datetime"):
        assert word in pushed


def test_pixels_between_far_parcels_are_not_shuffled(spark):
    """Pixels of blocks without a parcel fall out before the first exchange."""
    rings = {
        k: [(lon, 40.05), (lon + 0.9, 40.05), (lon + 0.45, 40.95)]
        for k, lon in ((1, 0.05), (2, 20.05))
    }
    items, grid = make_items(), Grid(10, 1000)
    path = new_folder(spark, "px")
    rows = [(i, 4040, x, 1, 1, 4) for i in items for x in (50, 1000, 2050)]
    pixel_table(spark, rows).write.parquet(path)
    params = Params(indices=["NDVI"], collection="l2a")
    found = ts.search(parcel_table(spark, rings), scene_table(spark, items), params)
    near = ts.prune_pixels(spark.read.parquet(path), found, found.days, grid)
    assert {r["x"] for r in near.select("x").collect()} == {50, 2050}
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        cells = spatial.parcel_cells(found.parcels, grid)
        lines = executed(spatial.clip_pixels(near, cells)).splitlines()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(n for n, line in enumerate(lines) if path in line)
    semi = max(n for n in range(scan) if "LeftSemi" in lines[n])
    assert not any("Exchange" in line for line in lines[semi:scan])


@pytest.mark.parametrize("name", ["join_parcel_scene"])
def test_busy_cells_are_dealt_without_loss(spark, monkeypatch, name):
    monkeypatch.setattr(spatial, "ROWS_PER_TASK", 20)
    assert differences(QUERIES[name](spark, SF_DIR), ORACLES[name], duck(SF_DIR)) is None


def test_folders_may_differ_in_dates(spark):
    """Each parcel row only meets scenes of its own dates; both bounds are inclusive."""
    items = {
        f"d{n}": (datetime(2024, 4, 30, 12) + timedelta(days=n), None, 0.0001, 0.0)
        for n in range(70)
    }
    rings = {1: WORLD}
    two = parcel_table(spark, rings).unionByName(
        parcel_table(spark, {2: WORLD}).withColumns(
            {"start": F.lit("2024-06-10").cast("date"), "end": F.lit("2024-06-12").cast("date")}
        )
    )
    params = Params(indices=["NDVI"], collection="l2a")
    found = ts.search(two, scene_table(spark, items), params)
    days = found.days.groupBy("parcel_key").agg(
        F.min("utc_day").alias("a"), F.max("utc_day").alias("b"), F.sum("n_items").alias("n")
    )
    got = {r["parcel_key"]: (str(r["a"]), str(r["b"]), r["n"]) for r in days.collect()}
    assert got == {1: ("2024-05-01", "2024-06-30", 61), 2: ("2024-06-10", "2024-06-12", 3)}


def test_run_keeps_parcels_without_id(spark):
    """The series has the same rows with and without a saved cube, null ids or not."""
    from parcelpulse import run_folders
    from parcelpulse.checks import fixtures as fx
    from parcelpulse.params import Params
    from parcelpulse.plans.run import RunPaths
    from parcelpulse.session import new_folder
    from parcelpulse.sources.results import read_series

    root = new_folder(spark, "in")
    rows = fx.parcels(spark, SF_DIR).select(
        F.expr("CASE WHEN parcel_key % 2 = 0 THEN parcel_id END").alias("ID_PARCEL"),
        F.lit(4326).alias("epsg"),
        "rings",
    )
    rows.write.parquet(f"{root}/{fx.START}_{fx.END}/a.parquet")
    counts = []
    for save in (False, True):
        paths = RunPaths(series=new_folder(spark, "mean"), cube=new_folder(spark, "cube"))
        params = Params(indices=["NDVI"], collection=fx.COLLECTION, save_cube=save)
        pixels = fx.pixels(spark, SF_DIR).drop("parcel_key")
        assert run_folders(spark, root, fx.scenes(spark, SF_DIR), pixels, paths, params, fx.GRID)
        counts.append(read_series(spark, paths.series).count())
    assert counts[0] == counts[1] > 0
