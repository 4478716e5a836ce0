import json
import logging

import pytest
from pyspark.sql import functions as F

from parcelpulse.schema import PARCEL_FILE, RINGS
from parcelpulse.session import new_folder
from parcelpulse.sources import parcels, pixels, results, scenes

RING = [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]


def put(spark, path, rows, file_format="parquet"):
    spark.createDataFrame(rows, PARCEL_FILE).coalesce(1).write.format(file_format).save(path)


def test_parcels_of_all_folders(spark):
    root = new_folder(spark, "in")
    put(spark, f"{root}/2024-01-01_2024-02-01/a.parquet", [("p", None, [RING]), ("p", 4326, [RING])])
    put(spark, f"{root}/2024-03-01_2024-04-01/b.parquet", [("q", None, [RING]), ("r", None, None)])
    put(spark, f"{root}/_old_2024/c.parquet", [("x", None, [RING])])
    put(spark, f"{root}/north_south/c.parquet", [("x", None, [RING])])
    put(spark, f"{root}/2024-05-01_2024-06-01/empty.parquet", [])
    rows = parcels.read_parcels(spark, root).collect()
    assert sorted((r["parcel_id"], r["source_file"], r["date_range"]) for r in rows) == [
        ("p", "a.parquet", "2024-01-01_2024-02-01"),
        ("p", "a.parquet", "2024-01-01_2024-02-01"),
        ("q", "b.parquet", "2024-03-01_2024-04-01"),
    ]
    assert len({r["parcel_key"] for r in rows}) == 3
    assert {r["start"].isoformat() for r in rows} == {"2024-01-01", "2024-03-01"}
    assert {r["epsg"] for r in rows} == {4326}


def test_odd_names_below_the_root(spark):
    """A file named like its root, names with spaces and signs, and a success marker."""
    root = f"{new_folder(spark, 'x')}/in"
    folder = f"{root}/2024-01-01_2024-02-01"
    put(spark, f"{folder}/in", [("p", None, [RING])])
    put(spark, f"{folder}/a b+c%.parquet", [("q", None, [RING])])
    put(spark, f"{root}/2024-03-01_2024-04-01", [("r", None, [RING])])
    rows = parcels.read_parcels(spark, root).collect()
    names = {r["parcel_id"]: r["source_file"] for r in rows}
    assert names["p"] == "in" and names["q"] == "a b+c%.parquet"
    assert names["r"].startswith("part-") and len(rows) == 3


@pytest.mark.parametrize("order", [("long", "int", "string", "decimal(10,0)"), ("string", "long", "string", "short")])
def test_ids_of_any_type(spark, order):
    """Files of one run whose ids, and codes, have different types."""
    root = new_folder(spark, "in")
    for k, id_type in enumerate(order):
        rows = spark.createDataFrame([(100 + k, 4326, [RING])], "ID_PARCEL long, epsg long, rings " + RINGS.simpleString())
        code = "string" if k == 1 else "long"
        rows.select(F.col("ID_PARCEL").cast(id_type), F.col("epsg").cast(code), "rings").write.parquet(
            f"{root}/2024-01-01_2024-02-01/f{k} [x].parquet"
        )
    read = parcels.read_parcels(spark, root)
    assert dict(read.dtypes)["parcel_id"] == "string"
    assert sorted((r["parcel_id"], r["source_file"], r["epsg"]) for r in read.collect()) == [
        (str(100 + k), f"f{k} [x].parquet", 4326) for k in range(4)
    ]


def test_a_damaged_file_is_an_error(spark, tmp_path):
    folder = tmp_path / "2024-01-01_2024-02-01"
    folder.mkdir()
    (folder / "a.parquet").write_bytes(b"no parquet at all")
    with pytest.raises(Exception, match="a.parquet"):
        parcels.read_parcels(spark, str(tmp_path)).collect()


@pytest.mark.parametrize(
    "text, utc",
    [
        ("2024-05-01T10:56:21.024Z", "2024-05-01 10:56:21.024"),
        ("2024-05-01T01:30:00+02:00", "2024-04-30 23:30:00"),
        ("2024-05-01T23:30:00-0130", "2024-05-02 01:00:00"),
        ("2024-05-01T10:00:00", "2024-05-01 10:00:00"),
        ("2024-05-01", "2024-05-01 00:00:00"),
        ("no time", None),
        (None, None),
    ],
)
def test_times_are_turned_to_utc(spark, text, utc):
    row = spark.createDataFrame([(text,)], "t string").select(scenes.in_utc(F.col("t")).cast("string")).first()
    assert row[0] == utc


def test_parcels_as_json(spark):
    root = new_folder(spark, "in")
    put(spark, f"{root}/2024-01-01_2024-02-01/a.json", [("p", None, [RING])], "json")
    assert parcels.read_parcels(spark, root, "json").count() == 1


def test_missing_id_column_names_file_and_columns(spark):
    root = new_folder(spark, "in")
    put(spark, f"{root}/2024-01-01_2024-02-01/good.parquet", [("p", None, [RING])])
    spark.createDataFrame([("p", [RING])], "name string, rings array<array<struct<x:double,y:double>>>").write.parquet(
        f"{root}/2024-01-01_2024-02-01/bad.parquet"
    )
    with pytest.raises(ValueError, match="bad.parquet.*name.*ID_PARCEL"):
        parcels.read_parcels(spark, root)


def test_ids_that_are_all_null_are_not_a_missing_column(spark):
    root = new_folder(spark, "in")
    put(spark, f"{root}/2024-01-01_2024-02-01/a.parquet", [(None, None, [RING])])
    assert parcels.read_parcels(spark, root).count() == 1


def test_foreign_crs_is_an_error(spark):
    root = new_folder(spark, "in")
    put(spark, f"{root}/2024-01-01_2024-02-01/a.parquet", [("p", 2154, [RING])])
    with pytest.raises(ValueError, match="4326"):
        parcels.read_parcels(spark, root)


def test_stac_items(spark):
    square = [[0, 0], [1, 0], [1, 1], [0, 0]]
    items = [
        {
            "id": "a",
            "collection": "l2a",
            "geometry": {"type": "Polygon", "coordinates": [square]},
            "properties": {"datetime": "2024-05-01T10:56:21.024000Z", "eo:cloud_cover": 12.5},
            "assets": {"red": {"raster:bands": [{"scale": 0.0001, "offset": -0.1}]}},
        },
        {
            "id": "b",
            "collection": "l2a",
            "geometry": {"type": "MultiPolygon", "coordinates": [[square], [square, square]]},
            "properties": {"datetime": None},
            "assets": {},
        },
        {"id": "c", "collection": "l2a", "geometry": None, "properties": {}, "assets": {}},
    ]
    path = new_folder(spark, "items")
    spark.createDataFrame([(json.dumps(i),) for i in items], "value string").write.text(path)
    rows = {r["item_id"]: r for r in scenes.read_scenes(spark, path, "json").collect()}
    a = rows["a"]
    assert (a["cloud_cover"], a["scale"], a["offset"]) == (12.5, 0.0001, -0.1)
    assert a["datetime"].isoformat() == "2024-05-01T10:56:21.024000"
    assert [(v["x"], v["y"]) for v in a["rings"][0]] == [(0, 0), (1, 0), (1, 1), (0, 0)]
    b = rows["b"]
    assert len(b["rings"]) == 3 and b["datetime"] is None and b["cloud_cover"] is None
    assert rows["c"]["rings"] is None and rows["c"]["scale"] == 0.0001
    # The flat table comes back as it was written.
    flat = new_folder(spark, "flat")
    scenes.read_scenes(spark, path, "json").write.parquet(flat)
    assert scenes.read_scenes(spark, flat).count() == 3


def test_pixels_missing_band(spark):
    path = new_folder(spark, "px")
    table = spark.createDataFrame(
        [("a", 1, 1, 5, 4, "2024-05-01")], "item_id string, y long, x long, red int, scl int, acq_day string"
    ).withColumn("acq_day", F.to_date("acq_day"))
    pixels.write_pixels(table, path)
    assert pixels.read_pixels(spark, path, ["red"]).columns == [
        "item_id", "y", "x", "acq_day", "tile", "block_key", "red", "scl",
    ]
    with pytest.raises(ValueError, match="nir"):
        pixels.read_pixels(spark, path, ["red", "nir"])


def test_empty_series_writes_nothing(spark, caplog):
    path = new_folder(spark, "series")
    empty = spark.createDataFrame([], "time timestamp_ntz, NDVI double")
    with caplog.at_level(logging.WARNING):
        assert results.write_series(empty, path) is False
    assert "nothing written" in caplog.text
    one = spark.createDataFrame([(None, 0.5)], empty.schema)
    assert results.write_series(one, path) and results.write_series(one, path)
    assert results.read_series(spark, path).count() == 1


def cube(spark, parcel, day, value, file="a.parquet"):
    return spark.createDataFrame(
        [(day, parcel, f"{parcel:04d}", file, 1, 0, 0, value, value)],
        "date_range string, parcel_key long, parcel_id string, source_file string, time int,"
        " y long, x long, red double, nir double",
    )


@pytest.mark.parametrize("by_parcel, left", [(False, {3, 4}), (True, {1, 2, 3, 4})])
def test_cube_overwrites_what_it_holds(spark, by_parcel, left):
    path = new_folder(spark, "cube")
    first = cube(spark, 1, "r1", 0.1).union(cube(spark, 2, "r1", 0.1)).union(cube(spark, 3, "r2", 0.1))
    results.write_cube(first.union(cube(spark, 4, "r1", 0.1, "b.parquet")), path, by_parcel)
    results.write_cube(cube(spark, 9, "r1", 0.9).union(cube(spark, 2, "r1", 0.8)), path, by_parcel)
    rows = {r["parcel_key"]: r for r in results.read_cube(spark, path).collect()}
    assert set(rows) == left | {2, 9} and rows[2]["red"] == 0.8
    assert {r["parcel_id"] for r in rows.values()} == {f"{k:04d}" for k in rows}


def test_empty_cube_is_read_with_its_schema(spark):
    path = new_folder(spark, "cube")
    empty = cube(spark, 1, "r1", 0.1).where("false")
    results.write_cube(empty, path)
    assert results.read_cube(spark, path, schema=empty.schema).count() == 0


@pytest.mark.parametrize(
    "path, place",
    [
        ("s3a://bucket/2024-01-01_2024-02-01/a.parquet", ("2024-01-01_2024-02-01", "a.parquet")),
        ("file:/x/proj/y/proj/2024-01-01_2024-02-01/a%20b.parquet", ("2024-01-01_2024-02-01", "a b.parquet")),
        ("file:/2020-01-01_2020-02-01/in/2024-01-01_2024-02-01/a/part-0.parquet", ("2024-01-01_2024-02-01", "a")),
        ("file:/in/other/a.parquet", ("", "")),
    ],
)
def test_place_does_not_depend_on_the_root(spark, path, place):
    row = spark.createDataFrame([(path,)], "p string").select(
        parcels._place(F.col("p"), 1).alias("folder"), parcels._place(F.col("p"), 2).alias("file")
    )
    assert tuple(row.first()) == place


def test_cube_without_red_is_an_error(spark):
    path = new_folder(spark, "cube")
    results.write_cube(cube(spark, 1, "r1", 0.1).drop("red"), path)
    with pytest.raises(ValueError, match="red"):
        results.read_cube(spark, path)


def test_all_tasks_make_folders_of_parcels(spark, tmp_path):
    path = str(tmp_path / "cubes")
    rows = spark.range(64).selectExpr(
        "cast(id AS string) AS parcel_id", "id AS parcel_key", "'r1' AS date_range", "'a.parquet' AS source_file",
        "timestamp_seconds(id) AS time", "id AS y", "id AS x", "0.1 AS red", "0.2 AS nir",
    )
    results.write_cube(rows, path, by_parcel=True)
    tasks = {p.name.split("-")[1] for p in (tmp_path / "cubes").rglob("part-*.parquet")}
    assert len(tasks) > 1  # a few bytes each, they were put together in one
    read = results.read_cube(spark, path, schema=rows.schema)
    assert sorted(r["parcel_id"] for r in read.collect()) == sorted(map(str, range(64)))
