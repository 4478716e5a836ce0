"""Rows that no partner waits for are left out before a shuffle, and no others."""

import math

import pytest
from pyspark.sql import functions as F

from parcelpulse.operators import clarity, faults, series, spatial
from parcelpulse.operators.sieve import sift
from parcelpulse.plans.rejected import rejected_ndvi
from parcelpulse.plans.time_series import Search, matched_pixels, spectral_cube
from parcelpulse.schema import RINGS, Grid
from parcelpulse.session import hold


@pytest.mark.parametrize("kinds", [("int", "long"), ("long", "long"), ("string", "string"), ("date", "date")])
def test_sift_keeps_all_partners_and_few_others(spark, kinds):
    def typed(df, kind):
        return df.withColumn("k", F.date_add(F.lit("2000-01-01"), F.col("k").cast("int")) if kind == "date" else F.col("k").cast(kind))

    rows = typed(spark.range(-500, 2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), kinds[0])
    keys = typed(spark.range(-700, 3000, 7).select(F.col("id").alias("k")), kinds[1])
    rows = rows.unionByName(rows.limit(3).withColumn("k", F.lit(None).cast(rows.schema["k"].dataType)))
    sifted = sift(rows, keys.unionByName(keys), ["k"])
    assert sifted.columns == rows.columns
    partners = rows.join(keys, "k").select("v").collect()
    assert sorted(r.v for r in sifted.join(keys, "k").collect()) == sorted(r.v for r in partners)
    assert sifted.count() <= len(partners) + 10


def test_sift_leaves_keys_of_different_kinds_to_the_join(spark):
    rows = spark.range(3).select(F.col("id").cast("string").alias("k"))
    assert sift(rows, spark.range(1).withColumnRenamed("id", "k"), ["k"]).count() == 3


def test_sift_without_keys_keeps_nothing(spark):
    assert sift(spark.range(5), spark.range(0), ["id"]).count() == 0


def _tables(spark):
    pixels = spark.createDataFrame(
        [(i, y, 0, 10 * i + y) for i in (1, 2, 3, 4) for y in (0, 1, 2)], "item_id long, y long, x long, red long"
    )
    items = spark.createDataFrame(
        [(1, 7, "2000-01-01"), (2, 8, "2000-01-01"), (3, 7, "2000-01-02")],
        "item_id long, footprint_id long, day string",
    ).selectExpr("item_id", "footprint_id", "date(day) AS solar_day", "date(day) AS utc_day")
    # Both parcels hold the cell (0, 0); only the first one has a day with footprint 7.
    cells = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (2, 0, 0)], "parcel_key long, y long, x long")
    days = spark.createDataFrame(
        [(1, 7, "2000-01-01"), (2, 8, "2000-01-01")], "parcel_key long, footprint_id long, day string"
    ).selectExpr("parcel_key", "footprint_id", "date(day) AS solar_day", "date(day) AS utc_day")
    return pixels, items, cells, days


@pytest.mark.parametrize("few", [False, True])
def test_matched_pixels_are_those_of_the_three_joins(spark, few):
    pixels, items, cells, days = _tables(spark)
    matched = matched_pixels(pixels, cells, items, days, few)
    plain = pixels.join(items, "item_id").join(cells, ["y", "x"]).join(days, spatial.DAY_KEYS)
    expected = sorted((r.parcel_key, r.item_id, r.y, r.red) for r in plain.collect())
    assert sorted((r.parcel_key, r.item_id, r.y, r.red) for r in matched.collect()) == expected
    assert expected == [(1, 1, 0, 10), (1, 1, 1, 11), (2, 2, 0, 20)]


def test_pixels_without_a_cell_or_item_go_before_the_clip(spark):
    pixels, items, cells, days = _tables(spark)
    of_items = spatial.pixels_of_items(pixels, items, spatial.cells_of_days(cells, days))
    kept = {(r.item_id, r.y) for r in of_items.collect()}
    assert kept == {(1, 0), (1, 1), (2, 0), (3, 0), (3, 1)}


def test_a_cell_meets_pixels_of_its_parcels_footprints_only(spark):
    pixels, items, cells, days = _tables(spark)
    reached = spatial.cells_of_days(cells, days)
    clipped = spatial.clip_pixels(pixels.join(items, "item_id"), reached)
    # Parcel 2 has no day with footprint 7, so the pixels of scenes 1 and 3 do not meet it.
    assert {r.item_id for r in clipped.where("parcel_key = 2").collect()} == {2}


def test_days_and_months_are_merged_not_broadcast(spark):
    """As files they are small; in memory the driver could not build their hash tables."""
    pixels, items, cells, days = _tables(spark)

    def last_join(df):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        return next(line for line in plan.splitlines() if "Join" in line)

    assert "SortMergeJoin" in last_join(matched_pixels(pixels, cells, items, days))
    matches = spark.sql("SELECT 1L AS parcel_key, 7L AS footprint_id, date'2000-01-01' AS start, date'2000-03-01' AS end")
    assert "SortMergeJoin" in last_join(spatial.join_parcel_scene(matches, items))


def test_rejected_ndvi_computes_its_cube_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(value):
        seen.add(1)
        return value

    cube = spark.createDataFrame(
        [("p", "a", "r", 1, y, 0, 0.1, 0.3, 8) for y in range(4)],
        "parcel_id string, source_file string, date_range string, parcel_key long, y long, x long,"
        " red double, nir double, scl long",
    ).withColumns({"time": F.lit("2000-01-01 10:00:00").cast("timestamp_ntz"), "red": F.udf(count, "double")("red")})
    cube = cube.withColumn("time", F.when(F.col("red") > 0, F.col("time")))
    rows = rejected_ndvi(cube).collect()
    assert [r.n_dates for r in rows] == [1] * 4
    assert all(math.isclose(r.NDVI, 0.5) for r in rows)
    assert seen.value == 4


def test_pairs_of_parcels_and_scenes_come_list_by_list(spark, monkeypatch):
    monkeypatch.setattr(spatial, "LISTED", 8, raising=False)
    # Rows that come twice, parcels with dates of their own, a missing date, a footprint without a partner.
    matches = spark.range(60).selectExpr(
        "id % 50 AS parcel_key", "if(id % 5 = 0, 8L, 7L) AS footprint_id", "if(id = 9, NULL, date'2000-01-01') AS start",
        "date_add(date'2000-01-10', cast(id % 3 AS int) * 20) AS end",
    )
    items = spark.range(200).selectExpr(
        "id % 190 AS item_id", "if(id % 7 = 0, 9L, 7L) AS footprint_id",
        "if(id = 3, NULL, date_add(date'2000-01-01', cast(id % 4 AS int) * 15)) AS utc_day", "id * 0.5 AS scale",
    )
    rows = spatial.join_parcel_scene(matches, items).coalesce(1)
    assert set(rows.columns) == {"parcel_key", "start", "end", "item_id", "utc_day", "scale"}
    plain = matches.join(items, "footprint_id").where("utc_day BETWEEN start AND end").select(*rows.columns)
    got = rows.collect()
    assert sorted(got) == sorted(plain.collect()) and len(got) > 2000
    # A parcel's rows change places with others' after a list of scenes; they compress better so.
    changes = sum(a.parcel_key != b.parcel_key for a, b in zip(got, got[1:]))
    assert changes > len(got) / 40


def joins_on_parcels(df):
    """The joins on the key of a parcel in the plan that Catalyst starts with."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return [line for line in plan.splitlines() if "Join [parcel_key#" in line]


def test_cells_and_days_with_a_scale_are_not_broadcast(spark):
    """As files they are small, and a broadcast that was planned is kept at any size."""
    pixels, items, cells, days = _tables(spark)
    assert ["SortMergeJoin" in j for j in joins_on_parcels(spatial.cells_of_days(cells, days))] == [True]
    day = F.lit("2000-01-01").cast("timestamp_ntz")
    held = hold(days.withColumns({"datetime": day, "item_id": F.lit(1), "scale": F.lit(0.5), "offset": F.lit(1.0)}), "days")
    parcels = spark.createDataFrame(
        [(k, [[(0.0, 0.0), (1.0, 0.0), (1.0, 2.0), (0.0, 2.0)]]) for k in (1, 2)],
        f"parcel_key long, rings {RINGS.simpleString()}",
    )
    found = Search(hold(parcels, "parcels"), items.withColumn("item_seq", F.col("item_id")), held, "rings", None)
    values = pixels.withColumns({"nir": F.lit(7), "scl": F.lit(4)})
    cube = spectral_cube(values, found, held, Grid(1), ["red"])
    joins = joins_on_parcels(cube)
    assert len(joins) >= 4 and all("SortMergeJoin" in j for j in joins)
    assert sorted((r.parcel_key, r.y, r.red) for r in cube.collect()) == [(1, 0, 6.0), (1, 1, 6.5), (2, 0, 11.0), (2, 1, 11.5)]


def test_stamps_are_not_broadcast(spark):
    days = spark.sql(
        "SELECT 1L AS parcel_key, date'2000-01-01' AS solar_day, timestamp_ntz'2000-01-01 10:00:00' AS datetime"
        " UNION ALL SELECT 1L, date'2000-01-01', timestamp_ntz'2000-01-01 09:00:00'"
    )
    # Two rows of one parcel give two rows each, a cell without a day or a parcel none.
    parcels = spark.createDataFrame(
        [(1, "a", "f", "r"), (1, None, "g", "r"), (2, "b", "f", "r")],
        "parcel_key long, parcel_id string, source_file string, date_range string",
    )
    cells = spark.sql("SELECT * FROM VALUES (1L, date'2000-01-01', 5L, 6L), (2L, date'2000-01-01', 5L, 6L) t(parcel_key, solar_day, y, x)")
    shown = series.stamp(hold(cells, "cells"), hold(days, "days"), hold(parcels, "parcels"))
    assert shown.columns == ["parcel_key", "solar_day", "y", "x", "time", *series.PROVENANCE]
    got = {(r.parcel_key, r.y, str(r.time), r.parcel_id, r.source_file) for r in shown.collect()}
    assert got == {(1, 5, "2000-01-01 09:00:00", k, f) for k, f in (("a", "f"), (None, "g"))}
    joins = joins_on_parcels(shown)
    assert len(joins) == 2 and all("SortMergeJoin" in j for j in joins)


def test_rows_of_rejected_ndvi_are_not_broadcast(spark):
    cube = spark.createDataFrame(
        [("p", "a", "r", k, y, 0, 0.1, 0.3, 8) for k in (1, 2) for y in range(k)],
        "parcel_id string, source_file string, date_range string, parcel_key long, y long, x long,"
        " red double, nir double, scl long",
    ).withColumn("time", F.date_add(F.lit("2000-01-01"), F.col("y").cast("int")).cast("timestamp_ntz"))
    shown = rejected_ndvi(cube)
    assert ["SortMergeJoin" in j for j in joins_on_parcels(shown)] == [True]
    assert sorted((r.parcel_key, r.n_dates) for r in shown.collect()) == [(1, 1), (2, 2), (2, 2)]


def test_parcels_without_a_result_are_merged(spark):
    """Days and points of all parcels are many rows, however small they are as files."""
    names = ["parcel_key", *series.PROVENANCE]
    parcels = spark.createDataFrame([(k, str(k), "f", "r") for k in range(4)], names)
    frames = [spark.range(n).withColumnRenamed("id", "parcel_key") for n in (3, 2, 1)]
    failed = faults.without_result(parcels, *(hold(f.unionAll(f), "keys") for f in frames))
    joins = joins_on_parcels(failed)
    assert len(joins) == 3 and all("SortMergeJoin" in j for j in joins)
    reasons = [(1, faults.NO_INDEX), (2, faults.NO_USABLE_DAY), (3, faults.NO_SCENE)]
    assert sorted((r.parcel_key, r.reason) for r in failed.collect()) == reasons


@pytest.mark.parametrize("utc", [False, True])
def test_usable_days_are_merged(spark, utc):
    """Held, they are few bytes; a row that comes twice or without a key changes nothing."""
    days = spark.sql(
        "SELECT cast(nullif(id, 3) AS bigint) AS parcel_key, date'2000-01-01' AS solar_day, date'2000-01-01' AS utc_day,"
        " timestamp_ntz'2000-01-01 10:00:00' AS datetime FROM range(4)"
    )
    usable = hold(days.where("parcel_key = 2 OR parcel_key IS NULL").select("parcel_key", "solar_day"), "usable")
    usable = usable.unionAll(usable)
    kept = clarity.keep_usable(hold(days, "days"), usable, utc)
    none = clarity.rejected(days.select("parcel_key"), hold(days, "days"), usable)
    for df in (kept, none, clarity.without_scene(days, hold(days, "days"))):
        joins = joins_on_parcels(df)
        assert joins and all("SortMergeJoin" in j for j in joins)
    assert [r.parcel_key for r in kept.collect()] == [2]
    assert sorted(r.parcel_key for r in none.collect()) == [0, 1]


def test_pairs_of_one_footprint_and_month_are_listed_by_many_tasks(spark, monkeypatch):
    """The lists are few bytes, the pairs many rows."""
    monkeypatch.setattr(spatial, "LISTED", 8)
    matches = spark.range(200).selectExpr(
        "id AS parcel_key", "7L AS footprint_id", "date'2000-01-01' AS start", "date'2000-01-31' AS end"
    )
    items = spark.range(300).selectExpr("id AS item_id", "7L AS footprint_id", "date'2000-01-05' AS utc_day")
    pairs = spatial.join_parcel_scene(hold(matches, "matches"), hold(items, "items"))
    rows = pairs.select("parcel_key", "item_id", F.spark_partition_id().alias("task"))
    got = rows.collect()
    assert len({(r.parcel_key, r.item_id) for r in got}) == len(got) == 200 * 300
    assert len({r.task for r in got}) > 1
