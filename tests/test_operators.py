from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from parcelpulse.operators import catalogue, clarity, mosaic, series, spatial
from parcelpulse.schema import RINGS, Grid

D1, D2 = date(2024, 5, 1), date(2024, 5, 2)


def cells(spark, rows):
    return spark.createDataFrame(
        rows,
        "parcel_key long, solar_day date, y long, x long, item_seq long, red long, scl long,"
        " scale double, offset double",
    )


def test_mosaic_takes_first_valid_value_per_band(spark):
    df = cells(
        spark,
        [
            (1, D1, 0, 0, 5, 70, 4, 1.0, 0.0),
            (1, D1, 0, 0, 3, 0, 8, 1.0, 0.0),
            (1, D1, 0, 0, 4, 60, 5, 1.0, 0.0),
            (1, D1, 0, 1, 1, 0, 0, 1.0, 0.0),
        ],
    )
    out = {r["x"]: (r["red"], r["scl"]) for r in mosaic.solar_day_mosaic(df, ["red", "scl"]).collect()}
    assert out == {0: (60, 8), 1: (0, 0)}


def test_repeated_samples_follow_px_seq(spark):
    df = cells(
        spark,
        [(1, D1, 0, 0, 3, v, 4, 1.0, 0.0) for v in (30, 10, 20)],
    ).withColumn("px_seq", F.when(F.col("red") == 20, 1).otherwise(2))
    assert mosaic.solar_day_mosaic(df, ["red"]).first()["red"] == 20


def test_reflectance_fill_is_the_offset(spark):
    df = cells(
        spark,
        [
            (1, D1, 0, 0, 1, 0, 4, 0.5, -0.1),
            (1, D1, 0, 1, 1, 0, 4, 0.5, -0.1),
            (1, D1, 0, 1, 2, 10, 5, 0.25, 1.0),
        ],
    )
    out = {r["x"]: r for r in mosaic.reflectance_mosaic(df, ["red"], ["scl"]).collect()}
    assert out[0]["red"] == pytest.approx(-0.1)
    assert out[1]["red"] == pytest.approx(3.5) and out[1]["scl"] == 4


def test_first_item_scale_follows_order(spark):
    noon, later = datetime(2024, 5, 1, 12), datetime(2024, 5, 1, 13)
    df = spark.createDataFrame(
        [(1, later, "a", 0.1, 1.0), (1, noon, "c", 0.3, 3.0), (1, noon, "b", 0.2, 2.0)],
        "parcel_key long, datetime timestamp_ntz, item_id string, scale double, offset double",
    )
    assert tuple(mosaic.first_item_scale(df).first()) == (1, 0.2, 2.0)


def class_rows(spark, per_day):
    rows = [
        (1, d, 0, x, 1, 1, s, 1.0, 0.0) for d, classes in per_day for x, s in enumerate(classes)
    ]
    return cells(spark, rows)


def test_clear_ratio_and_limit(spark):
    df = class_rows(
        spark,
        [(D1, [4, 5, 8, 0]), (D2, [4, 8]), (date(2024, 5, 3), [0, 0])],
    )
    ratios = clarity.clear_ratio(df)
    by_day = {r["solar_day"]: r["clear_ratio"] for r in ratios.collect()}
    assert by_day[D1] == pytest.approx(2 / 3)
    assert by_day[D2] == 0.5 and by_day[date(2024, 5, 3)] is None
    assert [r["solar_day"] for r in clarity.usable_days(ratios).collect()] == [D1]


def test_clear_summary_counts_dates_without_pixels(spark):
    ratios = spark.createDataFrame(
        [(1, D1, 0.75), (1, D2, 0.25)], "parcel_key long, solar_day date, clear_ratio double"
    )
    days = spark.createDataFrame(
        [(1, D1), (1, D1), (1, D2), (1, date(2024, 5, 3)), (2, D1)],
        "parcel_key long, solar_day date",
    )
    out = {r["parcel_key"]: tuple(r)[1:] for r in clarity.clear_summary(ratios, days).collect()}
    assert out == {1: (1, 3, 0.75, 0.75), 2: (0, 1, 0.0, None)}


def test_utc_day_match_loses_items_of_the_next_utc_day(spark):
    """One solar day whose items lie on two UTC days."""
    items = spark.createDataFrame(
        [
            (1, D1, D1, "a", datetime(2024, 5, 1, 23, 50)),
            (1, D1, D2, "b", datetime(2024, 5, 2, 0, 10)),
        ],
        "parcel_key long, solar_day date, utc_day date, item_id string, datetime timestamp_ntz",
    )
    usable = spark.createDataFrame([(1, D1)], "parcel_key long, solar_day date")
    both = clarity.keep_usable(items, usable)
    one = clarity.keep_usable(items, usable, utc_day_match=True)
    assert {r["item_id"] for r in both.collect()} == {"a", "b"}
    assert {r["item_id"] for r in one.collect()} == {"a"}


def test_cloud_limit_is_strict_and_needs_the_property(spark):
    df = spark.createDataFrame(
        [("a", 79.9), ("b", 80.0), ("c", None)], "item_id string, cloud_cover double"
    )
    assert [r["item_id"] for r in catalogue.filter_cloud_cover(df).collect()] == ["a"]


def test_date_filter_includes_the_whole_end_day(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 5, 1),), (datetime(2024, 5, 2, 23, 59, 59),), (datetime(2024, 5, 3),)],
        "datetime timestamp_ntz",
    )
    assert catalogue.filter_date_range(df, "2024-05-01", "2024-05-02").count() == 2


@pytest.mark.parametrize(
    "assets, expected",
    [
        ('{"red":{"raster:bands":[{"scale":0.5,"offset":-1}]}}', (0.5, -1.0)),
        ('{"red":{"raster:bands":[{}]}}', (0.0001, 0.0)),
        ('{"red":{"raster:bands":[]}}', (0.0001, 0.0)),
        ('{"red":{}}', (0.0001, 0.0)),
        (None, (0.0001, 0.0)),
    ],
)
def test_item_scale(spark, assets, expected):
    df = spark.createDataFrame([(assets,)], "assets string")
    assert tuple(df.select(*catalogue.item_scale(F.col("assets"))).first()) == expected


def test_item_seq_is_a_total_order(spark):
    rows = [(i, datetime(2024, 1, 1 + (i * 7) % 20)) for i in range(200)]
    df = spark.createDataFrame(rows, "item_id long, datetime timestamp_ntz").repartition(7)
    out = catalogue.with_item_seq(df).orderBy("item_seq").collect()
    keys = [(r["datetime"], r["item_id"]) for r in out]
    assert keys == sorted(keys) and len({r["item_seq"] for r in out}) == 200


def test_drop_all_null_keeps_infinity(spark):
    df = spark.createDataFrame(
        [(1, None, None), (2, 0.5, None), (3, None, float("inf"))],
        "k int, NDVI double, NBR double",
    )
    kept = series.drop_all_null(df, ["NDVI", "NBR"]).collect()
    assert {r["k"] for r in kept} == {2, 3}
    with pytest.raises(ValueError, match="NDRE1"):
        series.drop_all_null(df, ["NDRE1"])


def test_concat_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, 0.1)], ["k", "NDVI"])
    b = spark.createDataFrame([(2, 0.2)], ["k", "NBR"])
    rows = series.concat_results([a, b]).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, 0.1, None), (2, None, 0.2)]


def test_parcel_column_is_the_first_that_fits():
    assert series.parcel_column(["time", "NDVI", "parcel_id", "source_file"]) == "parcel_id"
    with pytest.raises(ValueError):
        series.parcel_column(["time", "NDVI"])


def test_resample_nearest_at_negative_cells(spark):
    fine = spark.createDataFrame(
        [(1, y, x) for y in (-2, -1, 0, 1) for x in (0, 1)], "item_id long, y long, x long"
    )
    coarse = spark.createDataFrame(
        [(1, -1, 0, 8), (1, 0, 0, 4)], "item_id long, y long, x long, scl long"
    )
    out = spatial.resample_nearest(fine, coarse, Grid(10), Grid(20), ["scl"])
    assert {(r["y"], r["x"]): r["scl"] for r in out.collect()} == {
        (y, x): 8 if y < 0 else 4 for y in (-2, -1, 0, 1) for x in (0, 1)
    }


def test_bbox_filter_counts_touching(spark):
    def box(x, y):
        return [[(x, y), (x + 1.0, y), (x + 1.0, y + 1.0), (x, y + 1.0)]]

    rows = [("in", box(2.0, 2.0)), ("touch", box(5.0, 5.0)), ("out", box(5.1, 2.0)), ("none", None)]
    df = spark.createDataFrame(rows, f"item_id string, rings {RINGS.simpleString()}")
    kept = catalogue.filter_bbox(df, 1.0, 1.0, 5.0, 5.0).collect()
    assert {r["item_id"] for r in kept} == {"in", "touch"}


def test_window_cells_are_padded_bounds(spark):
    ring = [(0.0, 0.0), (20.0, 0.0), (20.0, 10.0)]
    df = spark.createDataFrame([(1, [ring])], f"parcel_key long, rings {RINGS.simpleString()}")
    plain = {(r["y"], r["x"]) for r in spatial.window_cells(df, Grid(10)).collect()}
    padded = {(r["y"], r["x"]) for r in spatial.window_cells(df, Grid(10), 10).collect()}
    assert plain == {(0, 0), (0, 1)}
    assert padded == {(y, x) for y in (-1, 0, 1) for x in (-1, 0, 1, 2)}
