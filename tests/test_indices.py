import math

import pytest
from pyspark.sql import functions as F

from parcelpulse.functions import indices as ix
from parcelpulse.schema import INDICES, bands_for

# Literal pixels and the value the index must have.
CASES = [
    ("NDVI", {"nir": 0.75, "red": 0.15}, 2 / 3),
    ("NDVI", {"nir": 0.42, "red": 0.42}, 0.0),
    ("NDWI", {"green": 0.1, "nir": 0.7}, -0.75),
    ("SAVI", {"nir": 0.7, "red": 0.3}, 0.4),
    ("NBR", {"nir": 0.64, "swir16": 0.16}, 0.6),
    ("NDBI", {"swir16": 0.16, "nir": 0.64}, -0.6),
    ("NDRE1", {"nir": 0.45, "rededge1": 0.15}, 0.5),
    ("NDRE2", {"nir": 0.27, "rededge2": 0.27}, 0.0),
    ("NDRE3", {"nir": 0.12, "rededge3": 0.28}, -0.4),
]


@pytest.mark.parametrize("name, bands, value", CASES)
def test_formula(spark, name, bands, value):
    df = spark.createDataFrame([tuple(bands.values())], list(bands))
    assert ix.add_indices(df, [name]).first()[name] == pytest.approx(value, abs=1e-12)


def expected(index, plus, minus):
    """Ratio with the convention for an empty denominator: none for 0/0, else infinite."""
    top, bottom = plus - minus, plus + minus + index.soil
    if bottom == 0:
        return None if top == 0 else math.copysign(math.inf, top)
    return top / bottom * (1 + index.soil)


def test_every_index_over_all_kinds_of_reflectance(spark):
    """Zeros, equal bands, negative and saturated reflectances: exact values, swapping turns the sign,
    and without soil and negative values no ratio leaves -1..1."""
    levels = [-0.25, -0.1, 0.0, 0.001, 0.25, 0.5, 1.0, 1.6]
    pairs = [(a, b) for a in levels for b in levels]
    for name, index in INDICES.items():
        rows = [(a, b, b, a) for a, b in pairs]
        df = spark.createDataFrame(rows, [index.plus, index.minus, "other_plus", "other_minus"])
        values = [r[name] for r in ix.add_indices(df, [name]).collect()]
        swapped = df.select(F.col("other_plus").alias(index.plus), F.col("other_minus").alias(index.minus))
        turned = [r[name] for r in ix.add_indices(swapped, [name]).collect()]
        for (a, b), value, other in zip(pairs, values, turned, strict=True):
            assert value == pytest.approx(expected(index, a, b), abs=1e-12)
            assert (value is None) == (other is None)
            if value is not None and not index.soil:
                assert other == pytest.approx(-value, abs=1e-12)
                assert min(a, b) < 0 or -1 <= value <= 1


def test_zero_denominators(spark):
    rows = [(0.0, 0.0), (0.5, -0.5), (-0.5, 0.5)]
    out = ix.add_indices(spark.createDataFrame(rows, ["nir", "red"]), ["NDVI"])
    assert [r["NDVI"] for r in out.collect()] == [None, math.inf, -math.inf]


def test_only_requested_and_possible_in_fixed_order(spark):
    df = spark.createDataFrame([(0.6, 0.1, 0.2)], ["nir", "red", "green"])
    out = ix.add_indices(df, ["NDRE1", "SAVI", "NDWI", "NDVI"])
    assert out.columns == ["nir", "red", "green", "NDVI", "NDWI", "SAVI"]
    assert ix.add_indices(df.drop("nir"), ["NDVI"]).columns == ["red", "green"]


def test_missing_index_is_named(spark):
    df = spark.createDataFrame([(0.6,)], ["nir"])
    with pytest.raises(ValueError, match="swir16"):
        ix.require_indices(df, ["NBR"])


@pytest.mark.parametrize(
    "names, extra",
    [
        (["NDVI"], []),
        (["NBR"], ["swir16"]),
        (["NDBI", "NDRE3"], ["swir16", "rededge3"]),
        (list(INDICES), ["swir16", "rededge1", "rededge2", "rededge3"]),
    ],
)
def test_bands_for(names, extra):
    assert bands_for(names) == ["red", "green", "blue", "nir", *extra]


@pytest.mark.parametrize("offset, value", [(0.0, 1.0), (-0.1, 0.9)])
def test_scaling_leaves_class_alone(spark, offset, value):
    df = spark.createDataFrame(
        [(10000, 4, 0.0001, offset)], ["red", "scl", "scale", "offset"]
    )
    row = ix.scale_bands(df, ["red"]).first()
    assert row["red"] == pytest.approx(value) and row["scl"] == 4


def test_mask_keeps_rows_and_unclear_becomes_missing(spark):
    df = spark.createDataFrame([(s, 7.0) for s in (0, 3, 4, 5, 8)], ["scl", "red"])
    out = {r["scl"]: r["red"] for r in ix.mask_clear(df, ["red"]).collect()}
    assert out == {0: None, 3: None, 4: 7.0, 5: 7.0, 8: None}
