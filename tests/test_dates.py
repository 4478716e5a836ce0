from datetime import date, datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelpulse.functions import dates


def chunks(spark, ranges):
    df = spark.createDataFrame(
        [(i, date.fromisoformat(a), date.fromisoformat(b)) for i, (a, b) in enumerate(ranges)],
        "id int, start date, end date",
    )
    rows = dates.split_date_range(df).orderBy("id", "chunk_idx").collect()
    out = [[] for _ in ranges]
    for r in rows:
        out[r["id"]].append((r["chunk_start"].isoformat(), r["chunk_end"].isoformat()))
    return out


def test_known_ranges(spark):
    leap, single, backward, two, long = chunks(
        spark,
        [
            ("2012-02-29", "2013-02-27"),  # 365 days from a leap day on
            ("2031-11-30", "2031-11-30"),
            ("2031-12-01", "2031-11-30"),
            ("2012-02-29", "2013-03-05"),
            ("2008-05-05", "2013-05-05"),
        ],
    )
    assert leap == [("2012-02-29", "2013-02-27")]
    assert single == [("2031-11-30", "2031-11-30")]
    assert backward == []
    assert two == [("2012-02-29", "2013-02-28"), ("2013-03-01", "2013-03-05")]
    assert len(long) == 5 and long[0][0] == "2008-05-05" and long[-1][1] == "2013-05-05"


day = st.dates(date(2000, 1, 1), date(2035, 1, 1))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(day, st.integers(0, 3000)), min_size=1, max_size=20))
def test_chunks_tile_the_range(spark, spans):
    ranges = [(a.isoformat(), (a + timedelta(n)).isoformat()) for a, n in spans]
    for (start, end), parts in zip(ranges, chunks(spark, ranges)):
        assert parts[0][0] == start and parts[-1][1] == end
        for (_, last), (first, _) in zip(parts, parts[1:]):
            assert date.fromisoformat(first) == date.fromisoformat(last) + timedelta(1)
        assert all(
            (date.fromisoformat(b) - date.fromisoformat(a)).days <= 365 for a, b in parts
        )


def test_solar_day_moves_with_longitude(spark):
    rows = [
        (datetime(2024, 5, 1, 0, 10), -6.0),
        (datetime(2024, 5, 1, 0, 30), -6.0),
        (datetime(2024, 5, 1, 23, 30), 9.0),
        (datetime(2024, 5, 1, 12, 0), 170.0),
    ]
    df = spark.createDataFrame(rows, "t timestamp_ntz, lon double")
    out = df.select(dates.solar_day(F.col("t"), F.col("lon")).alias("d"))
    assert [r["d"].isoformat() for r in out.collect()] == [
        "2024-04-30", "2024-05-01", "2024-05-02", "2024-05-01",
    ]


@pytest.mark.parametrize(
    "name, ok",
    [
        ("2024-04-01_2024-09-30", True),
        ("_2024-04-01_2024-09-30", False),
        ("_2024-04-01", False),
        ("a_2024-04-01_2024-09-30", False),
        ("north_south", False),
        ("2024-04-01", False),
    ],
)
def test_folder_names(spark, name, ok):
    start, end = dates.parse_date_range(F.lit(name))
    row = spark.range(1).select(start.alias("s"), end.alias("e")).first()
    assert (row["s"] is not None and row["e"] is not None) == ok
    if ok:
        text = spark.range(1).select(
            dates.format_date_range(F.lit(row["s"]), F.lit(row["e"])).alias("n")
        )
        assert text.first()["n"] == name
