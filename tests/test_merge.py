"""First non-null merge, union, anti-join, coordinates, coverage, quality."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from conftest import OBS, rows, ts

from tidewright.operators import enrich, merge, quality
from tidewright.operators.merge import absent_rows, first_non_null, first_row, union_sources


def test_first_non_null_per_column(spark):
    df = spark.createDataFrame(
        [
            ("a", ts("2024-01-01"), 0, 1, None, 5.0),
            ("a", ts("2024-01-01"), 1, 1, 2.0, 6.0),
            ("a", ts("2024-01-02"), 0, 2, 3.0, None),
            ("a", None, 0, 3, 9.0, 9.0),
        ],
        "station_id string, datetime timestamp_ntz, src int, line_no int, wave_height double, dominant_period double",
    )
    want = [("a", ts("2024-01-01"), 2.0, 5.0), ("a", ts("2024-01-02"), 3.0, None)]
    for shuffled in (df, df.orderBy("line_no"), df.repartition(7)):
        assert rows(first_non_null(shuffled, ["src", "line_no"])) == want


def test_first_non_null_agrees_with_pandas(spark):
    rng = np.random.default_rng(1)
    n = 3000
    pdf = pd.DataFrame(
        {
            "station_id": rng.integers(0, 5, n).astype(str),
            "datetime": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 200, n), unit="h"),
            "line_no": np.arange(n),
            "wave_height": np.where(rng.random(n) < 0.5, np.nan, rng.random(n)),
            "average_period": np.where(rng.random(n) < 0.9, np.nan, rng.random(n)),
        }
    )
    want = pdf.groupby(["station_id", "datetime"])[["wave_height", "average_period"]].first().reset_index()
    records = [
        (r.station_id, r.datetime.to_pydatetime(), int(r.line_no), *(None if v != v else float(v) for v in (r.wave_height, r.average_period)))
        for r in pdf.sample(frac=1, random_state=2).itertuples()
    ]
    sdf = spark.createDataFrame(
        records,
        "station_id string, datetime timestamp_ntz, line_no int, wave_height double, average_period double",
    )
    got = first_non_null(sdf, ["line_no"]).toPandas().sort_values(["station_id", "datetime"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_equal_order_keys_still_give_one_result(spark):
    df = spark.createDataFrame(
        [("a", ts("2024-01-01"), 0, float(v)) for v in range(20)],
        "station_id string, datetime timestamp_ntz, src int, wave_height double",
    )
    got = {first_non_null(df.repartition(p), ["src"]).first()["wave_height"] for p in (1, 3, 9)}
    assert got == {0.0}


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([("x", 1.0)], "station_id string, wave_height double")
    b = spark.createDataFrame([("y", 2.0)], "station_id string, average_period double")
    assert rows(union_sources(a, b)) == [("x", 1.0, None), ("y", None, 2.0)]


def test_absent_rows_and_first_row(spark):
    schema = "station_id string, datetime timestamp_ntz, n int"
    new = spark.createDataFrame([("a", ts("2024-01-01"), 2), ("a", ts("2024-01-01"), 1), ("b", ts("2024-01-01"), 3)], schema)
    old = spark.createDataFrame([("b", ts("2024-01-01"), 0)], schema)
    kept = first_row(new, ["n"])
    assert rows(kept) == [("a", ts("2024-01-01"), 1), ("b", ts("2024-01-01"), 3)]
    assert rows(absent_rows(kept, old)) == [("a", ts("2024-01-01"), 1)]


def test_coordinates_come_from_the_station_when_one_is_missing(spark):
    obs = spark.createDataFrame(
        [
            ("123", ts("2024-12-15 12:30"), None, None, 1.5, 8.0, 10.0, None),
            ("123", ts("2024-12-15 13:30"), 1.0, None, 1.5, 8.0, 10.0, None),
            ("123", ts("2024-12-15 14:30"), 1.0, 2.0, 1.5, 8.0, 10.0, None),
            ("999", ts("2024-12-15 12:30"), None, None, 1.5, 8.0, 10.0, None),
            ("999", ts("2024-12-15 13:30"), 3.0, 4.0, 1.5, 8.0, 10.0, None),
        ],
        OBS,
    )
    st = spark.createDataFrame([("123", 35.0, -120.5), ("678", 36.0, -121.5)], "station_id string, latitude double, longitude double")
    got = rows(enrich.enrich_coordinates(obs, st).select("station_id", "datetime", "latitude", "longitude"))
    assert got == [
        ("123", ts("2024-12-15 12:30"), 35.0, -120.5),
        ("123", ts("2024-12-15 13:30"), 35.0, -120.5),
        ("123", ts("2024-12-15 14:30"), 1.0, 2.0),
        ("999", ts("2024-12-15 13:30"), 3.0, 4.0),
    ]


def test_coverage(spark):
    schema = "station_id string, latitude double, longitude double"
    listed = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 4.0)], schema)
    stored = spark.createDataFrame([("a", 1.5, 2.5), ("c", 0.0, 0.0)], schema)
    assert rows(enrich.station_coverage(listed, stored)) == [
        ("a", 1.5, 2.5, "with_met"),
        ("b", 3.0, 4.0, "without_met"),
    ]


def test_first_stations(spark):
    df = spark.createDataFrame([(str(i % 15),) for i in range(60)], "station_id string")
    assert [r[0] for r in enrich.first_stations(df, 3).collect()] == ["0", "1", "10"]


def test_quality_metrics(spark):
    obs = spark.createDataFrame(
        [
            ("station_1", ts("2024-01-01"), 34.0, -118.0, 1.5, 10.0, 9.0, 180.0),
            ("station_2", ts("2024-01-02"), 35.0, -119.0, None, 10.0, None, None),
        ],
        OBS,
    )
    row = quality.quality_metrics(obs).first()
    assert (row["record_count"], row["stations_count"]) == (2, 2)
    assert (row["min_datetime"], row["max_datetime"]) == (ts("2024-01-01"), ts("2024-01-02"))
    assert row["missing_data_pct"] == pytest.approx(100 / 3)
    empty = quality.quality_metrics(obs.where("false")).first()
    assert (empty["record_count"], empty["stations_count"], empty["missing_data_pct"]) == (0, 0, None)


def test_row_validation(spark):
    df = spark.createDataFrame(
        [("a", "2024-12-15 12:30:00", 1.0, 2.0, "NNE"), ("a", "nonsense", 1.0, 2.0, "3"), (None, "2024-12-15", 1.0, 2.0, "3")],
        "station_id string, datetime string, latitude double, longitude double, mean_wave_direction string",
    )
    good, rejects = quality.split_valid(df)
    row = good.first()
    assert good.count() == 1 and row["mean_wave_direction"] is None and row["datetime"] == ts("2024-12-15 12:30")
    assert rejects.count() == 2


def test_single_frame(spark):
    df = spark.createDataFrame(
        [("a", ts("2024-01-01"), 1, None, 1.0), ("a", ts("2024-01-01"), 2, 4.0, 2.0)],
        "station_id string, datetime timestamp_ntz, n int, wave_height double, dominant_period double",
    )
    assert rows(merge.single_frame_first(df, ["n"])) == [("a", ts("2024-01-01"), 4.0, 1.0)]
