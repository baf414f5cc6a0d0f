"""Lag features, last rows, forecast."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from conftest import rows, ts

from tidewright.operators import forecast, lagged
from tidewright.plans.jobs import forecast_job
from tidewright.schemas import MEASURES

SERIES = "station_id string, datetime timestamp_ntz, " + ", ".join(f"{m} double" for m in MEASURES)


def series(spark, n=1500, seed=4, nulls=0.05):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame(
        {
            "station_id": rng.choice(["a", "b", "c"], n, p=[0.8, 0.15, 0.05]),
            "datetime": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.permutation(n) * 97, unit="m"),
        }
    )
    for m in MEASURES:
        pdf[m] = np.where(rng.random(n) < nulls, np.nan, rng.normal(size=n).round(3))
    data = [
        tuple(None if v != v else (v.to_pydatetime() if isinstance(v, pd.Timestamp) else v) for v in r)
        for r in pdf.itertuples(index=False)
    ]
    return pdf, spark.createDataFrame(data, SERIES)


@pytest.mark.parametrize("bucket", ["day", "hour", "month"])
@pytest.mark.parametrize("per_station", [True, False])
def test_lags_agree_with_shift(spark, per_station, bucket):
    pdf, sdf = series(spark)
    pdf = pdf.sort_values(["datetime", "station_id"]).reset_index(drop=True)
    shifted = (pdf.groupby("station_id") if per_station else pdf)[MEASURES].shift(1)
    want = pdf.join(shifted.add_suffix("_lag1"))
    got = lagged.lag_features(sdf, per_station=per_station, bucket=bucket, complete=False).toPandas()
    got = got.sort_values(["datetime", "station_id"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want[got.columns], check_dtype=False)
    complete = lagged.lag_features(sdf, per_station=per_station, bucket=bucket)
    assert complete.count() == len(want.dropna())


def test_lag_does_not_cross_stations(spark):
    data = [(s, ts(f"2024-01-0{d}"), float(v), 1.0, 1.0, 1.0) for d in range(1, 4) for v, s in ((d, "a"), (-d, "b"))]
    got = lagged.lag_features(spark.createDataFrame(data, SERIES))
    assert rows(got.select("station_id", "wave_height", "wave_height_lag1")) == [
        ("a", 2.0, 1.0), ("a", 3.0, 2.0), ("b", -2.0, -1.0), ("b", -3.0, -2.0),
    ]


@pytest.mark.parametrize("bucket", ["day", "hour", "year"])
def test_lags_of_null_stations_null_times_and_ties(spark, bucket):
    """NULLs come first and are a station of their own; ties follow the measures. The slots do not show."""
    data = [
        (None, ts(f"2024-01-0{d}"), float(d), None, None, None) for d in range(1, 5)
    ] + [
        ("a", None, 9.0, None, None, None), ("a", ts("2024-01-01"), 2.0, None, None, None),
        ("a", ts("2024-01-01"), 1.0, None, None, None), ("a", ts("2024-02-01"), 5.0, None, None, None),
    ]
    df = spark.createDataFrame(data, SERIES)
    got = lagged.lag_features(df, bucket=bucket, complete=False)
    lag = {(r["station_id"], r["wave_height"]): r["wave_height_lag1"] for r in got.collect()}
    assert lag == {
        (None, 1.0): None, (None, 2.0): 1.0, (None, 3.0): 2.0, (None, 4.0): 3.0,
        ("a", 9.0): None, ("a", 1.0): 9.0, ("a", 2.0): 1.0, ("a", 5.0): 2.0,
    }
    last = {r["station_id"]: r["wave_height"] for r in lagged.latest_per_station(df.where("wave_height <> 5")).collect()}
    assert last == {None: 4.0, "a": 2.0}


def test_no_training_rows_no_model(spark):
    df = spark.createDataFrame([("a", ts("2024-01-01"), 1.0, 1.0, 1.0, 1.0)], SERIES)
    with pytest.raises(ValueError, match="training"):
        forecast_job(df)


def test_last_rows(spark):
    pdf, sdf = series(spark)
    want = pdf.sort_values("datetime").groupby("station_id").tail(1).sort_values("station_id")
    got = lagged.latest_per_station(sdf).toPandas().sort_values("station_id")
    assert list(got["datetime"]) == list(want["datetime"])
    np.testing.assert_array_equal(got[MEASURES].to_numpy(float), want[MEASURES].to_numpy(float))
    assert lagged.latest_overall(sdf).first()["datetime"] == pdf["datetime"].max().to_pydatetime()


def least_squares(features: pd.DataFrame):
    x = np.column_stack([np.ones(len(features)), features[lagged.lag_names()].to_numpy(float)])
    return np.linalg.lstsq(x, features["wave_height"].to_numpy(float), rcond=None)[0]


def test_model_and_error_agree_with_least_squares(spark):
    _, sdf = series(spark)
    features = lagged.lag_features(sdf).withColumn("is_test", forecast.is_test_row())
    pdf = features.toPandas()
    assert 0.15 < pdf["is_test"].mean() < 0.25
    model, evaluation = forecast.train_and_evaluate(lagged.lag_features(sdf))
    beta = least_squares(pdf[~pdf["is_test"]])
    np.testing.assert_allclose([model.intercept, *model.coefficients], beta, atol=1e-8)
    test = pdf[pdf["is_test"]]
    error = test["wave_height"] - (beta[0] + test[lagged.lag_names()].to_numpy(float) @ beta[1:])
    row = evaluation.first()
    assert row["n_test"] == len(test) and row["mse"] == pytest.approx((error**2).mean(), rel=1e-8)


def test_split_does_not_depend_on_partitioning(spark):
    _, sdf = series(spark, 300)
    pick = [rows(df.where(forecast.is_test_row()).select("station_id", "datetime")) for df in (sdf, sdf.repartition(9))]
    assert pick[0] == pick[1] and pick[0]


def test_forecast_modes(spark):
    pdf, sdf = series(spark, nulls=0.0)
    ahead = forecast_job(sdf)
    m = ahead.model
    last = pdf.sort_values("datetime").groupby("station_id").tail(1).set_index("station_id")
    for r in ahead.forecast.collect():
        want = m.intercept + last.loc[r["station_id"], MEASURES].to_numpy(float) @ np.array(m.coefficients)
        assert r["forecast"] == pytest.approx(want)
    again = forecast_job(sdf, mode="refit_last")
    before = pdf.sort_values(["datetime", "station_id"]).iloc[-2]
    want = again.model.intercept + before[MEASURES].to_numpy(float) @ np.array(again.model.coefficients)
    row = again.forecast.first()
    assert row["datetime"] == pdf["datetime"].max().to_pydatetime() and row["forecast"] == pytest.approx(want)


def test_missing_last_measure_gives_no_forecast(spark):
    model = forecast.LagModel(MEASURES, 1.0, [1.0] * 4)
    df = spark.createDataFrame([("a", ts("2024-01-01"), 1.0, None, 1.0, 1.0)], SERIES)
    assert forecast.forecast_next(model, df).first()["forecast"] is None


def test_a_table_is_cut_by_rows_however_they_lie_in_time(spark):
    """Most rows on one day, or none with a time, are still several ranges of like size."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for when in ("timestamp_ntz'2024-05-01 12:00:00'", "cast(null as timestamp_ntz)"):
            rows = spark.range(4000).selectExpr("cast(id % 7 as string) as station_id", f"case when id % 10 > 0 then {when} else timestamp_ntz'2024-01-01' end as datetime", "cast(id % 50 as double) as wave_height")
            order = ["datetime", "station_id", "wave_height"]
            sizes = [r["count"] for r in lagged._ranges(rows, order).groupBy("_slot").count().collect()]
            assert len(sizes) >= 4 and max(sizes) < 2200
            got = lagged.with_previous(rows, ["wave_height"], ["before"], per_station=False).collect()
            want = sorted(rows.collect(), key=lambda r: (r.datetime is not None, str(r.datetime), r.station_id, r.wave_height))
            pairs = sorted(((str(r.datetime), r.station_id, r.wave_height, str(p and p.wave_height)) for r, p in zip(want, [None, *want])))
            assert sorted((str(r.datetime), r.station_id, r.wave_height, str(r.before)) for r in got) == pairs
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
