"""Nearest grid point, wide samples, decoding, manifests."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from tidewright.functions import columns as fc
from tidewright.operators import nearest
from tidewright.plans.jobs import model_sampling, satellite_decode
from tidewright.schemas import GRID_VALUE, SPOT, SWELL
from tidewright.sources import grids

T0 = ts("2024-10-22 00:00")


def grid_frame(spark, points, param="wind_speed", units="m s**-1", at=T0, hours=0):
    data = [(param, units, at, hours, int(i), float(la), float(lo), v) for i, la, lo, v in points]
    return spark.createDataFrame(data, GRID_VALUE)


def spot_frame(spark, places):
    return spark.createDataFrame([(f"s{i}", "X", float(a), float(b)) for i, (a, b) in enumerate(places)], SPOT)


def brute(points, places):
    """(grid_idx, value) per place: lowest squared distance, then lowest index."""
    out = []
    for a, b in places:
        out.append(min(((la - a) ** 2 + (lo - b) ** 2, i, v) for i, la, lo, v in points)[1:])
    return out


def found(df):
    return {r["name"]: (r["grid_idx"], r["value"]) for r in df.collect()}


def layouts():
    rng = np.random.default_rng(8)
    regular = [(i, 30 + 0.25 * (i // 40), -130 + 0.25 * (i % 40), float(i)) for i in range(1600)]
    # a third of all points crowded into a tiny area, some of them at one place
    crowd = [(i, 10 + rng.random() * 1e-3, 20 + rng.random() * 1e-3, float(i)) for i in range(400)]
    crowd += [(400 + i, 10.0, 20.0, float(i)) for i in range(300)]
    crowd += [(700 + i, rng.uniform(-90, 90), rng.uniform(0, 360), float(i)) for i in range(800)]
    line = [(i, 0.0, float(i), float(i)) for i in range(500)]
    return {"regular": regular, "crowd": crowd, "line": line}


@pytest.mark.parametrize("kind", ["regular", "crowd", "line"])
@pytest.mark.parametrize("cell_points", [4, 64])
def test_nearest_agrees_with_brute_force(spark, kind, cell_points):
    rng = np.random.default_rng(9)
    points = layouts()[kind]
    places = [(rng.uniform(-90, 90), rng.uniform(-180, 360)) for _ in range(25)]
    places += [(10.0, 20.0), (10.0005, 20.0005), (31.1, -129.9), (90.0, 400.0), (0.0, 3.5)]
    got = found(nearest.nearest_grid_value(grid_frame(spark, points), spot_frame(spark, places), cell_points=cell_points))
    assert [got[f"s{i}"] for i in range(len(places))] == brute(points, places)


def test_equidistant_points_give_the_lowest_index(spark):
    points = [(7, 0.0, 1.0, 70.0), (3, 0.0, -1.0, 30.0), (5, 1.0, 0.0, 50.0)]
    assert found(nearest.nearest_grid_value(grid_frame(spark, points), spot_frame(spark, [(0, 0)]))) == {"s0": (3, 30.0)}


def test_missing_value_at_the_nearest_point_stays_null(spark):
    raw = grid_frame(spark, [(0, 0.0, 0.0, 9999.0), (1, 5.0, 5.0, 1.0)])
    got = nearest.nearest_grid_value(grids.grid_values(raw), spot_frame(spark, [(0.1, 0.1)]))
    assert found(got) == {"s0": (0, None)}


def test_no_wrap_and_unplaced_points(spark):
    points = [(0, 0.0, 179.0, 1.0), (1, 0.0, -100.0, 2.0)]
    grid = grid_frame(spark, points).unionByName(
        spark.createDataFrame([("wind_speed", "m s**-1", T0, 0, 9, None, 0.0, 5.0)], GRID_VALUE)
    )
    assert found(nearest.nearest_grid_value(grid, spot_frame(spark, [(0, -179)]))) == {"s0": (1, 2.0)}


def test_messages_are_searched_apart_and_units_may_be_missing(spark):
    a = grid_frame(spark, [(0, 0.0, 0.0, 1.0)], "wind_speed")
    b = grid_frame(spark, [(0, 9.0, 9.0, 2.0)], "wind_direction", None)
    got = nearest.nearest_grid_value(a.unionByName(b), spot_frame(spark, [(0, 0), (8, 8)]))
    assert rows(got.select("param", "units", "name", "value")) == [
        ("wind_direction", None, "s0", 2.0),
        ("wind_direction", None, "s1", 2.0),
        ("wind_speed", "m s**-1", "s0", 1.0),
        ("wind_speed", "m s**-1", "s1", 1.0),
    ]


def test_shared_grid_gives_the_same_as_a_grid_per_message(spark):
    points = layouts()["regular"]
    places = [(31.3, -127.2), (0.0, 0.0), (35.0, -121.0)]
    grid = grid_frame(spark, points).unionByName(
        grid_frame(spark, [(i, la, lo, -v) for i, la, lo, v in points], "wind_direction", hours=3)
    )
    spots = spot_frame(spark, places)
    own = nearest.nearest_grid_value(grid, spots)
    shared = nearest.nearest_grid_value(grid, spots, geometry=[])
    assert rows(own.select(*sorted(own.columns))) == rows(shared.select(*sorted(own.columns)))
    assert own.count() == 6


def test_a_spot_listed_twice_is_sampled_twice(spark):
    spots = spark.createDataFrame([("a", "X", 0.0, 0.0)] * 2 + [("b", "X", None, 0.0)], SPOT)
    got = nearest.nearest_grid_value(grid_frame(spark, [(0, 0.0, 0.0, 1.0)]), spots)
    assert [r["name"] for r in got.collect()] == ["a", "a"]


def test_search_has_no_cross_join(spark):
    grid, spots = grid_frame(spark, layouts()["regular"]), spot_frame(spark, [(31, -129)])
    plan = nearest.nearest_grid_value(grid, spots, cell_points=4)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_swell_rows_and_wide(spark):
    grid = (
        grid_frame(spark, [(0, 0.0, 0.0, 1.0)], "wind_speed")
        .unionByName(grid_frame(spark, [(0, 0.0, 0.0, 2.0)], "Wind direction", None))
        .unionByName(grid_frame(spark, [(0, 0.0, 0.0, 3.0)], "cloud cover"))
    )
    samples = nearest.nearest_grid_value(grid, spot_frame(spark, [(0, 0)]))
    params = {**nearest.identity_params(), "Wind direction": "wind_direction"}
    sparse = nearest.swell_rows(samples, params)
    assert sparse.columns == SWELL.fieldNames()
    picked = rows(sparse.select("wind_speed", "wind_speed_units", "wind_direction", "wind_direction_units"))
    assert picked == [
        (1.0, "m s**-1", None, "unknown"),
        (None, "unknown", 2.0, "unknown"),
        (None, "unknown", None, "unknown"),
    ]
    row = nearest.swell_wide(samples, params).first()
    assert (row["wind_speed"], row["wind_direction"], row["wind_speed_units"]) == (1.0, 2.0, "m s**-1")
    assert (row["date"], row["time"], row["forecast_hours"]) == (dt.date(2024, 10, 22), "0000", 0)


def test_model_sampling_takes_the_runs_of_the_manifest(spark):
    grid = grid_frame(spark, [(0, 0.0, 0.0, 1.0)]).unionByName(
        grid_frame(spark, [(0, 0.0, 0.0, 2.0)], at=ts("2024-10-22 06:00"))
    ).unionByName(grid_frame(spark, [(0, 0.0, 0.0, 3.0)], at=ts("2024-10-22 07:00")))
    got = model_sampling(grid, spot_frame(spark, [(0, 0)]), T0, ts("2024-10-22 12:00"))
    assert rows(got.select("wind_speed", "time")) == [(1.0, "0000"), (2.0, "0600")]


def test_run_manifest_and_names(spark):
    runs = grids.run_manifest(spark, T0, ts("2024-10-23 00:00"))
    got = rows(runs.select("run_ts", grids.run_file_name(F.col("run_ts")), grids.local_file_name(F.col("run_ts"))))
    assert len(got) == 5
    assert got[1] == (
        ts("2024-10-22 06:00"),
        "gfs_0p253hr/gfs20241022/gfs_0p253hr_06z.ascii?gustsfc[0][540][1260]",
        "grib_20241022_0600.grib2",
    )
    assert grids.run_manifest(spark, T0, ts("2024-10-22 05:00")).count() == 1


def test_cycle_names(spark):
    df = spark.createDataFrame([(ts("2024-10-01 17:59:59"), 64), (ts("2024-10-01 05:00"), 1200)], "t timestamp_ntz, h int")
    got = [r[0] for r in df.select(grids.cycle_file_name(F.col("t"), F.col("h"), "gfswave", "atlocn")).collect()]
    assert got == [
        "gfs.20241001/12/wave/gridded/gfswave.t12z.atlocn.f064.grib2",
        "gfs.20241001/00/wave/gridded/gfswave.t00z.atlocn.f1200.grib2",
    ]


def test_cycle_floor(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 23]
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, h, 59),) for h in hours], "t timestamp_ntz")
    assert [r[0].hour for r in df.select(fc.cycle_floor("t")).collect()] == [0, 0, 6, 6, 12, 12, 18, 18]


def test_decode(spark):
    df = spark.createDataFrame([(5.0, 0.1, -1.0), (-1.0, 0.1, -1.0), (5.0, None, None), (None, 2.0, None)], "raw double, scale_factor double, fill_value double")
    assert [r["value"] for r in satellite_decode(df).collect()] == [0.5, None, 5.0, None]


def test_grid_scan_metadata_and_parameters(spark, tmp_path):
    grid = grid_frame(spark, [(0, 0.0, 0.0, 9999.0), (1, 0.0, 1.0, float("nan")), (2, 0.0, 2.0, 3.0)], hours=6)
    grid.write.parquet(str(tmp_path / "grid"))
    scanned = grids.scan_grid(spark, str(tmp_path / "grid"))
    assert [r["value"] for r in scanned.orderBy("grid_idx").collect()] == [None, None, 3.0]
    meta = grids.grid_metadata(scanned).first()
    assert (meta["data_date"], meta["data_time"], meta["forecast_time"]) == ("20241022", "0000", "6 hours")
    assert rows(grids.available_parameters(scanned)) == [("wind_speed", 3)]


@pytest.mark.parametrize("form", ["axes", "coordinates"])
def test_array_grids_equal_the_long_form(spark, form):
    """Two axes, or coordinates of each value; the mark for missing values, rows of any length, no values."""
    values = [[1.0, 9999.0, None], [4.0, 5.0, 6.0]]
    lat, lon = [10.0, 20.0], [1.0, 2.0, 3.0]
    kind = "array<double>"
    if form == "coordinates":
        lat, lon, kind = [[y] * 3 for y in lat], [lon] * 2, "array<array<double>>"
    when = ts("2024-10-22")
    data = [("a", "m", when, 3, values, lat, lon), ("b", None, when, 0, [[7.0], None, [8.0, 9.0]], lat, lon), ("c", "m", when, 0, None, lat, lon), ("d", "m", when, 0, [], lat, lon)]
    messages = spark.createDataFrame(data, f"param string, units string, analysis_ts timestamp_ntz, forecast_hours int, values array<array<double>>, lat {kind}, lon {kind}")
    found = grids.ravel(messages)
    assert found.columns == grids.GRID_VALUE.fieldNames()
    got = {p: sorted((r.grid_idx, r.lat, r.lon, r.value) for r in found.collect() if r.param == p) for p in "abcd"}
    assert [r[:3] for r in got["a"]] == [(3 * i + j, 10.0 * (i + 1), j + 1.0) for i in range(2) for j in range(3)]
    assert [r[3] for r in got["a"]] == [1.0, None, None, 4.0, 5.0, 6.0]
    assert [(r[0], r[3]) for r in got["b"]] == [(0, 7.0), (1, 8.0), (2, 9.0)] and got["c"] == got["d"] == []
