"""Nearest point along great circles against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tidewright.operators import nearest


def haversine_km(lat, lon, lat2, lon2):
    lat, lon, lat2, lon2 = map(np.radians, (lat, lon, lat2, lon2))
    h = np.sin((lat2 - lat) / 2) ** 2 + np.cos(lat) * np.cos(lat2) * np.sin((lon2 - lon) / 2) ** 2
    return 2 * nearest.EARTH_KM * np.arcsin(np.minimum(1, np.sqrt(h)))


def found(spark, points, spots, cell_points):
    grid = spark.createDataFrame(
        [(i, float(a), float(b), float(i)) for i, (a, b) in enumerate(points)], "grid_idx int, lat double, lon double, value double"
    )
    named = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(spots)], "n int, lat double, lng double")
    got = nearest.nearest_grid_value(grid, named, message=[], geometry=[], cell_points=cell_points, sphere=True)
    rows = got.withColumn("km", nearest.great_circle_km("dist2")).collect()
    return {r["n"]: (r["grid_idx"], r["km"]) for r in rows}


@pytest.mark.parametrize("cell_points", [4, 10_000])
def test_as_brute_force(spark, cell_points):
    """Spots on both sides of 180 degrees, at the poles, and with longitudes counted from 0 to 360."""
    rng = np.random.default_rng(8)
    points = np.column_stack([rng.uniform(-90, 90, 700), rng.uniform(0, 360, 700)])
    points[:200, 1] = rng.uniform(-180, 180, 200)
    points[200:260] = np.column_stack([rng.uniform(-60, 60, 60), rng.choice([-179.9, 179.9, 180.0, -180.0], 60)])
    edges = [(a, b) for a in (-90, -89.9, -45, 0, 45, 89.9, 90) for b in (-180, -179.99, 0, 179.99, 180, 359)]
    spots = [*edges, *np.column_stack([rng.uniform(-90, 90, 60), rng.uniform(-180, 180, 60)])]
    got = found(spark, points, spots, cell_points)
    assert len(got) == len(spots)
    for i, (lat, lon) in enumerate(spots):
        far = haversine_km(lat, lon, points[:, 0], points[:, 1])
        assert far[got[i][0]] <= far.min() + 2e-5 and got[i][1] == pytest.approx(far.min(), abs=2e-4)


def test_many_points_at_a_pole_are_one_place(spark):
    """All longitudes of a pole are one place: the lowest index is the answer."""
    points = [(0.0, 10.0), *[(90.0, float(x)) for x in range(-180, 180, 3)]]
    got = found(spark, points, [(80.0, 170.0), (1.0, 9.0)], 4)
    assert got[0][0] == 1 and got[0][1] == pytest.approx(math.radians(10) * nearest.EARTH_KM, abs=1e-3)
    assert got[1][0] == 0
