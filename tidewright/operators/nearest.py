"""Nearest grid point of every spot in every gridded field, and the wide model samples."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.columns import units_or_unknown
from tidewright.schemas import MESSAGE, SWELL, SWELL_MEASURES
from tidewright.session import materialize

# A cell of the search grid is split further while it holds more points than this.
CELL_POINTS = 64
FAN_BITS = 2  # a cell has 4 x 4 children
MAX_DEPTH = 20
# Spots, and grids, that are paired under one key at most on average.
PAIRING_BLOCK = 256
# Upper levels at which very many spots may still be in one cell: they are looked up by block of spots.
SHARED_LEVELS = 2
PLAN_LEVELS = 6


EARTH_KM = 6371.0088
# Coordinates that distances are measured in: degrees in the plane, or a unit vector on the sphere.
PLANE, SPHERE = ["lat", "lon"], ["_x", "_y", "_z"]
VECTOR_STEPS = 1e9  # unit vectors are rounded to 9 decimals, 6 mm, so that ties do not hang on the last digit


def unit_vector(lat: Column, lon: Column) -> list[Column]:
    """The place as a point on the unit sphere, where straight distances order places as great circles do."""
    lat, lon = F.radians(lat), F.radians(lon)
    parts = (F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat))
    return [F.rint(p * F.lit(VECTOR_STEPS)) / F.lit(VECTOR_STEPS) for p in parts]


def great_circle_km(dist2: Column) -> Column:
    """Kilometres along the sphere from a squared straight distance between unit vectors."""
    return F.asin(F.least(F.sqrt(dist2) / 2, F.lit(1.0))) * F.lit(2 * EARTH_KM)


def _squared(places: Sequence[Column], axes: Sequence[str]) -> Column:
    """Squared straight distance to the spot; in the plane in degrees, where longitudes do not wrap."""
    gaps = [place - F.col(f"_at.{a}") for place, a in zip(places, axes)]
    return reduce(lambda a, b: a + b, [g * g for g in gaps])


def _nearest_corner(low: str, high: str, at: str) -> Column:
    return F.greatest(F.least(F.col(at), F.col(high)), F.col(low))


def _farthest_corner(low: str, high: str, at: str) -> Column:
    near_low = F.col(at) - F.col(low) < F.col(high) - F.col(at)
    return F.when(near_low, F.col(high)).otherwise(F.col(low))


def _box(axes: Sequence[str]) -> list[str]:
    return [f"{a}{side}" for a in axes for side in (0, 1)]


def _cells(df: DataFrame, count: Column, axes: Sequence[str], of_cells: bool = False) -> DataFrame:
    """Number of points and box of each cell, from points or from smaller cells."""
    low, high = (("0", "1") if of_cells else ("", ""))
    sides = [f(a + end).alias(a + to) for a in axes for f, end, to in ((F.min, low, "0"), (F.max, high, "1"))]
    return df.groupBy("_g", "cx", "cy").agg(F.sum(count).alias("n"), *sides)


def _with_cell(points: DataFrame, half: float, depth: int) -> DataFrame:
    side = 2 * half / (1 << FAN_BITS * depth)
    return points.withColumns(
        {
            "cx": F.floor((F.col("lon") + half) / side),
            "cy": F.floor((F.col("lat") + half) / side),
        }
    )


def _search_cells(points: DataFrame, cell_points: int, axes: Sequence[str]) -> tuple[DataFrame, DataFrame, float, int]:
    """(points, leaf cells, half width of the root cell, depth) of the search grid.

    The depth is the smallest at which no cell holds more than `cell_points` points.
    """
    most, reach = (
        points.groupBy("_g")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.greatest(F.abs("lat"), F.abs("lon"))).alias("r"))
        .agg(F.max("n"), F.max("r"))
        .first()
    )
    half = 2.0 ** (math.floor(math.log2(max(reach or 1.0, 1.0))) + 1)
    if (most or 0) <= cell_points:
        return points, None, half, 0
    depth = max(1, math.ceil(math.log(most / cell_points, 1 << 2 * FAN_BITS)))
    while True:
        located = _with_cell(points, half, depth)
        leaves = materialize(_cells(located, F.lit(1), axes), "cells")
        one_place = reduce(lambda a, b: a & b, [F.col(f"{a}0") == F.col(f"{a}1") for a in axes])
        spread, stacked = leaves.agg(
            F.max(F.when(~one_place, F.col("n"))), F.max(F.when(one_place, F.col("n")))
        ).first()
        if (spread or 0) <= cell_points or depth >= MAX_DEPTH:
            break
        depth += max(1, math.ceil(math.log(spread / cell_points, 1 << 2 * FAN_BITS)))
        depth = min(depth, MAX_DEPTH)
    if max(stacked or 0, spread or 0) > cell_points:
        # Many points at one place: only the lowest index can be the answer there.
        rest = [c for c in points.columns if c not in ("_g", *axes, "grid_idx")]
        first = F.min(F.struct("grid_idx", *rest)).alias("_p")
        points = points.groupBy("_g", *axes).agg(first).select("_g", *axes, "_p.*")
    return points, leaves, half, depth


def nearest_points(
    points: DataFrame, spots: DataFrame, geometry: Sequence[str], cell_points: int = CELL_POINTS, sphere: bool = False
) -> DataFrame:
    """For each (geometry, spot) the nearest point, the lowest `grid_idx` among equals.

    The search goes down a pyramid of square cells, as an index would, but as equi-joins
    on the cell: at each level a cell is kept for a spot only while its nearest corner is
    not farther than the farthest corner of the best cell. What is kept per spot is a few
    cells, and a last cell holds at most `cell_points` points, so neither all pairs of
    points and spots nor a whole field in one task ever come up. The result is exact.

    `points` has the geometry columns, `grid_idx`, `lat`, `lon` and columns to carry along;
    `spots` has `lat`, `lng` and any others. Output: geometry, `spot` (struct), `dist2`,
    `grid_idx`, the carried columns, and `copies` (how often the spot is listed).

    `dist2` is planar, in degrees. With `sphere` it is between unit vectors (see `great_circle_km`):
    longitudes wrap, and they shrink towards the poles. Cells stay those of latitude and longitude, but
    their boxes are those of the vectors, so the same bounds hold across 180 degrees and at a pole.
    """
    axes = SPHERE if sphere else PLANE
    place = unit_vector if sphere else (lambda lat, lon: [lat, lon])
    carried = [c for c in points.columns if c not in (*geometry, "grid_idx", "lat", "lon")]
    placed = points.select(
        F.struct(*geometry).alias("_g"), "grid_idx", "lat", "lon", *carried
    ).where("lat is not null and lon is not null and not isnan(lat) and not isnan(lon)")
    located = spots.where("lat is not null and lng is not null and not isnan(lat) and not isnan(lng)")
    sites = located.groupBy(F.struct(*spots.columns).alias("_s")).agg(F.count(F.lit(1)).alias("copies"))
    at = [c.alias(a) for c, a in zip(place(F.col("_s.lat"), F.col("_s.lng")), axes)]
    sites = sites.withColumn("_at", F.struct(*at))
    if sphere:
        placed = placed.withColumns(dict(zip(axes, unit_vector(F.col("lat"), F.col("lon")))))

    placed, leaves, half, depth = _search_cells(placed, cell_points, axes)

    # Every spot is looked up in every geometry; the size of this pairing is the size of the
    # result. Blocks of spots meet blocks of grids, each pair of blocks under a key of its own, so
    # the number of keys grows with the result and one grid with many spots is many keys as well.
    grids = materialize((leaves if depth else placed).select("_g").distinct(), "grids")
    sites = materialize(sites, "sites")
    n_sites, n_grids = (max(1, math.ceil(df.count() / PAIRING_BLOCK)) for df in (sites, grids))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    sites = sites.withColumn("_a", block("_s", n_sites))
    front = grids.withColumn("_b", block("_g", n_grids)).withColumn("_a", every(n_sites)).join(
        sites.withColumn("_b", every(n_grids)), ["_a", "_b"]
    ).drop("_b")

    if depth:
        root = F.lit(0).cast("bigint")
        front = front.withColumns({"cx": root, "cy": root})
        per_spot = Window.partitionBy("_g", "_s")
        for level in range(1, depth + 1):
            up = FAN_BITS * (depth - level)
            cells = leaves if not up else _cells(
                leaves.withColumns({"cx": F.shiftright("cx", up), "cy": F.shiftright("cy", up)}),
                F.col("n"), axes, of_cells=True,
            )
            children = cells.select(
                "_g",
                F.col("cx").alias("_cx"),
                F.col("cy").alias("_cy"),
                F.shiftright("cx", FAN_BITS).alias("cx"),
                F.shiftright("cy", FAN_BITS).alias("cy"),
                *_box(axes),
            )
            keys = ["_g", "cx", "cy"]
            if level <= SHARED_LEVELS:
                children, keys = children.withColumn("_a", every(n_sites)), [*keys, "_a"]
            near = _squared([_nearest_corner(f"{a}0", f"{a}1", f"_at.{a}") for a in axes], axes)
            far = _squared([_farthest_corner(f"{a}0", f"{a}1", f"_at.{a}") for a in axes], axes)
            front = (
                front.join(children, keys)
                .select("_g", "_s", "_at", "_a", "copies", F.col("_cx").alias("cx"), F.col("_cy").alias("cy"), near.alias("near"), far.alias("far"))
                .withColumn("best", F.min("far").over(per_spot))
                .where(F.col("near") <= F.col("best"))
                .drop("near", "far", "best")
            )
            if level % PLAN_LEVELS == 0:
                front = materialize(front, "front")  # a deep search in plans of bounded size
        candidates = front.join(_with_cell(placed, half, depth), ["_g", "cx", "cy"])
    else:
        candidates = front.join(placed, "_g")

    entry = F.struct(_squared([F.col(a) for a in axes], axes).alias("dist2"), "grid_idx", *carried)
    return (
        candidates.groupBy("_g", "_s")
        .agg(F.min(entry).alias("_n"), F.first("copies").alias("copies"))
        .select("_g.*", F.col("_s").alias("spot"), "_n.*", "copies")
    )


def nearest_grid_value(
    grid: DataFrame,
    spots: DataFrame,
    message: Sequence[str] = tuple(MESSAGE),
    geometry: Sequence[str] | None = None,
    cell_points: int = CELL_POINTS,
    sphere: bool = False,
) -> DataFrame:
    """Value at the nearest grid point for every (spot, message); with `sphere`, along great circles.

    A missing value at the nearest point stays NULL; the next point is not taken. By
    default every message has a grid of its own. Where messages share grids, name the
    columns that tell the grids apart, out of the message columns (none if there is just
    one grid): the search then runs once per grid, over the points of one of its messages,
    and the values are looked up by (grid, index).
    """
    message = list(message)
    if geometry is None:
        points = grid.select(*message, "grid_idx", "lat", "lon", "value")
        found = nearest_points(points, spots, message, cell_points, sphere)
    else:
        # The literal stands for "one grid" where no column tells grids apart. Structs as
        # join keys match on NULL fields as well.
        keyed = grid.withColumns(
            {"_grid": F.struct(F.lit(0), *geometry), "_message": F.struct(*message)}
        )
        fields = keyed.select("_grid", "_message").distinct()
        one_each = fields.groupBy("_grid").agg(F.min("_message").alias("_message"))
        points = keyed.join(one_each.select("_message"), "_message", "left_semi").select(
            "_grid", "grid_idx", "lat", "lon"
        )
        places = nearest_points(points, spots, ["_grid"], cell_points, sphere)
        found = keyed.join(places, ["_grid", "grid_idx"]).select(
            *message, "spot", "dist2", "grid_idx", "value", "copies"
        )
    once_per_listing = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return (
        found.withColumn("_copy", once_per_listing)
        .select(
            *message,
            *[F.col(f"spot.{c}").alias({"lat": "spot_lat", "lng": "spot_lng"}.get(c, c)) for c in spots.columns],
            "grid_idx",
            "dist2",
            "value",
        )
    )


def identity_params() -> dict[str, str]:
    return {m: m for m in SWELL_MEASURES}


def swell_rows(samples: DataFrame, params: Mapping[str, str] | None = None) -> DataFrame:
    """One wide row per (spot, message): the message's own measure is filled.

    `params` maps message names to measure columns; a message with another name gives a row
    without a measure. A missing unit reads `unknown`.
    """
    params = identity_params() if params is None else params
    columns = []
    for m in SWELL_MEASURES:
        names = [p for p, target in params.items() if target == m]
        match = F.col("param").isin(names) if names else F.lit(False)
        columns.append(F.when(match, F.col("value")).cast("double").alias(m))
        columns.append(units_or_unknown(F.when(match, F.col("units"))).alias(f"{m}_units"))
    return samples.select(*_spot_columns(), *columns, *_time_columns()).select(*SWELL.fieldNames())


def swell_wide(samples: DataFrame, params: Mapping[str, str] | None = None) -> DataFrame:
    """One wide row per (spot, run, forecast hour) with all its measures.

    Of several messages for one measure the one with the lowest name counts.
    """
    params = identity_params() if params is None else params
    aggs = []
    for m in SWELL_MEASURES:
        names = [p for p, target in params.items() if target == m]
        match = F.col("param").isin(names) if names else F.lit(False)
        entry = F.min(F.when(match, F.struct("param", "value", "units")))
        aggs.append(entry["value"].cast("double").alias(m))
        aggs.append(units_or_unknown(entry["units"]).alias(f"{m}_units"))
    keyed = samples.select("*", *[c.alias(f"_{i}") for i, c in enumerate(_spot_columns())])
    grouped = keyed.groupBy(
        *[F.col(f"_{i}").alias(n) for i, n in enumerate(["surf_spot_name", "country", "lat", "lng"])],
        "analysis_ts",
        "forecast_hours",
    ).agg(*aggs)
    date, time, _ = _time_columns()
    return grouped.select("*", date, time).select(*SWELL.fieldNames())


def _spot_columns() -> list[Column]:
    return [
        F.col("name").alias("surf_spot_name"),
        F.col("country").alias("country"),
        F.col("spot_lat").alias("lat"),
        F.col("spot_lng").alias("lng"),
    ]


def _time_columns() -> list[Column]:
    return [
        F.col("analysis_ts").cast("date").alias("date"),
        F.date_format("analysis_ts", "HHmm").alias("time"),
        F.col("forecast_hours"),
    ]
