"""Gridded fields as a long table, and the manifests of model runs to fetch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.columns import cycle_floor, instant, null_if_missing
from tidewright.schemas import GRID_VALUE

# File-name templates of the two model archives (fixed values).
RUN_TEMPLATE = "gfs_%s%s/gfs%s/gfs_%s%s_%sz.ascii?gustsfc[0][540][1260]"
CYCLE_TEMPLATE = "gfs.%1$s/%4$s/wave/gridded/%2$s.t%4$sz.%3$s.f%5$s.grib2"


def scan_grid(spark: SparkSession, path: str) -> DataFrame:
    """The long grid table with its missing-value mark turned into NULL."""
    return grid_values(spark.read.schema(GRID_VALUE).parquet(path))


def grid_values(raw: DataFrame) -> DataFrame:
    return raw.withColumn("value", null_if_missing("value"))


def ravel(messages: DataFrame) -> DataFrame:
    """The long grid table of messages whose grid is arrays, a message per row.

    `values` holds the rows of the grid. `lat` and `lon` are either the two axes, one number per row and one
    per column, or arrays of the same form as `values`. `grid_idx` counts the values row by row, from 0, also
    where rows have different lengths. A missing coordinate is NULL; a message without values gives no rows.
    """
    kinds = dict(messages.dtypes)

    def at(name: str, i: Column, j: Column) -> Column:
        if kinds[name].startswith("array<array"):
            return F.get(F.get(name, i), j)
        return F.get(name, i if name == "lat" else j)

    def row(values: Column, i: Column) -> Column:
        point = lambda v, j: F.struct(at("lat", i, j).alias("lat"), at("lon", i, j).alias("lon"), v.alias("value"))
        return F.transform(F.coalesce(values, F.array()), point)

    rest = [f.name for f in GRID_VALUE.fields if f.name not in ("grid_idx", "lat", "lon", "value")]
    points = messages.select(*rest, F.posexplode(F.flatten(F.transform("values", row))).alias("grid_idx", "point"))
    return grid_values(points.select(*rest, F.col("grid_idx").cast("long").alias("grid_idx"), "point.*").select(*GRID_VALUE.fieldNames()))


def grid_metadata(message: DataFrame) -> DataFrame:
    """Date, time and forecast text of each message row, as they are stored."""
    return message.withColumns(
        {
            "data_date": F.date_format("analysis_ts", "yyyyMMdd"),
            "data_time": F.date_format("analysis_ts", "HHmm"),
            "forecast_time": F.format_string("%d hours", "forecast_hours"),
        }
    )


def available_parameters(grid: DataFrame) -> DataFrame:
    return grid.groupBy("param").agg(F.count(F.lit(1)).alias("n_values"))


def run_manifest(
    spark: SparkSession, start: dt.datetime, end: dt.datetime, interval_hours: int = 6
) -> DataFrame:
    """One row per model run between two instants, both ends included."""
    bounds = spark.range(1).select(instant(start).alias("start"), instant(end).alias("end"))
    return runs_between(bounds, interval_hours).select("run_ts")


def runs_between(bounds: DataFrame, interval_hours: int = 6) -> DataFrame:
    """As `run_manifest`, for each (start, end) row of a table; its columns are kept."""
    step = F.make_dt_interval(F.lit(0), F.lit(interval_hours))
    return bounds.withColumn("run_ts", F.explode(F.sequence("start", "end", step)))


def run_file_name(run_ts: Column, res: str = "0p25", step: str = "3hr") -> Column:
    """Archive name by resolution, step and the run's own hour."""
    return F.format_string(
        RUN_TEMPLATE,
        F.lit(res),
        F.lit(step),
        F.date_format(run_ts, "yyyyMMdd"),
        F.lit(res),
        F.lit(step),
        F.lpad(F.hour(run_ts).cast("string"), 2, "0"),
    )


def local_file_name(run_ts: Column) -> Column:
    return F.concat(F.lit("grib_"), F.date_format(run_ts, "yyyyMMdd_HHmm"), F.lit(".grib2"))


def cycle_file_name(as_of: Column, forecast_hour: Column, name: str, subset: str) -> Column:
    """Archive name of the cycle that contains `as_of`, for one forecast hour."""
    cycle = cycle_floor(as_of)
    return F.format_string(
        CYCLE_TEMPLATE,
        F.date_format(cycle, "yyyyMMdd"),
        F.lit(name),
        F.lit(subset),
        F.lpad(F.hour(cycle).cast("string"), 2, "0"),
        _pad(forecast_hour.cast("string"), 3),
    )


def _pad(text: Column, width: int) -> Column:
    """Zeros on the left up to `width`; longer text is kept whole."""
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))
