"""Read queries of the service: observations, stations, consistency, map feed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.columns import (
    instant,
    is_finite,
    label_colour,
    lower_names,
    month_text,
    score_colour,
    two_decimals,
    utc,
)
from tidewright.schemas import CONSISTENCY, MEASURES, OBSERVATION, SHORT_NAMES, STATION
from tidewright.sinks.tables import MONTH, MONTH_FORMAT, read_table, replace

MAX_RANGE = dt.timedelta(days=31)


class NoDataFound(LookupError):
    """A query found no rows."""


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise NoDataFound(message)
    return df


def _ordered_bounds(texts: tuple[str, str], layout: str, shown: str) -> tuple[dt.datetime, dt.datetime]:
    """Two instants from texts of one layout, the earlier one first."""
    bounds = []
    for text in texts:
        try:
            bounds.append(dt.datetime.strptime(text, layout))
        except ValueError:
            raise ValueError(f"{text!r} does not read as {shown}") from None
    if bounds != sorted(bounds):
        raise ValueError(f"the range {texts[0]} to {texts[1]} runs backwards")
    return bounds[0], bounds[1]


def validate_date_range(
    start_date: str, end_date: str, now: dt.datetime | None = None
) -> tuple[dt.datetime, dt.datetime]:
    """Bounds of a `YYYY-MM-DD` range; ValueError if it is malformed, reversed, too long or
    in the future. The end means 00:00 of that day, in UTC."""
    first, last = _ordered_bounds((start_date, end_date), "%Y-%m-%d", "YYYY-MM-DD")
    today = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    days = (last - first).days
    if days > MAX_RANGE.days:
        raise ValueError(f"{days} days asked for, {MAX_RANGE.days} are allowed")
    if last > today:  # the start is not later than the end
        raise ValueError(f"{end_date} has not begun yet")
    return first, last


def validate_month_range(start_month: str, end_month: str) -> tuple[dt.datetime, dt.datetime]:
    """Bounds of a `YYYY-MM` range; ValueError if it is malformed or reversed."""
    return _ordered_bounds((start_month, end_month), "%Y-%m", "YYYY-MM")


def between_dates(
    obs: DataFrame, start: dt.datetime, end: dt.datetime, station_id: str | None = None
) -> DataFrame:
    """Rows from `start` to `end`, both included; month folders are skipped where stored."""
    rows = obs.where(F.col("datetime").between(instant(start), instant(end)))
    if MONTH in obs.columns:
        rows = rows.where(F.col(MONTH).between(start.strftime("%Y%m"), end.strftime("%Y%m")))
    if station_id:
        rows = rows.where(F.col("station_id") == station_id)
    return rows


def wave_data(
    obs: DataFrame,
    start_date: str,
    end_date: str,
    station_id: str | None = None,
    now: dt.datetime | None = None,
    end_inclusive_day: bool = False,
    require: bool = False,
) -> DataFrame:
    """Observations in a date range, of one station if given.

    The range ends at 00:00 of the end date; `end_inclusive_day` takes that day as well.
    With `require`, an empty result is an error.
    """
    start, end = validate_date_range(start_date, end_date, now)
    if end_inclusive_day:
        end = end + dt.timedelta(days=1, microseconds=-1)
    rows = between_dates(obs, start, end, station_id).select(
        *[c for c in OBSERVATION.fieldNames() if c in obs.columns]
    )
    if require:
        require_rows(rows, f"No wave data found between {start_date} and {end_date}")
    return rows


def last_day(obs: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Rows of the 24 hours up to `as_of` and later."""
    start = utc(as_of) - dt.timedelta(days=1)
    rows = obs.where(F.col("datetime") >= instant(start))
    if MONTH in obs.columns:
        rows = rows.where(F.col(MONTH) >= start.strftime("%Y%m"))
    return rows


def stations(table: DataFrame, require: bool = False) -> DataFrame:
    rows = table.select(*STATION.fieldNames())
    return require_rows(rows, "No stations found") if require else rows


def consistency(
    trends: DataFrame, start_month: str, end_month: str, require: bool = False
) -> DataFrame:
    """Scored stations of a month range, both months included."""
    start, end = validate_month_range(start_month, end_month)
    if MONTH in trends.columns:
        trends = trends.where(F.col(MONTH).between(start.strftime("%Y%m"), end.strftime("%Y%m")))
    rows = trends.where(
        F.col("month").between(instant(start), instant(end)) & is_finite("consistency_score")
    ).select(
        "station_id", "month", "latitude", "longitude", "consistency_label", "consistency_score"
    )
    return require_rows(rows, "There are no trends in these months.") if require else rows


def consistency_map(trends: DataFrame) -> DataFrame:
    """Map feed: position, label and marker colour of every row."""
    return trends.select(
        "station_id",
        "latitude",
        "longitude",
        "consistency_label",
        label_colour("consistency_label").alias("colour"),
    )


def consistency_popups(trends: DataFrame) -> DataFrame:
    """Marker colour by score, and the texts shown for each marker."""
    return trends.select(
        "station_id",
        month_text("month").alias("month"),
        score_colour("consistency_score").alias("colour"),
        two_decimals("consistency_score").alias("score_text"),
        two_decimals("latitude").alias("latitude_text"),
        two_decimals("longitude").alias("longitude_text"),
    )


def short_named(obs: DataFrame) -> DataFrame:
    """Observation scan under the short measure names."""
    return obs.select(
        "station_id",
        "latitude",
        "longitude",
        "datetime",
        *[F.col(m).alias(SHORT_NAMES[m]) for m in MEASURES],
    )


def ordered_series(obs: DataFrame) -> DataFrame:
    """Measures in time order under lower-case short names."""
    rows = obs.select("datetime", *[F.col(m).alias(SHORT_NAMES[m].upper()) for m in MEASURES])
    return lower_names(rows).orderBy("datetime")


def store_consistency(trends: DataFrame, target: str) -> None:
    """Write the trends anew, by month, so that a range of months is a range of folders."""
    replace(trends.withColumn(MONTH, F.date_format("month", MONTH_FORMAT)), target, [MONTH])


def stored_consistency(spark: SparkSession, target: str) -> DataFrame:
    """The stored trends with their month folder column."""
    return read_table(spark, target, T.StructType([*CONSISTENCY.fields, T.StructField(MONTH, T.StringType())]))


def load_consistency(spark: SparkSession, target: str) -> DataFrame:
    return stored_consistency(spark, target).select(*CONSISTENCY.fieldNames())
