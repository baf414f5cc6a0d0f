"""Ordered analytics: previous-row features and the last row per station."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewright.schemas import MEASURES
from tidewright.session import materialize


def with_previous(
    df: DataFrame,
    columns: Sequence[str],
    names: Sequence[str],
    per_station: bool = True,
    bucket: str = "day",
) -> DataFrame:
    """Add the previous row's value of each column, in time order.

    The rows are cut into slots, so that no task sorts a long series: a station's series by time, one
    `bucket` each, and the whole table (`per_station=False`) into ranges of about as many rows each, however
    the rows lie in time. The last row of each slot is carried over to the head of the next one, which
    holds rows, and is dropped after the slot has been sorted.

    The order is total: time, then the station if the series has several, then all other columns.
    NULLs come first, in the order and as a station or slot of their own.
    """
    keys = ["station_id"] if per_station else []
    order = ["datetime"] if per_station else ["datetime", "station_id"]
    order += [c for c in df.columns if c not in ("station_id", "datetime")]
    if per_station:
        slot = F.col("datetime").cast("date") if bucket == "day" else F.date_trunc(bucket, "datetime")
        rows = df.withColumn("_slot", slot)
    else:
        rows = _ranges(df, order)
    last = rows.groupBy(*keys, "_slot").agg(F.max(F.struct(*order)).alias("_last"))
    slots = Window.partitionBy(*keys).orderBy("_slot")
    carried = last.withColumn("_next", F.lead(F.struct("_slot")).over(slots)).where(F.col("_next").isNotNull())
    carried = carried.select(
        *[(F.col("_last")[c] if c in order else F.col(c)).alias(c) for c in df.columns],
        F.col("_next._slot").alias("_slot"),
        F.lit(True).alias("_carried"),
    )
    rows = rows.withColumn("_carried", F.lit(False)).unionByName(carried)
    in_slot = Window.partitionBy(*keys, "_slot").orderBy(F.desc("_carried"), *order)
    rows = rows.select("*", *[F.lag(c).over(in_slot).alias(n) for c, n in zip(columns, names)])
    return rows.where(~F.col("_carried")).select(*df.columns, *names)


def _ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with `_slot`, the number of the range they lie in by `order`.

    Rows that are the same in all columns may be in several ranges; it makes no difference which. The rows
    are written down, as the bounds of the ranges are sampled.
    """
    rows = df.withColumn("_tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order, "_tie").drop("_tie")
    return materialize(rows.withColumn("_slot", F.spark_partition_id()), "ranges")


def lag_names(columns: Sequence[str] = tuple(MEASURES)) -> list[str]:
    return [f"{c}_lag1" for c in columns]


def lag_features(
    obs: DataFrame,
    columns: Sequence[str] = tuple(MEASURES),
    per_station: bool = True,
    bucket: str = "day",
    complete: bool = True,
) -> DataFrame:
    """Lag-1 features of the measures; with `complete`, only rows without any NULL."""
    rows = obs.select("station_id", "datetime", *columns)
    lagged = with_previous(rows, columns, lag_names(columns), per_station, bucket)
    return lagged.dropna("any") if complete else lagged


def latest_per_station(df: DataFrame) -> DataFrame:
    """Last row of each station in time order; of rows at one time the one with the largest values."""
    rest = [c for c in df.columns if c not in ("station_id", "datetime")]
    last = df.groupBy("station_id").agg(F.max(F.struct("datetime", *rest)).alias("_last"))
    return last.select(*[F.col("station_id") if c == "station_id" else F.col(f"_last.{c}") for c in df.columns])


def latest_overall(df: DataFrame, n: int = 1) -> DataFrame:
    """The last `n` rows of the table in (datetime, station, other columns) order."""
    rest = [c for c in df.columns if c not in ("station_id", "datetime")]
    return df.orderBy(*[F.col(c).desc() for c in ("datetime", "station_id", *rest)]).limit(n)
