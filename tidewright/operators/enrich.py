"""Joins with the station table: coordinates and coverage.

The station side carries no broadcast hint. Spark broadcasts it while its measured size is
below `spark.sql.autoBroadcastJoinThreshold`; above that it shuffles both sides and the
skew-join rule splits a station that holds very many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich_coordinates(obs: DataFrame, stations: DataFrame) -> DataFrame:
    """Fill both coordinates from the station table where one of them is missing.

    Rows that still have no coordinates (station unknown) are left out.
    """
    known = stations.select(
        "station_id",
        F.col("latitude").alias("_st_lat"),
        F.col("longitude").alias("_st_lon"),
    )
    if "latitude" not in obs.columns:
        obs = obs.withColumns({c: F.lit(None).cast("double") for c in ("latitude", "longitude")})
    own = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    columns = obs.columns
    filled = obs.join(known, "station_id", "left").withColumns(
        {
            "latitude": F.when(own, F.col("latitude")).otherwise(F.col("_st_lat")),
            "longitude": F.when(own, F.col("longitude")).otherwise(F.col("_st_lon")),
        }
    )
    return filled.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(*columns)


def station_coverage(catalogue: DataFrame, stations: DataFrame) -> DataFrame:
    """Every catalogue station with its coordinates and whether it is a stored station."""
    stored = stations.select(
        "station_id",
        F.col("latitude").alias("_lat"),
        F.col("longitude").alias("_lon"),
        F.lit(True).alias("_stored"),
    )
    found = F.col("_stored").isNotNull()
    return catalogue.join(stored, "station_id", "left").select(
        "station_id",
        F.when(found, F.col("_lat")).otherwise(F.col("latitude")).alias("latitude"),
        F.when(found, F.col("_lon")).otherwise(F.col("longitude")).alias("longitude"),
        F.when(found, F.lit("with_met")).otherwise(F.lit("without_met")).alias("coverage"),
    )


def distinct_stations(df: DataFrame) -> DataFrame:
    return df.select("station_id").distinct()


def first_stations(df: DataFrame, n: int = 10) -> DataFrame:
    """The first `n` station ids, in id order."""
    return distinct_stations(df).orderBy("station_id").limit(n)
