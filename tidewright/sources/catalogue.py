"""Station catalogue (XML) and surf spots (JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.schemas import SPOT

_CATALOGUE = T.StructType(
    [T.StructField(f"_{a}", T.StringType()) for a in ("id", "lat", "lon", "met")]
)


def scan_station_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """One row per `<station>` element, with its place in the document order (`doc_order`): file by path, part
    of the file, running number. One task reads a part of a file from its start to its end, so the
    order does not depend on how files are packed into tasks or split."""
    raw = (
        spark.read.format("xml")
        .option("rowTag", "station")
        .option("attributePrefix", "_")
        .schema(_CATALOGUE)
        .load(path)
    )
    return raw.select(
        F.col("_id").alias("station_id"),
        F.col("_lat").try_cast("double").alias("latitude"),
        F.col("_lon").try_cast("double").alias("longitude"),
        (F.col("_met") == "y").alias("met"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
        ).alias("doc_order"),
    )


def meteorological_stations(catalogue: DataFrame) -> DataFrame:
    """Stations that report weather; the last entry of an id wins."""
    entry = F.struct("doc_order", "latitude", "longitude")
    return (
        catalogue.where(F.col("met"))
        .groupBy("station_id")
        .agg(F.max(entry).alias("e"))
        .select("station_id", "e.latitude", "e.longitude")
    )


def scan_spots(spark: SparkSession, path: str) -> DataFrame:
    """Surf spots from a JSON array of objects; coordinates may be numbers or text."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in SPOT.fields])
    raw = spark.read.schema(as_text).option("multiLine", True).json(path)
    return raw.select(
        "name",
        "country",
        F.col("lat").try_cast("double").alias("lat"),
        F.col("lng").try_cast("double").alias("lng"),
    )
