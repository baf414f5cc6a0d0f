"""Data quality: metrics, ingest report, row validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.columns import null_if_nan
from tidewright.schemas import OBSERVATION

# Measures whose null rate makes up the missing percentage (fixed values).
RATED_MEASURES = ["wave_height", "dominant_period", "mean_wave_direction"]


def quality_metrics(df: DataFrame) -> DataFrame:
    """One row: record count, stations, time range, mean null rate in percent.

    Stations are counted over a per-station pre-aggregate, so the full rows are read once
    and only one row per station and task is shuffled.
    """
    nulls = [F.count_if(null_if_nan(m).isNull()).alias(f"null_{m}") for m in RATED_MEASURES]
    per_station = df.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("datetime").alias("first"),
        F.max("datetime").alias("last"),
        *nulls,
    )
    total = F.sum("n")
    rates = reduce(lambda a, b: a + b, [F.sum(f"null_{m}") / total for m in RATED_MEASURES])
    return per_station.agg(
        F.coalesce(total, F.lit(0)).cast("bigint").alias("record_count"),
        F.count("station_id").alias("stations_count"),
        F.min("first").alias("min_datetime"),
        F.max("last").alias("max_datetime"),
        (rates / len(RATED_MEASURES) * 100).alias("missing_data_pct"),
    )


def ingest_report(parsed: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Per station: rows read, rows dropped, and whether anything usable was left.

    With `files` (station_id, file_path), which lists all landed files, also the files that gave
    no line: unreadable, of an unknown layout, or headers only. A station without a usable row is
    `failed` if it has such a file and `empty` otherwise.
    """
    good = F.count_if(F.col("valid"))
    report = parsed.groupBy("station_id").agg(
        good.alias("rows_ok"),
        F.count_if(~F.col("valid")).alias("rows_failed"),
        F.when(good > 0, F.lit("processed")).otherwise(F.lit("empty")).alias("status"),
    )
    if files is None:
        return report
    silent = files.join(parsed.where("valid").select("file_path"), "file_path", "left_anti")
    silent = silent.groupBy("station_id").agg(F.count(F.lit(1)).alias("files_failed"))
    both = files.select("station_id").distinct().join(report, "station_id", "left").join(silent, "station_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    status = F.when(F.col("rows_ok") > 0, "processed").when(F.col("files_failed") > 0, "failed").otherwise("empty")
    return both.select("station_id", zero("rows_ok"), zero("rows_failed"), zero("files_failed"), status.alias("status"))


def ingest_totals(report: DataFrame) -> DataFrame:
    """Stations by status and dropped rows."""
    by_status = [
        F.count_if(F.col("status") == s).alias(f"stations_{s}") for s in ("processed", "empty", "failed")
    ]
    return report.agg(*by_status, F.sum("rows_failed").alias("rows_failed"))


def flag_valid(df: DataFrame, schema: T.StructType = OBSERVATION, required: list[str] | None = None) -> DataFrame:
    """The rows in the types of `schema`, with `valid`: whether every required column has a value.

    Text in a numeric column counts as absent; measures may be absent.
    """
    required = required or ["station_id", "datetime", "latitude", "longitude"]
    cast = df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )
    return cast.withColumn("valid", reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required]))


#: Why a field was not taken as it came.
REASON = "array<struct<field: string, reason: string>>"
VERDICT = "_verdict"


def flag_reasons(df: DataFrame, schema: T.StructType = OBSERVATION, required: list[str] | None = None) -> DataFrame:
    """`flag_valid` with `reasons`: what is wrong with each field, in the order of `schema`.

    A required field without a value is `missing`; a value that does not read as the declared type
    is `not a <type>`, also in a measure, where it costs the value but not the row. A row is valid
    when no required field has a reason; a good row without odd measures has an empty array.
    """
    required = required or ["station_id", "datetime", "latitude", "longitude"]
    reasons = []
    for f in schema.fields:
        given = F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)
        why = F.when(given.isNotNull() & given.try_cast(f.dataType).isNull(), f"not a {f.dataType.simpleString()}")
        if f.name in required:
            why = why.when(given.isNull(), "missing")
        reasons.append(F.when(why.isNotNull(), F.struct(F.lit(f.name).alias("field"), why.alias("reason"))))
    kept = F.filter(F.array(*reasons), lambda r: r.isNotNull()).cast(REASON)
    return flag_valid(df.withColumn("_reasons", kept), _with_reasons(schema), required).withColumnRenamed("_reasons", "reasons")


def _with_reasons(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("_reasons", T.DataType.fromDDL(REASON))])


def split_valid(df: DataFrame, schema: T.StructType = OBSERVATION, required: list[str] | None = None):
    """(good, rejects) of `flag_valid`. Each reads the input; write the flagged rows first if both are used."""
    flagged = flag_valid(df, schema, required)
    return flagged.where("valid").drop("valid"), flagged.where(~F.col("valid")).drop("valid")
