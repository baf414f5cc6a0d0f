"""Reasons of rejected rows, and the layout that lets a read of one station skip most of a month."""

from __future__ import annotations

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from tidewright.operators import quality
from tidewright.plans import jobs
from tidewright.sinks import tables


def test_reasons_and_folders(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", "2024-01-01", "1", "2", "3", "x"), (None, "soon", "1", "east", "3", None), ("c", "2024-01-01", "", "2", "nan", "1"), ("d", "2024-01-02", "1", "2", None, "4")],
        "station_id string, datetime string, latitude string, longitude string, wave_height string, average_period string",
    )
    # columns that are absent (two measures) are no fault; extra ones are left out
    got = {r["station_id"]: (r["valid"], [tuple(x) for x in r["reasons"]]) for r in quality.flag_reasons(df.withColumn("valid", F.lit("?"))).collect()}
    assert got["a"] == (True, [("average_period", "not a double")])
    assert got["c"] == (False, [("latitude", "not a double")])
    assert got["d"] == (True, [])
    assert got[None] == (False, [("station_id", "missing"), ("datetime", "not a timestamp_ntz"), ("longitude", "not a double")])
    assert quality.flag_reasons(df.drop("latitude")).where("array_contains(reasons.field, 'latitude')").count() == 4

    target = f"{tmp_path}/validated"
    jobs.store_validated(df, target)
    assert rows(jobs.stored_verdict(spark, target, "accepted").select("station_id")) == [("a",), ("d",)]
    assert jobs.stored_verdict(spark, target, "rejected").select(F.explode("reasons")).count() == 4
    jobs.store_validated(df.where("false"), target)
    assert jobs.stored_verdict(spark, target, "rejected").count() == 0


def scanned(df) -> int:
    """Rows that the Parquet scan handed on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


def test_one_station_reads_a_part_of_its_month(spark, tmp_path):
    target = f"{tmp_path}/obs"
    at = F.timestamp_add("MINUTE", (F.col("id") % 40_000).cast("int"), F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
    df = spark.range(100_000).select(
        (F.col("id") % 50).cast("string").alias("station_id"), at.alias("datetime"),
        *[F.rand(c).alias(n) for c, n in enumerate(["latitude", "longitude", "wave_height", "dominant_period", "average_period", "mean_wave_direction"])],
    )
    tables.append_observations(df, target)
    stored = tables.stored_observations(spark, target).where("_month = '202401'")
    one = stored.where("station_id = '7'")
    want = df.where("station_id = '7'").count()
    assert one.count() == want == 2000
    assert scanned(one) < 0.3 * scanned(stored)
    assert scanned(stored.where("station_id = 'none'")) == 0

    # a batch of few stations is compared with theirs, and nothing is stored twice
    batch = df.where("station_id in ('7', '8')").withColumn("wave_height", F.lit(9.0))
    late = batch.limit(3).withColumn("datetime", F.lit(dt.datetime(2024, 2, 3)).cast("timestamp_ntz"))
    assert tables.insert_observations_if_absent(batch.unionByName(late.where("station_id = '7'").limit(1)), target) <= 1
    assert tables.stored_observations(spark, target).where("wave_height = 9.0 and _month = '202401'").count() == 0
