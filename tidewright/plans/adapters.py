"""Views of the benchmark tables as stations, observations, grids and spots.

Each view exists twice with one meaning: as a DataFrame here and as SQL text in
`oracles`. They only rename and compute columns; no row is left out.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.columns import instant, month_start
from tidewright.schemas import SWELL_MEASURES
from tidewright.session import scratch_path
from tidewright.sources.buoy_text import render_lines

ANALYSIS_TS = dt.datetime(2024, 10, 22)
SOURCES = ["spec", "txt", "drift"]
ROW_ORDER = ["src", "l_orderkey", "l_linenumber", "l_partkey"]

# Brand of the part table -> measure of the wide sample table.
BRAND_PARAMS = {
    f"Brand#{a}{b}": m
    for (a, b), m in zip([(a, b) for a in range(1, 6) for b in range(1, 6)], SWELL_MEASURES)
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem: supplier = station, ship date = time; some wave heights are missing."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_suppkey as string) as station_id",
        "l_shipdate as datetime",
        "case when l_returnflag = 'R' then null else l_quantity end as wave_height",
        "l_discount * 100 as dominant_period",
        "l_tax * 100 as average_period",
        "l_extendedprice % 360 as mean_wave_direction",
        "l_linenumber % 3 as src",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`observations` told apart by source; a source lacks some measures."""
    return observations(spark, sf_dir).withColumns(
        {
            "dominant_period": F.expr("case when src <> 0 then dominant_period end"),
            "average_period": F.expr("case when src <> 2 then average_period end"),
            "mean_wave_direction": F.expr("case when src <> 2 then mean_wave_direction end"),
        }
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events: user = station; measures from the value and the event number."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id as string) as station_id",
        "ts as datetime",
        "value as wave_height",
        "case when event_id % 7 <> 0 then cast(event_id % 20 as double) end as dominant_period",
        "cast(event_id % 13 as double) as average_period",
        "cast(event_id % 360 as double) as mean_wave_direction",
        "event_id",
    )


def landed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as 97 stations, so that a station's files hold many rows and some of them meet at one minute."""
    rows = events(spark, sf_dir)
    return rows.withColumn("station_id", (F.col("station_id").cast("bigint") % 97).cast("string"))


def regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders: customer = station; each of the five priorities is a sea state of its own, far from
    the others, so that any correct clustering finds the priorities."""
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_custkey % 50 as string) as station_id",
        "o_orderdate as datetime",
        "o_orderkey",
        "cast(substring(o_orderpriority, 1, 1) as int) * 10 + o_totalprice % 1 as wave_height",
        "cast(substring(o_orderpriority, 1, 1) as int) * 7 % 5 * 10 + o_custkey % 10 / 10.0D as dominant_period",
        "cast(substring(o_orderpriority, 1, 1) as int) * 3 % 5 * 10 + o_orderkey % 10 / 10.0D as average_period",
        "cast(substring(o_orderpriority, 1, 1) as int) * 4 % 5 * 10 + o_orderkey % 7 / 7.0D as mean_wave_direction",
    )


def untidy_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders: series with a station and times that are NULL, and many rows at one time."""
    return table(spark, sf_dir, "orders").selectExpr(
        "case when o_custkey % 20 > 0 then cast(o_custkey % 20 as string) end as station_id",
        "case when o_orderkey % 50 > 0 then cast(date_trunc('month', o_orderdate) as timestamp_ntz) end as datetime",
        "cast(o_orderkey as double) as wave_height",
        "case when o_orderkey % 11 > 0 then o_totalprice end as dominant_period",
        "cast(o_custkey as double) as average_period",
        "cast(o_orderkey % 360 as double) as mean_wave_direction",
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier: made-up coordinates from the key; `met` from the balance."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey as string) as station_id",
        "cast(s_suppkey * 37 % 180 - 90 as double) as latitude",
        "cast(s_suppkey * 73 % 360 - 180 as double) as longitude",
        "s_acctbal > 0 as met",
    )


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part: each brand is one gridded field."""
    return (
        table(spark, sf_dir, "part")
        .selectExpr(
            "p_brand as param",
            "case when p_brand <> 'Brand#11' then 'm' end as units",
            "p_partkey as grid_idx",
            "cast(p_partkey % 45 * 4 - 90 as double) as lat",
            "cast(p_partkey * 7 % 90 * 4 - 180 as double) as lon",
            "case when p_size = 1 then 9999 else p_retailprice end as value",
        )
        .withColumns(
            {
                "analysis_ts": instant(ANALYSIS_TS),
                "forecast_hours": F.lit(0),
            }
        )
    )


def spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation: made-up coordinates from the key."""
    return table(spark, sf_dir, "nation").selectExpr(
        "n_name as name",
        "cast(n_regionkey as string) as country",
        "cast(n_nationkey * 7 % 180 - 90 as double) as lat",
        "cast(n_nationkey * 14 % 360 - 180 as double) as lng",
    )


def rendered(rows: DataFrame, layout: str, *kept: str) -> DataFrame:
    """Rows as text lines of a layout, next to some of their columns."""
    return rows.select(*kept, render_lines(rows, layout).alias("value"))


def write_landing(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None, path: str | None = None) -> str:
    """Rows (by default all events) as station files in the three layouts, each with its two header
    rows; added to the files of `path` if one is given."""
    rows = (landed_events(spark, sf_dir) if rows is None else rows).withColumn(
        "src", F.element_at(F.array(*[F.lit(s) for s in SOURCES]), (F.col("event_id") % 3 + 1).cast("int"))
    )
    text = F.lit(None).cast("string")
    for layout in SOURCES:
        text = F.when(F.col("src") == layout, render_lines(rows, layout)).otherwise(text)
    # One file per source, station and month, so a station with many rows is many files.
    file = ["src", "station_id", "month"]
    body = rows.select(
        "src", "station_id", month_start("datetime").alias("month"), F.col("event_id").alias("ord"), text.alias("value")
    )
    headers = F.array(F.lit("#YY MM DD hh mm"), F.lit("yr mo dy hr mn"))
    heads = body.select(*file).distinct().select(*file, F.posexplode(headers).alias("pos", "value"))
    heads = heads.withColumn("ord", F.col("pos") - F.lit(2).cast("bigint")).drop("pos")
    path = path or scratch_path(spark, "landing")
    (
        body.unionByName(heads)
        .repartition(*file)
        .sortWithinPartitions("src", "station_id", "month", "ord")
        .select("value", "src", "station_id")
        .write.mode("append")
        .partitionBy("src", "station_id")
        .text(path)
    )
    return path


def write_catalogue(spark: SparkSession, sf_dir: str) -> str:
    """All stations as a catalogue of `<station>` elements."""
    path = scratch_path(spark, "catalogue")
    stations(spark, sf_dir).select(
        F.col("station_id").alias("_id"),
        F.col("latitude").alias("_lat"),
        F.col("longitude").alias("_lon"),
        F.when(F.col("met"), "y").otherwise("n").alias("_met"),
    ).write.format("xml").option("rootTag", "stations").option("rowTag", "station").save(path)
    return path


def write_spots(spark: SparkSession, sf_dir: str) -> str:
    """All spots as JSON arrays, one file each."""
    path = scratch_path(spark, "spots")
    rows = spots(spark, sf_dir).select(F.to_json(F.array(F.struct("*"))).alias("value"))
    rows.write.option("maxRecordsPerFile", 1).text(path)
    return path
