"""The queries by name: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.columns import cycle_floor, instant
from tidewright.operators import (
    clustering,
    consistency,
    enrich,
    forecast,
    lagged,
    merge,
    nearest,
    quality,
    quantiles,
)
from tidewright.operators.silhouette import euclidean_silhouettes
from tidewright.plans import adapters, jobs, queries
from tidewright.schemas import KEY, MEASURES, OBSERVATION, POSITION, STATION_TABLE, STD_COLUMNS
from tidewright.session import materialize, scratch_path
from tidewright.sinks import tables
from tidewright.sources import buoy_text, catalogue, grids
from tidewright.streaming import ingest, keyed

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
# Where the labelled months of a session and scale are stored.
_TRENDS: dict[tuple[str, str], str] = {}

# Fixed instants, so that results do not depend on the clock.
AS_OF = dt.datetime(2024, 1, 30, 12)
NOW = dt.datetime(2025, 1, 1)
SPLIT = dt.datetime(1998, 7, 1)
RUN_AS_OF = dt.datetime(2024, 12, 15, 2)


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.single_frame_first(adapters.observations(spark, sf_dir), adapters.ROW_ORDER)


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_coordinates(
        adapters.observations(spark, sf_dir), adapters.stations(spark, sf_dir)
    )


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged observations as a written table, as the jobs that read them several times have it."""
    return materialize(merged(spark, sf_dir), "observations")


def observation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_coordinates(merged(spark, sf_dir), adapters.stations(spark, sf_dir)).select(
        *OBSERVATION.fieldNames()
    )


# --- reading and merging ----------------------------------------------------------------


@query
def merge_first_nonnull(spark, sf_dir):
    return merge.first_non_null(adapters.source_rows(spark, sf_dir), adapters.ROW_ORDER)


@query
def union_sources(spark, sf_dir):
    """Three written source tables that lack different columns; each is read once."""
    rows = adapters.observations(spark, sf_dir).select("l_orderkey", "src", *KEY, *MEASURES)
    path = scratch_path(spark, "sources")
    rows.write.partitionBy("src").parquet(path)
    kept = {0: ["wave_height", "average_period", "mean_wave_direction"], 1: MEASURES, 2: ["wave_height", "dominant_period"]}
    frames = [
        spark.read.schema(rows.drop("src").schema).parquet(f"{path}/src={src}").select("l_orderkey", *KEY, *own).withColumn("src", F.lit(src))
        for src, own in kept.items()
    ]
    return merge.union_sources(*frames).select("l_orderkey", "src", *KEY, *MEASURES)


@query
def single_frame_first(spark, sf_dir):
    """Events of one user and day are one observation: the first value of each measure counts."""
    rows = adapters.events(spark, sf_dir).withColumn("datetime", F.date_trunc("day", "datetime").cast("timestamp_ntz"))
    return merge.single_frame_first(rows, ["event_id"])


def _parsed(spark, sf_dir, layout):
    lines = adapters.rendered(adapters.events(spark, sf_dir), layout, "event_id", "station_id")
    return buoy_text.parse_layout(lines, layout)


@query
def parse_txt_lines(spark, sf_dir):
    return _parsed(spark, sf_dir, "txt").select(
        "event_id", "station_id", "datetime", "WVHT", "DPD", "APD", "MWD", "TIDE"
    )


@query
def parse_spec_lines(spark, sf_dir):
    return _parsed(spark, sf_dir, "spec").select(
        "event_id", "station_id", "datetime", "WVHT", "APD", "MWD", "STEEPNESS"
    )


@query
def parse_drift_lines(spark, sf_dir):
    return _parsed(spark, sf_dir, "drift").select(
        "event_id", "station_id", "datetime", "LAT", "LON", "WVHT", "DPD"
    )


@query
def landing_scan(spark, sf_dir):
    parsed = buoy_text.scan_buoy_files(spark, adapters.write_landing(spark, sf_dir))
    return merge.first_non_null(parsed.where("valid"), buoy_text.ORDER)


@query
def ingest_report(spark, sf_dir):
    rows = adapters.events(spark, sf_dir)
    lines = adapters.rendered(rows, "txt", "event_id", "station_id")
    broken = F.regexp_replace("value", r"^(\d+) \d+", "$1 13")
    lines = lines.withColumn(
        "value", F.when(F.col("event_id") % 11 == 0, broken).otherwise(F.col("value"))
    )
    return quality.ingest_report(buoy_text.parse_observations(lines, "txt"))


@query
def ingest_report_files(spark, sf_dir):
    """The report of landed files: every seventh station has files with headings only, every fifth also a
    file of an unknown layout."""
    rows = adapters.landed_events(spark, sf_dir)
    number = F.col("station_id").cast("bigint")
    landing = adapters.write_landing(spark, sf_dir, rows.where(number % 7 != 0))
    stations = rows.select("station_id").distinct()
    heading = stations.where(number % 7 == 0).select(F.lit("#YY MM DD hh mm").alias("value"), F.lit("txt").alias("src"), "station_id")
    odd = stations.where(number % 5 == 0).select(F.lit("?").alias("value"), F.lit("log").alias("src"), "station_id")
    heading.unionByName(odd).write.mode("append").partitionBy("src", "station_id").text(landing)
    return quality.ingest_report(buoy_text.scan_buoy_files(spark, landing), buoy_text.landed_files(spark, landing))


@query
def stream_ingest(spark, sf_dir):
    """Two overlapping deliveries: the first lacks half of the rows and some wave heights, the second
    brings all rows with other periods. What is stored stays; gaps are filled. Compacted after each."""
    log, offsets = scratch_path(spark, "log"), scratch_path(spark, "offsets")
    rows = adapters.landed_events(spark, sf_dir)
    first = rows.where("event_id % 2 = 0").withColumn("wave_height", F.expr("case when event_id % 4 > 0 then wave_height end"))
    second = rows.withColumn("average_period", F.col("average_period") + 100)
    landing = None
    for delivery in (first, second):
        landing = adapters.write_landing(spark, sf_dir, delivery, landing)
        for _ in range(2):  # the second run finds no new files
            ingest.ingest_landing(spark, landing, log, offsets).awaitTermination()
        ingest.compact(spark, log)
    return ingest.merged_observations(spark, log)


@query
def stream_keyed(spark, sf_dir):
    """Two deliveries through keyed state; the second also brings rows of the first days, which are too late.
    Next to what is stored stands how many keys were."""
    target, offsets = scratch_path(spark, "final"), scratch_path(spark, "offsets")
    rows = adapters.landed_events(spark, sf_dir)
    late = (F.col("event_id") % 10 == 0) & (F.col("datetime") < F.lit("2024-01-10"))
    early = F.col("datetime") < F.lit("2024-01-16")
    landing, missed = None, 0
    for delivery in (rows.where(~late & early), rows.where(late | ~early)):
        landing = adapters.write_landing(spark, sf_dir, delivery, landing)
        run = keyed.ingest_keyed(spark, landing, target, offsets)
        run.awaitTermination()
        missed += keyed.late_keys(spark, run)
    return keyed.final_observations(spark, target).withColumn("late_keys", F.lit(missed).cast("long"))


@query
def station_catalogue(spark, sf_dir):
    found = catalogue.scan_station_catalogue(spark, adapters.write_catalogue(spark, sf_dir))
    return catalogue.meteorological_stations(found)


@query
def spot_scan(spark, sf_dir):
    return catalogue.scan_spots(spark, adapters.write_spots(spark, sf_dir))


@query
def observation_scan(spark, sf_dir):
    return queries.short_named(located(spark, sf_dir))


@query
def ordered_series(spark, sf_dir):
    return queries.ordered_series(adapters.events(spark, sf_dir))


# --- stations and coordinates -----------------------------------------------------------


@query
def enrich_coordinates(spark, sf_dir):
    return located(spark, sf_dir).select("l_orderkey", "l_linenumber", *KEY, *POSITION, *MEASURES)


@query
def station_coverage(spark, sf_dir):
    everyone = adapters.stations(spark, sf_dir)
    listed = everyone.select("station_id", (F.col("latitude") + 0.5).alias("latitude"), "longitude")
    return enrich.station_coverage(listed, everyone.where("met"))


@query
def station_refresh(spark, sf_dir):
    """The refresh job on a written catalogue, twice: what the station table holds."""
    target = scratch_path(spark, "station-table")
    catalogue_path = adapters.write_catalogue(spark, sf_dir)
    for when in (dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)):
        jobs.station_refresh(spark, catalogue_path, target, when)
    return tables.read_table(spark, target, STATION_TABLE)


@query
def coverage_job(spark, sf_dir):
    """Which stations of a written catalogue the refreshed station table has."""
    target = scratch_path(spark, "station-table")
    catalogue_path = adapters.write_catalogue(spark, sf_dir)
    jobs.station_refresh(spark, catalogue_path, target, dt.datetime(2024, 1, 1))
    return jobs.coverage_job(spark, catalogue_path, target)


@query
def distinct_stations(spark, sf_dir):
    return enrich.distinct_stations(adapters.observations(spark, sf_dir))


@query
def first_stations(spark, sf_dir):
    return enrich.first_stations(adapters.observations(spark, sf_dir), 10)


@query
def stations_all(spark, sf_dir):
    return queries.stations(adapters.stations(spark, sf_dir))


@query
def station_upsert(spark, sf_dir):
    target = scratch_path(spark, "station-table")
    everyone = adapters.stations(spark, sf_dir)
    tables.upsert_stations(everyone.where("met"), target, dt.datetime(2024, 1, 1))
    moved = everyone.withColumn("latitude", F.expr("latitude + cast(station_id as int) % 2"))
    tables.upsert_stations(moved, target, dt.datetime(2024, 2, 1))
    return tables.read_table(spark, target, STATION_TABLE)


@query
def station_insert_if_absent(spark, sf_dir):
    target = scratch_path(spark, "station-table")
    everyone = adapters.stations(spark, sf_dir)
    tables.insert_stations_if_absent(everyone.where("met"), target, dt.datetime(2024, 1, 1))
    twice = everyone.unionByName(everyone.withColumn("latitude", F.col("latitude") + 1))
    tables.insert_stations_if_absent(twice, target, dt.datetime(2024, 2, 1))
    return tables.read_table(spark, target, STATION_TABLE)


# --- quality ----------------------------------------------------------------------------


@query
def quality_metrics(spark, sf_dir):
    metrics = quality.quality_metrics(adapters.observations(spark, sf_dir))
    return rounded(metrics, 6, "missing_data_pct")


@query
def row_validation(spark, sf_dir):
    rows = located(spark, sf_dir).withColumns(
        {
            "latitude": F.expr("case when l_linenumber <> 2 then latitude end"),
            "mean_wave_direction": F.expr(
                "case when l_linenumber = 3 then 'NNE' else cast(mean_wave_direction as string) end"
            ),
        }
    )
    return quality.flag_valid(rows).withColumnRenamed("valid", "accepted")


@query
def row_validation_reasons(spark, sf_dir):
    """Rows with faults of several kinds, stored in one pass; each reason of each folder is a row."""
    faults = {
        "latitude": "case when l_linenumber <> 2 then cast(latitude as string) end",
        "longitude": "case when l_orderkey % 5 = 0 then 'west' else cast(longitude as string) end",
        "mean_wave_direction": "case when l_linenumber = 3 then 'NNE' else cast(mean_wave_direction as string) end",
    }
    rows = located(spark, sf_dir).withColumns({c: F.expr(e) for c, e in faults.items()})
    target = scratch_path(spark, "validated")
    jobs.store_validated(rows, target)
    both = [jobs.stored_verdict(spark, target, v).withColumn("verdict", F.lit(v)) for v in ("accepted", "rejected")]
    stated = both[0].unionByName(both[1]).select(
        "verdict", "latitude", "longitude", "mean_wave_direction", F.posexplode_outer("reasons").alias("place", "r")
    )
    found = stated.groupBy("verdict", "place", "r.field", "r.reason")
    return found.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(c).alias(f"with_{c}") for c in ("latitude", "longitude", "mean_wave_direction")],
    )


# --- consistency ------------------------------------------------------------------------


@query
def monthly_std(spark, sf_dir):
    monthly = consistency.monthly_std_dev(adapters.observations(spark, sf_dir))
    return rounded(monthly, 6, *STD_COLUMNS)


@query
def station_location(spark, sf_dir):
    rows = located(spark, sf_dir)
    monthly = consistency.monthly_std_dev(rows).select("station_id", "month")
    return consistency.with_locations(monthly, consistency.station_locations(rows))


def trends(spark, sf_dir):
    return consistency.consistency_trends(located(spark, sf_dir))


@query
def consistency_labels(spark, sf_dir):
    return rounded(rounded(trends(spark, sf_dir), 6, *STD_COLUMNS), 4, "consistency_score")


@query
def consistency_scaled(spark, sf_dir):
    """The score by the component of the scaled spreads."""
    found = consistency.consistency_trends(located(spark, sf_dir), scale=True)
    return rounded(found.select("station_id", "month", "consistency_score"), 4, "consistency_score")


@query
def consistency_finite(spark, sf_dir):
    """Of scores that are NULL, NaN or infinite either way the feed shows none."""
    score = (
        "case o_orderkey % 7 when 0 then null when 1 then double('NaN') when 2 then double('Infinity') "
        "when 3 then double('-Infinity') else o_totalprice end"
    )
    rows = adapters.table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) as station_id", "cast(date_trunc('month', o_orderdate) as timestamp_ntz) as month",
        "0D as latitude", "0D as longitude", "'High Consistency' as consistency_label", f"{score} as consistency_score",
    )
    return queries.consistency(rows, "1996-03", "1997-10").select("station_id", "month", "consistency_score")


def trends_table(spark, sf_dir):
    """The table that the labelling job leaves, which the read queries look into: written once per
    session, and again where the scratch folder has been expired."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRENDS or not tables.table_exists(spark, _TRENDS[key]):
        target = scratch_path(spark, "trends")
        queries.store_consistency(trends(spark, sf_dir), target)
        _TRENDS[key] = target
    return queries.stored_consistency(spark, _TRENDS[key])


@query
def consistency_feed(spark, sf_dir):
    rows = queries.consistency(trends_table(spark, sf_dir), "1996-03", "1997-10")
    return rounded(rows, 4, "consistency_score")


@query
def consistency_map(spark, sf_dir):
    return queries.consistency_map(trends_table(spark, sf_dir))


@query
def consistency_popups(spark, sf_dir):
    # Scores of the trends are unbounded; order prices scaled to 0..1 reach every band.
    rows = adapters.table(spark, sf_dir, "orders").selectExpr(
        "cast(o_custkey as string) as station_id",
        "o_orderdate as month",
        "least(1.0D, o_totalprice / 400000) as consistency_score",
        "cast(o_custkey % 90 as double) as latitude",
        "cast(o_orderkey % 180 as double) as longitude",
    )
    return queries.consistency_popups(rows)


@query
def score_join(spark, sf_dir):
    monthly = consistency.monthly_std_dev(adapters.observations(spark, sf_dir))
    scores = monthly.dropna().select(
        "station_id", "month", F.col("mwd_monthly_std").alias("consistency_score")
    )
    joined = consistency.attach_scores(monthly, scores)
    return rounded(joined.select("station_id", "month", "consistency_score"), 6, "consistency_score")


@query
def tertile_scores(spark, sf_dir):
    rows = adapters.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return quantiles.with_tertiles(rows, "o_totalprice", "consistency_label")


@query
def tertile_ties(spark, sf_dir):
    """Nineteen different scores, and some that are NULL, NaN: many rows share each edge."""
    score = "case when o_orderkey % 13 = 0 then null when o_orderkey % 17 = 0 then cast('NaN' as double) else o_custkey % 19 / 7.0D end"
    rows = adapters.table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{score} as score")
    labelled = quantiles.with_tertiles(rows, "score", "consistency_label")
    return labelled.select("o_orderkey", "consistency_label")


# --- read queries -----------------------------------------------------------------------


@query
def wave_data_range(spark, sf_dir):
    return queries.wave_data(adapters.events(spark, sf_dir), "2024-01-05", "2024-01-20", now=NOW)


@query
def wave_data_station(spark, sf_dir):
    rows = adapters.events(spark, sf_dir)
    return queries.wave_data(rows, "2024-01-01", "2024-01-31", "42", now=NOW, end_inclusive_day=True)


@query
def range_checks(spark, sf_dir):
    """Date ranges that are taken, with their rows, and those that are not, with the reason."""
    rows, found = adapters.events(spark, sf_dir), []
    asked = [("2024-01-05", "2024-01-20"), ("2024-01-20", "2024-01-05"), ("2024-1-x", "2024-01-05"), ("2023-01-01", "2024-01-02"), ("2024-12-20", "2025-01-02")]
    for start, end in asked:
        try:
            count = queries.wave_data(rows, start, end, now=NOW).agg(F.count(F.lit(1)).alias("n"))
            found.append(count.select(F.lit(start).alias("start_date"), F.lit(end).alias("end_date"), "n", F.lit(None).cast("string").alias("refused")))
        except ValueError as error:
            found.append(spark.createDataFrame([(start, end, None, str(error))], "start_date string, end_date string, n long, refused string"))
    return reduce(DataFrame.unionByName, found)


@query
def last_day(spark, sf_dir):
    return queries.last_day(adapters.events(spark, sf_dir), AS_OF).select("event_id", *KEY, *MEASURES)


# --- gridded fields ---------------------------------------------------------------------


def nearest_samples(spark, sf_dir):
    grid = grids.grid_values(adapters.grid(spark, sf_dir))
    return nearest.nearest_grid_value(grid, adapters.spots(spark, sf_dir))


@query
def nearest_grid_value(spark, sf_dir):
    return nearest_samples(spark, sf_dir).drop("analysis_ts", "forecast_hours")


@query
def nearest_shared_grid(spark, sf_dir):
    """Two fields on one grid of all parts: searched once, values looked up per field."""
    points = grids.grid_values(adapters.grid(spark, sf_dir)).select("grid_idx", "lat", "lon", "value")
    grid = points.withColumn("parts", F.explode(F.array(F.lit(1), F.lit(2)))).withColumns(
        {"param": F.when(F.col("parts") == 1, "full").otherwise("half"), "value": F.expr("value / parts")}
    )
    return nearest.nearest_grid_value(
        grid, adapters.spots(spark, sf_dir), message=["param"], geometry=[]
    )


@query
def nearest_on_sphere(spark, sf_dir):
    """Along great circles: the spots, and as many again on both sides of 180 degrees."""
    points = grids.grid_values(adapters.grid(spark, sf_dir)).select("grid_idx", "lat", "lon", "value")
    spots = adapters.spots(spark, sf_dir)
    edge = "case when cast(country as int) % 2 = 0 then 178.5 else -178.5 end"
    across = spots.selectExpr("concat(name, ' edge') as name", "country", "lat", f"cast({edge} as double) as lng")
    found = nearest.nearest_grid_value(points, spots.unionByName(across), message=[], geometry=[], sphere=True)
    return found.withColumn("km", F.round(nearest.great_circle_km(F.col("dist2")), 6)).drop("dist2")


@query
def swell_rows(spark, sf_dir):
    return nearest.swell_rows(nearest_samples(spark, sf_dir), adapters.BRAND_PARAMS)


@query
def swell_wide(spark, sf_dir):
    return nearest.swell_wide(nearest_samples(spark, sf_dir), adapters.BRAND_PARAMS)


@query
def model_samples(spark, sf_dir):
    start = adapters.ANALYSIS_TS - dt.timedelta(hours=12)
    grid, spots = adapters.grid(spark, sf_dir), adapters.spots(spark, sf_dir)
    target = scratch_path(spark, "swell")
    samples = jobs.model_sampling(grid, spots, start, adapters.ANALYSIS_TS, adapters.BRAND_PARAMS)
    jobs.store_samples(samples, target)
    return tables.read_table(spark, target)


@query
def decode_values(spark, sf_dir):
    raw = adapters.table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "p_retailprice as raw",
        "case when p_size % 5 <> 0 then cast(p_size as double) end as scale_factor",
        "case when p_size % 3 = 0 then p_retailprice when p_size % 3 = 1 then -1D end as fill_value",
    )
    return jobs.satellite_decode(raw).select("p_partkey", "value")


@query
def grid_scan(spark, sf_dir):
    """The grid as a stored table, read by its scan."""
    path = scratch_path(spark, "grid")
    adapters.grid(spark, sf_dir).write.parquet(path)
    found = grids.grid_metadata(grids.scan_grid(spark, path))
    return found.select("param", "units", "grid_idx", "lat", "lon", "value", "data_date", "data_time", "forecast_time")


@query
def grid_ravel(spark, sf_dir):
    """The grid as one message of arrays per field, a hundred keys a row, taken apart again."""
    point = F.struct("grid_idx", "lat", "lon", "value")
    field = ["param", "units", "analysis_ts", "forecast_hours"]
    rows = adapters.grid(spark, sf_dir).groupBy(*field, F.floor(F.col("grid_idx") / 100).alias("row"))
    rows = rows.agg(F.array_sort(F.collect_list(point)).alias("points")).groupBy(*field)
    rows = rows.agg(F.array_sort(F.collect_list(F.struct("row", "points"))).alias("rows"))
    part = lambda name: F.transform("rows", lambda r: F.transform(r["points"], lambda p: p[name])).alias(name)
    found = grids.ravel(rows.select(*field, part("lat"), part("lon"), part("value").alias("values")))
    return found.select("param", "units", "grid_idx", "lat", "lon", "value")


@query
def param_listing(spark, sf_dir):
    return grids.available_parameters(adapters.grid(spark, sf_dir))


@query
def run_manifest(spark, sf_dir):
    bounds = (
        adapters.events(spark, sf_dir)
        .groupBy("station_id")
        .agg(cycle_floor(F.min("datetime")).alias("start"), F.max("datetime").alias("end"))
    )
    return grids.runs_between(bounds).select(
        "station_id",
        "run_ts",
        grids.run_file_name(F.col("run_ts")).alias("archive_file"),
        grids.local_file_name(F.col("run_ts")).alias("local_file"),
    )


@query
def cycle_files(spark, sf_dir):
    rows = adapters.events(spark, sf_dir)
    return rows.select(
        "event_id",
        cycle_floor("datetime").alias("cycle"),
        grids.cycle_file_name(F.col("datetime"), F.col("event_id") % 1200, "gfswave", "atlocn").alias(
            "archive_file"
        ),
    )


# --- lags and forecast ------------------------------------------------------------------


@query
def lag_features(spark, sf_dir):
    return lagged.lag_features(adapters.events(spark, sf_dir))


@query
def lag_features_all_stations(spark, sf_dir):
    return lagged.lag_features(adapters.events(spark, sf_dir), per_station=False, complete=False)


@query
def lag_features_untidy(spark, sf_dir):
    return lagged.lag_features(adapters.untidy_series(spark, sf_dir), complete=False)


@query
def lag_features_untidy_all(spark, sf_dir):
    return lagged.lag_features(adapters.untidy_series(spark, sf_dir), per_station=False, bucket="year", complete=False)


@query
def latest_untidy(spark, sf_dir):
    return lagged.latest_per_station(adapters.untidy_series(spark, sf_dir))


@query
def latest_per_station(spark, sf_dir):
    return lagged.latest_per_station(adapters.events(spark, sf_dir))


@query
def forecast_mse(spark, sf_dir):
    return rounded(jobs.forecast_job(stored(spark, sf_dir)).evaluation, 5, "mse")


@query
def forecast_next(spark, sf_dir):
    return rounded(jobs.forecast_job(stored(spark, sf_dir)).forecast, 5, "forecast")


@query
def forecast_refit_last(spark, sf_dir):
    result = jobs.forecast_job(stored(spark, sf_dir), mode="refit_last").forecast
    return rounded(result.select("station_id", "datetime", "forecast"), 5, "forecast")


# --- clustering -------------------------------------------------------------------------


@query
def impute_scale(spark, sf_dir):
    scaled = clustering.impute_scale(adapters.observations(spark, sf_dir))
    names = [f"{m}_scaled" for m in MEASURES]
    return rounded(scaled.select("l_orderkey", "l_linenumber", *names), 6, *names)


@query
def sample_rows(spark, sf_dir):
    return clustering.sample_rows(stored(spark, sf_dir), 60_000)


def regimes(spark, sf_dir):
    return materialize(adapters.regimes(spark, sf_dir), "regimes")


@query
def kmeans_clusters(spark, sf_dir):
    """All rows with their cluster; the number of clusters is chosen."""
    return clustering.cluster_observations(regimes(spark, sf_dir)).select("o_orderkey", "cluster")


@query
def kmeans_centres(spark, sf_dir):
    found = clustering.cluster_observations(regimes(spark, sf_dir), k=5)
    return found.groupBy("cluster").agg(F.count("*").alias("n"), *[F.round(F.avg(m), 6).alias(m) for m in MEASURES])


@query
def silhouette_by_k(spark, sf_dir):
    """The chosen number of clusters and its silhouette."""
    obs = regimes(spark, sf_dir)
    scaling = clustering.fit_scaling(obs)
    scores = clustering.silhouettes(scaling.apply(obs), scaling.outputs)
    best = clustering.best_k(scores)
    return spark.createDataFrame([(k, round(s, 6)) for k, s in scores if k == best], "k int, silhouette double")


@query
def silhouette_euclidean(spark, sf_dir):
    """Euclidean silhouettes on the sample: five given clusterings and the one that K-means finds for k = 5."""
    obs = regimes(spark, sf_dir)
    scaling = clustering.fit_scaling(obs)
    priority = F.substring("p", 1, 1).cast("int")
    scaled = scaling.apply(obs).join(
        adapters.table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderpriority as p"), "o_orderkey"
    )
    sample = clustering.sample_rows(scaled, key=["o_orderkey"])
    model = clustering.fit_kmeans(clustering.fixed_layout(scaled, scaling.outputs), 5)
    found = clustering.with_cluster(model, clustering.with_features(sample, scaling.outputs)).withColumns(
        {f"by_{k}": (priority * 3 + F.col("o_orderkey") % 2) % k for k in clustering.CLUSTER_RANGE}
    )
    names = ["cluster", *[f"by_{k}" for k in clustering.CLUSTER_RANGE]]
    scores = euclidean_silhouettes(found, scaling.outputs, names)
    return spark.createDataFrame([(n, round(s, 6)) for n, s in zip(names, scores)], "clustering string, silhouette double")


@query
def cluster_histogram(spark, sf_dir):
    return clustering.cluster_histogram(clustering.cluster_observations(regimes(spark, sf_dir), k=5))


# --- stored tables ----------------------------------------------------------------------


@query
def insert_if_absent(spark, sf_dir):
    target = scratch_path(spark, "observations")
    rows = materialize(observation_table(spark, sf_dir), "obs")
    tables.append_observations(rows.where(F.col("datetime") < instant(SPLIT)), target)
    again = rows.where(F.col("datetime") >= instant(SPLIT - dt.timedelta(days=400)))
    changed = again.withColumn("average_period", F.col("average_period") + 1000)
    twice = changed.unionByName(changed.withColumn("average_period", F.col("average_period") + 1))
    tables.insert_observations_if_absent(twice, target)
    return tables.read_observations(spark, target)


def _written_assets(spark, sf_dir):
    base = scratch_path(spark, "assets")
    rows = materialize(observation_table(spark, sf_dir), "obs")
    early = rows.where(F.col("datetime") < instant(SPLIT))
    late = rows.where(F.col("datetime") >= instant(SPLIT))
    for part, key in [(late, "199806"), (late, "200112"), (early, "199806")]:
        tables.write_asset(part, "raw_buoy_data", base, RUN_AS_OF, key)
    return base


@query
def partition_rewrite(spark, sf_dir):
    base = _written_assets(spark, sf_dir)
    return tables.read_table(spark, f"{base}/{tables.asset_table('raw_buoy_data')}", tables.ASSET_SCHEMAS["raw_buoy_data"])


@query
def catalog_table(spark, sf_dir):
    """A table by name: made twice, filled twice, and whether it was there before and after."""
    name = f"stations_{uuid.uuid4().hex}"
    rows = adapters.stations(spark, sf_dir).select("station_id", "latitude", "longitude")
    before = tables.table_exists(spark, name)
    for _ in range(2):
        tables.create_table(spark, name, rows.schema, location=scratch_path(spark, "catalog-table"))
    tables.append(rows, name)
    tables.append(rows.withColumn("latitude", F.col("latitude") + 1), name)
    found = tables.read_table(spark, name)
    return found.withColumns({"before": F.lit(before), "after": F.lit(tables.table_exists(spark, name))})


@query
def asset_metadata(spark, sf_dir):
    """What the sink reports of each write."""
    base = scratch_path(spark, "assets")
    rows = materialize(observation_table(spark, sf_dir), "obs")
    found = []
    for key, part in (("199806", rows.where(F.col("datetime") < instant(SPLIT))), ("200112", rows), ("200201", rows.where("false"))):
        written = tables.write_asset(part, "raw_buoy_data", base, RUN_AS_OF, key)
        found.append((written["table"], written["partition"], written["row_count"], len(written["columns"])))
    return spark.createDataFrame(found, "table string, partition string, row_count long, n_columns int")


@query
def asset_reload(spark, sf_dir):
    return tables.load_asset(spark, "raw_buoy_data", _written_assets(spark, sf_dir), "199806")


@query
def result_replace(spark, sf_dir):
    target = scratch_path(spark, "trends")
    rows = trends(spark, sf_dir)
    for _ in range(2):
        queries.store_consistency(rows, target)
    return rounded(rounded(queries.load_consistency(spark, target), 6, *STD_COLUMNS), 4, "consistency_score")


@query
def daily_asset(spark, sf_dir):
    """The whole daily job on landed files: what it stored for the last day."""
    landing = adapters.write_landing(spark, sf_dir)
    stations, obs, assets = (scratch_path(spark, p) for p in ("stations", "obs", "assets"))
    ids = adapters.landed_events(spark, sf_dir).select("station_id").distinct()
    placed = ids.selectExpr(
        "station_id",
        "cast(cast(station_id as bigint) % 90 as double) as latitude",
        "cast(cast(station_id as bigint) % 180 as double) as longitude",
    )
    tables.upsert_stations(placed, stations, AS_OF)
    for _ in range(2):  # the second run finds nothing new
        jobs.daily_buoy_asset(spark, landing, stations, obs, assets, AS_OF, "202401")
    return tables.load_asset(spark, "raw_buoy_data", assets, "202401")
