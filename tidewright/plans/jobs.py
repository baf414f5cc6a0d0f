"""Jobs: the compositions that a scheduler submits."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.columns import decode_scaled
from tidewright.operators import clustering, consistency, enrich, forecast, lagged, merge, nearest, quality
from tidewright.plans import queries
from tidewright.schemas import OBSERVATION, STATION_TABLE
from tidewright.session import materialize
from tidewright.sinks import tables
from tidewright.sources import buoy_text, catalogue, grids


def observations_from(parsed: DataFrame, stations: DataFrame) -> DataFrame:
    """Parsed rows to observations: valid rows, merged per key, with coordinates."""
    merged = merge.first_non_null(parsed.where("valid"), buoy_text.ORDER)
    return enrich.enrich_coordinates(merged, stations).select(*OBSERVATION.fieldNames())


def daily_buoy_asset(
    spark: SparkSession,
    landing: str,
    stations: str,
    observations: str,
    assets: str,
    as_of: dt.datetime,
    partition_key: str | None = None,
) -> dict[str, object]:
    """Ingest the landed files of known stations, then store and report the last day. Files that cannot be read
    are passed over; stations that have nothing else count as failed."""
    known = tables.read_table(spark, stations, STATION_TABLE)
    ids = enrich.distinct_stations(known)
    scanned = buoy_text.scan_buoy_files(spark, landing, skip_corrupt=True).join(ids, "station_id", "left_semi")
    files = buoy_text.landed_files(spark, landing).join(ids, "station_id", "left_semi")
    parsed = materialize(scanned, "parsed")  # read by the merge and by the report
    inserted = tables.insert_observations_if_absent(observations_from(parsed, known), observations)
    recent = queries.last_day(tables.stored_observations(spark, observations), as_of).select(
        *OBSERVATION.fieldNames()
    )
    written = tables.write_asset(recent, "raw_buoy_data", assets, as_of, partition_key)
    metrics = quality.quality_metrics(recent).first().asDict()
    totals = quality.ingest_totals(quality.ingest_report(parsed, files)).first().asDict()
    metrics["time_range"] = f"{metrics['min_datetime']} to {metrics['max_datetime']}"
    return {"inserted": inserted, **metrics, **totals, **written}


def station_refresh(spark: SparkSession, catalogue_path: str, target: str, as_of: dt.datetime) -> None:
    found = catalogue.scan_station_catalogue(spark, catalogue_path)
    tables.upsert_stations(catalogue.meteorological_stations(found), target, as_of)


def consistency_labelling(spark: SparkSession, observations: str, target: str) -> None:
    obs = tables.read_observations(spark, observations)
    queries.store_consistency(consistency.consistency_trends(obs), target)


def cluster_job(spark: SparkSession, observations: str, target: str, k: int | None = None) -> DataFrame:
    """Store the clustered observations; returns the per-station cluster histogram."""
    obs = tables.read_observations(spark, observations)
    tables.replace(clustering.cluster_observations(obs, k=k), target)
    return clustering.cluster_histogram(tables.read_table(spark, target))


@dataclass(frozen=True)
class ForecastResult:
    model: forecast.LagModel
    evaluation: DataFrame
    forecast: DataFrame


def forecast_job(obs: DataFrame, mode: str = "next") -> ForecastResult:
    """Train on lag features, evaluate, and forecast.

    `next` forecasts the step after each station's last row. `refit_last` takes all
    stations as one series and predicts its last observed step.
    """
    per_station = mode == "next"
    features = materialize(lagged.lag_features(obs, per_station=per_station), "lags")
    model, evaluation = forecast.train_and_evaluate(features)
    ahead = forecast.forecast_next if per_station else forecast.forecast_refit_last
    return ForecastResult(model, evaluation, ahead(model, obs))


def model_sampling(
    grid: DataFrame,
    spots: DataFrame,
    start: dt.datetime,
    end: dt.datetime,
    params: Mapping[str, str] | None = None,
    interval_hours: int = 6,
    geometry: Sequence[str] | None = None,
) -> DataFrame:
    """Wide samples at every spot, for the model runs between two instants.

    Fields that share a grid are searched once if `geometry` names the columns that tell grids
    apart (none for one grid).
    """
    spark = grid.sparkSession
    runs = grids.run_manifest(spark, start, end, interval_hours)
    wanted = grids.grid_values(grid).join(
        runs.withColumnRenamed("run_ts", "analysis_ts"), "analysis_ts", "left_semi"
    )
    return nearest.swell_rows(nearest.nearest_grid_value(wanted, spots, geometry=geometry), params)


def store_samples(samples: DataFrame, target: str) -> None:
    tables.append(samples, target)


def coverage_job(spark: SparkSession, catalogue_path: str, stations: str) -> DataFrame:
    found = catalogue.scan_station_catalogue(spark, catalogue_path).drop("doc_order", "met")
    return enrich.station_coverage(found, tables.read_table(spark, stations, STATION_TABLE))


def satellite_decode(raw: DataFrame) -> DataFrame:
    """Long satellite table (`raw`, `scale_factor`, `fill_value`) with physical values."""
    return raw.withColumn("value", decode_scaled("raw", F.col("scale_factor"), F.col("fill_value")))


def store_validated(rows: DataFrame, target: str) -> None:
    """Good rows and rejects with their reasons in one pass, as two folders of one table."""
    flagged = quality.flag_reasons(rows)
    verdict = F.when(F.col("valid"), "accepted").otherwise("rejected")
    tables.replace(flagged.withColumn(quality.VERDICT, verdict).drop("valid"), target, [quality.VERDICT])


def stored_verdict(spark: SparkSession, target: str, verdict: str) -> DataFrame:
    """The `accepted` or the `rejected` rows that `store_validated` left; the other folder is not read."""
    return tables.read_table(spark, target).where(F.col(quality.VERDICT) == verdict).drop(quality.VERDICT)
