"""Wave-height forecast: linear regression on the previous measures."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators.lagged import lag_names, latest_overall, latest_per_station
from tidewright.operators.moments import moments
from tidewright.schemas import MEASURES

TARGET = "wave_height"


@dataclass(frozen=True)
class LagModel:
    """Intercept and one coefficient per measure; applied as a column expression."""

    measures: Sequence[str]
    intercept: float
    coefficients: Sequence[float]

    def predict(self, columns: Sequence[str]) -> Column:
        total = F.lit(self.intercept)
        for c, b in zip(columns, self.coefficients):
            total = total + F.lit(b) * F.col(c)
        return total


def is_test_row(share: float = 0.2) -> Column:
    """True for a fixed pseudo-random share of the rows, chosen by key.

    The choice depends on (station, timestamp) alone, so it is the same for any
    partitioning, on a retried task, and in another engine.
    """
    key = F.concat_ws("|", "station_id", F.date_format("datetime", "yyyyMMddHHmmss"))
    bits = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return bits % 1000 < int(share * 1000)


def fit_lag_model(train: DataFrame, measures: Sequence[str] = tuple(MEASURES)) -> LagModel:
    """Least squares from the means and covariances: one pass over the training rows.

    The least-norm solution is taken, so a constant or repeated measure does no harm. Without
    training rows there is no model: ValueError.
    """
    found = moments(train, [*lag_names(measures), TARGET])
    if not found.n:
        raise ValueError("no complete training rows: nothing to fit a forecast on")
    slopes = np.linalg.lstsq(found.covariance[:-1, :-1], found.covariance[:-1, -1], rcond=None)[0]
    intercept = found.means[-1] - found.means[:-1] @ slopes
    return LagModel(measures, float(intercept), [float(b) for b in slopes])


def evaluate(model: LagModel, test: DataFrame) -> DataFrame:
    """One row: number of test rows and mean squared error."""
    error = F.col(TARGET) - model.predict(lag_names(model.measures))
    return test.agg(F.count(F.lit(1)).alias("n_test"), F.avg(error * error).alias("mse"))


def train_and_evaluate(features: DataFrame, share: float = 0.2) -> tuple[LagModel, DataFrame]:
    """Fit on the training share of the lag features and score the rest."""
    flagged = features.withColumn("_test", is_test_row(share))
    model = fit_lag_model(flagged.where(~F.col("_test")))
    return model, evaluate(model, flagged.where("_test"))


def forecast_next(model: LagModel, obs: DataFrame) -> DataFrame:
    """Forecast of the step after each station's last observation."""
    last = latest_per_station(obs.select("station_id", "datetime", *model.measures))
    return last.withColumn("forecast", model.predict(model.measures))


def forecast_refit_last(model: LagModel, obs: DataFrame) -> DataFrame:
    """Prediction for the last observed step of the whole table, from the step before it.

    This is what the lag columns of the last row give when stations are not told apart.
    """
    names = lag_names(model.measures)
    two = latest_overall(obs.select("station_id", "datetime", *model.measures), 2)
    newest_first = Window.partitionBy(F.lit(1)).orderBy(
        *[F.col(c).desc() for c in ("datetime", "station_id", *model.measures)]
    )
    before = [F.lead(c).over(newest_first).alias(n) for c, n in zip(model.measures, names)]
    last = two.select("*", *before, F.row_number().over(newest_first).alias("_nth")).where("_nth = 1").drop("_nth")
    return last.withColumn("forecast", model.predict(names))
