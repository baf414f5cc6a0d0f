"""Monthly wave consistency: spread per station and month, score, label."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.columns import month_start, null_if_nan
from tidewright.operators.moments import moments
from tidewright.operators.quantiles import UNKNOWN_LABEL, exact_quantiles, tertile_label
from tidewright.schemas import CONSISTENCY, MEASURES, POSITION, SHORT_NAMES, STD_COLUMNS
from tidewright.session import materialize

_DEALT = "_dealt"


def station_locations(obs: DataFrame) -> DataFrame:
    """First non-null latitude and longitude of each station, in time order."""
    return obs.groupBy("station_id").agg(*[_first_in_time(c) for c in POSITION])


def _first_in_time(c: str) -> Column:
    seen = F.when(F.col(c).isNotNull(), F.col("datetime"))
    return F.min_by(c, seen).alias(c)


def _spreads() -> list[Column]:
    return [
        F.stddev_samp(null_if_nan(m)).alias(f"{SHORT_NAMES[m]}_monthly_std") for m in MEASURES
    ]


def _by_station_month(obs: DataFrame) -> DataFrame:
    """The observations with their `month`, dealt out so that those of a station and month meet in one task.

    A task that aggregates them then holds few groups, however much input a reading task has and in whatever
    order; without this each reading task would hold nearly every group. The layout is a rebalancing hint:
    adaptive execution keeps the parts to one size and cuts up a part that one station and month makes large,
    whose pieces the grouping combines.
    """
    rows = obs.withColumn("month", month_start("datetime"))
    # A column beside the keys: dealt out by the keys themselves, the rows of one could not be cut up.
    return rows.withColumn(_DEALT, F.pmod(F.hash("station_id", "month"), F.lit(1 << 16))).hint("rebalance", _DEALT)


def monthly_std_dev(obs: DataFrame) -> DataFrame:
    """Sample standard deviation of the measures per station and month.

    A month with one value has no deviation (NULL).
    """
    return _by_station_month(obs).groupBy("station_id", "month").agg(*_spreads())


def with_locations(monthly: DataFrame, locations: DataFrame) -> DataFrame:
    return monthly.join(locations, "station_id", "left")


def monthly_table(obs: DataFrame) -> DataFrame:
    """`monthly_std_dev` with the station's location, from one pass over the observations.

    The location is taken per station and month in the same aggregate; the first month that
    has one gives the station's location. The window sees one row per month of a station.
    """
    months = _by_station_month(obs).groupBy("station_id", "month").agg(
        *_spreads(), *[_first_in_time(c) for c in POSITION]
    )
    station = (
        Window.partitionBy("station_id")
        .orderBy("month")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return months.withColumns({c: F.first(c, ignorenulls=True).over(station) for c in POSITION})


@dataclass(frozen=True)
class Component:
    """First principal component of some columns: centre and direction."""

    columns: Sequence[str]
    means: Sequence[float]
    weights: Sequence[float]

    def score(self) -> Column:
        terms = [
            F.lit(w) * (F.col(c) - F.lit(m))
            for c, m, w in zip(self.columns, self.means, self.weights)
        ]
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        return total


def first_component(
    df: DataFrame, columns: Sequence[str] = tuple(STD_COLUMNS), scale: bool = False
) -> Component | None:
    """Centred first component over the complete rows; None without any.

    One aggregate gives the means and the covariances; only those few numbers reach the
    driver. The sign is fixed so that the largest loading is positive. With `scale` each column
    counts in units of its deviation over the complete rows; a constant one has no weight.
    """
    found = moments(df.dropna("any"), columns)
    if found.n == 0:
        return None
    units = np.ones(len(columns))
    if scale:
        spread = np.sqrt(np.diag(found.covariance) * (found.n / max(found.n - 1, 1)))
        units = np.divide(1.0, spread, out=np.zeros(len(columns)), where=spread > 0)
    top = np.linalg.eigh(found.covariance * np.outer(units, units))[1][:, -1]
    top = top * (1.0 if top[np.argmax(np.abs(top))] > 0 else -1.0)
    top = top * units
    return Component(columns, [float(m) for m in found.means], [float(w) for w in top])


def attach_scores(monthly: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores computed elsewhere back onto all (station, month) rows."""
    return monthly.join(
        scores.select("station_id", "month", "consistency_score"), ["station_id", "month"], "left"
    )


def score_consistency(monthly: DataFrame, scale: bool = False) -> DataFrame:
    """Add `consistency_score`; NULL on rows with any missing value.

    The score is a column expression, so no join is needed to bring it back to all rows.
    """
    component = first_component(monthly, scale=scale)
    if component is None:
        return monthly.withColumn("consistency_score", F.lit(None).cast("double"))
    complete = F.lit(True)
    for c in monthly.columns:
        complete = complete & F.col(c).isNotNull()
    return monthly.withColumn("consistency_score", F.when(complete, component.score()))


def label_consistency(scored: DataFrame, **limits: int) -> DataFrame:
    """Add `consistency_label`: tertiles of all scores, or the mark for rows without one."""
    q = exact_quantiles(scored, "consistency_score", [1 / 3, 2 / 3], **limits)
    spread = q.n > 0 and q.low < q.high
    label = F.when(F.col("consistency_score").isNull(), UNKNOWN_LABEL).otherwise(
        tertile_label("consistency_score", q.edges, spread)
    )
    return scored.withColumn("consistency_label", label)


def consistency_trends(obs: DataFrame, scale: bool = False) -> DataFrame:
    """Monthly spread, score and label of every (station, month); with `scale`, of the scaled component.

    The monthly table is written once to the shared folder: the component, the tertile
    edges and the result all read it, and none of them goes back to the observations.
    """
    monthly = materialize(monthly_table(obs), "monthly-std")
    return label_consistency(score_consistency(monthly, scale)).select(*CONSISTENCY.fieldNames())
