"""Means and covariances of a few columns, from one aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Moments:
    n: int
    means: np.ndarray
    covariance: np.ndarray  # of the rows themselves, divided by n


def moments(df: DataFrame, columns: Sequence[str]) -> Moments:
    """Only the count, the means and the covariances reach the driver."""
    k = len(columns)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = df.agg(
        F.count(F.lit(1)),
        *[F.avg(c) for c in columns],
        *[F.covar_pop(columns[i], columns[j]) for i, j in pairs],
    ).first()
    if row[0] == 0:
        return Moments(0, np.zeros(k), np.zeros((k, k)))
    covariance = np.zeros((k, k))
    for (i, j), c in zip(pairs, row[k + 1 :]):
        covariance[i, j] = covariance[j, i] = c
    return Moments(row[0], np.array(row[1 : k + 1]), covariance)
