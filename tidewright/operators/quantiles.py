"""Exact quantiles of a column of any size, and tertile labels."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.columns import null_if_nan

# Labels of the three bins, lowest scores first (fixed values).
TERTILE_LABELS = ["High Consistency", "Medium Consistency", "Low Consistency"]
UNKNOWN_LABEL = "Unknown, not enough data"


@dataclass(frozen=True)
class Quantiles:
    n: int
    low: float | None
    high: float | None
    edges: list[float]


@dataclass
class _Search:
    """The value at one 0-based rank: known to lie in [low, high], with `below` values under `low`
    and `inside` values in the range."""

    rank: int
    low: float
    high: float
    below: int
    inside: int


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], accuracy: int = 10_000) -> Quantiles:
    """Linearly interpolated quantiles of the non-null values.

    Each wanted rank keeps a range of values. A pass estimates the rank's place in it with
    `percentile_approx`, whose state is bounded and combined on the map side; a second pass
    counts the rows around the estimates, which either settles the value or cuts the range
    down, whatever the estimate was worth. With up to `accuracy` different values in the range
    the estimate is the value. All ranks share the passes; no value list reaches one task.
    """
    x = df.select(null_if_nan(F.col(column).cast("double")).alias("x")).where(F.col("x").isNotNull())
    n, low, high = x.agg(F.count("x"), F.min("x"), F.max("x")).first()
    if n == 0:
        return Quantiles(0, None, None, [])
    places = [(n - 1) * p for p in probs]
    ranks = sorted({f(at) for at in places for f in (math.floor, math.ceil)})
    value = _values_at(x, [_Search(r, low, high, 0, n) for r in ranks], accuracy)
    edges = []
    for at in places:
        a, b = value[math.floor(at)], value[math.ceil(at)]
        # equal neighbours stand as they are: rounding must not move an edge off a tied score
        edges.append(a if a == b else (math.ceil(at) - at) * a + (at - math.floor(at)) * b)
    return Quantiles(n, low, high, edges)


def _values_at(x: DataFrame, searches: list[_Search], accuracy: int) -> dict[int, float]:
    found: dict[int, float] = {}
    margin = 2.0 / accuracy
    while searches:
        within = [F.when(F.col("x").between(s.low, s.high), F.col("x")) for s in searches]
        shares = []
        for s in searches:
            at = (s.rank - s.below + 0.5) / s.inside
            shares.append([max(at - margin, 0.0), at, min(at + margin, 1.0)])
        row = x.agg(*[F.percentile_approx(w, share, accuracy) for w, share in zip(within, shares)]).first()
        tries = [sorted({s.low, s.high, *guess}) for s, guess in zip(searches, row)]
        counts = x.agg(*[f(w, v) for w, vs in zip(within, tries) for v in vs for f in (_under, _upto, _before, _after)]).first()
        at, left = 0, []
        for s, values in zip(searches, tries):
            low, high, below, inside = s.low, s.high, s.below, s.inside
            for v in values:
                under, upto, before, after = counts[at : at + 4]
                at += 4
                if s.below + under <= s.rank < s.below + upto:
                    found[s.rank] = v
                elif s.below + upto <= s.rank:  # the value lies above v
                    low, below, inside = after, s.below + upto, inside - (s.below + upto - below)
                elif v <= high:  # the value lies under v
                    high, inside = before, s.below + under - below
                    at += 4 * (len(values) - 1 - values.index(v))
                    break
            if s.rank not in found:
                left.append(_Search(s.rank, low, high, below, inside))
        searches = left
    return found


def _under(w: Column, v: float) -> Column:
    return F.count_if(w < v)


def _upto(w: Column, v: float) -> Column:
    return F.count_if(w <= v)


def _before(w: Column, v: float) -> Column:
    """The largest value under `v`."""
    return F.max(F.when(w < v, w))


def _after(w: Column, v: float) -> Column:
    """The smallest value above `v`."""
    return F.min(F.when(w > v, w))


def tertile_label(score: Column | str, edges: Sequence[float], spread: bool) -> Column:
    """Bin of a score: right-closed, the lowest included; ties share a label.

    NULL where all scores are equal (`spread` is false).
    """
    score = null_if_nan(score)
    if not spread:
        return F.lit(None).cast("string")
    return (
        F.when(score <= F.lit(edges[0]), TERTILE_LABELS[0])
        .when(score <= F.lit(edges[1]), TERTILE_LABELS[1])
        .when(score.isNotNull(), TERTILE_LABELS[2])
    )


def with_tertiles(df: DataFrame, score: str, label: str = "label", **limits: int) -> DataFrame:
    """Add the tertile label over all non-null scores."""
    q = exact_quantiles(df, score, [1 / 3, 2 / 3], **limits)
    spread = q.n > 0 and q.low < q.high
    return df.withColumn(label, tertile_label(score, q.edges, spread))
