"""Merging observation sources: union, first non-null value per key, key anti-join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.schemas import KEY, MEASURES, POSITION


def union_sources(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; a column that one lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_non_null(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = tuple(KEY),
    values: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: for each column the first value in `order` that is not NULL.

    Each column is one `min` over (order, value), so the map side combines before the
    shuffle and a key with very many rows costs no more than any other. The value itself
    ends the ordering, so even equal order keys give one result for any partitioning.
    """
    if values is None:
        values = [c for c in POSITION + MEASURES if c in df.columns]

    def first(c: str):
        entry = F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.col(c).alias("v"))
        return F.min(F.when(F.col(c).isNotNull(), entry))["v"].alias(c)

    keyed = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return keyed.groupBy(*keys).agg(*[first(c) for c in values])


def single_frame_first(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """`first_non_null` for the rows of one source."""
    return first_non_null(df, order).select(*KEY, *[m for m in MEASURES if m in df.columns])


def first_row(df: DataFrame, order: Sequence[str], keys: Sequence[str] = tuple(KEY)) -> DataFrame:
    """One whole row per key: the first in `order`."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    entry = F.struct(*order, *rest)
    return (
        df.groupBy(*keys)
        .agg(F.min(entry).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in [*order, *rest]])
        .select(*df.columns)
    )


def absent_rows(new: DataFrame, existing: DataFrame, keys: Sequence[str] = tuple(KEY)) -> DataFrame:
    """Rows of `new` whose key is not in `existing`.

    The stored keys are cut down to those of the batch first. With a small batch that
    semi-join broadcasts the batch, so the large stored side is neither shuffled nor
    broadcast; with a large batch both joins share one partitioning by key.
    """
    keys = list(keys)
    hits = existing.select(*keys).join(new.select(*keys), keys, "left_semi")
    return new.join(hits, keys, "left_anti")
