"""Euclidean silhouette of given clusterings: every point against every other, in tiles."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.session import materialize

# Points of a tile. Two tiles meet in a task at a time, and of one of them `STRIP_ROWS` points.
TILE_ROWS = 2_000
STRIP_ROWS = 50
TILE = "x binary, label binary"
SUMS = "clustering int, total double, n long"


def _pack(n_columns: int, n_labels: int, tile_rows: int):
    """Rows to tiles: coordinates and labels of at most `tile_rows` points as dense bytes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [np.asarray(c.to_numpy(zero_copy_only=False)) for c in batch.columns]
            x = np.stack(columns[:n_columns], axis=1).astype("<f8")
            label = np.stack(columns[n_columns : n_columns + n_labels], axis=1).astype("<i4")
            for at in range(0, len(x), tile_rows):
                part = slice(at, at + tile_rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[part].tobytes()]), pa.array([label[part].tobytes()])], ["x", "label"]
                )

    return pack


def _distance_sums(mine: np.ndarray, theirs: np.ndarray, member: np.ndarray) -> np.ndarray:
    """For each of `mine` the sum of its distances to the points of each cluster."""
    sums = np.empty((len(mine), member.shape[1]))
    for at in range(0, len(mine), STRIP_ROWS):
        strip = mine[at : at + STRIP_ROWS]
        squared = np.zeros((len(strip), len(theirs)))
        for c in range(mine.shape[1]):
            gap = strip[:, c, None] - theirs[None, :, c]
            squared += gap * gap
        sums[at : at + STRIP_ROWS] = np.sqrt(squared) @ member
    return sums


def _scores(sums: np.ndarray, own: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Silhouette of each point in one clustering; 0 where its cluster has no other point."""
    at = np.arange(len(own))
    within = sums[at, own] / np.maximum(sizes[own] - 1, 1)
    means = np.where(sizes > 0, sums / np.maximum(sizes, 1), np.inf)
    means[at, own] = np.inf
    nearest = means.min(axis=1)
    widest = np.maximum(within, nearest)
    score = np.divide(nearest - within, widest, out=np.zeros(len(own)), where=(widest > 0) & np.isfinite(nearest))
    return np.where(sizes[own] > 1, score, 0.0)


def _judge(n_columns: int, sizes: list[np.ndarray]):
    """Pairs of tiles, sorted by the left one, to the summed silhouettes of each left tile."""
    starts = np.cumsum([0, *[len(s) for s in sizes]])

    def opened(x: bytes, label: bytes) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(x, "<f8").reshape(-1, n_columns), np.frombuffer(label, "<i4").reshape(-1, len(sizes))

    def finish(label: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        totals = [
            float(_scores(sums[:, starts[i] : starts[i + 1]], label[:, i], s).sum()) for i, s in enumerate(sizes)
        ]
        counts = [len(label)] * len(sizes)
        return pa.RecordBatch.from_arrays(
            [pa.array(range(len(sizes)), pa.int32()), pa.array(totals, pa.float64()), pa.array(counts, pa.int64())],
            ["clustering", "total", "n"],
        )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, label, sums = None, None, None
        for batch in batches:
            for row in range(batch.num_rows):
                value = [c[row].as_py() for c in batch.columns]
                if value[0] != tile:
                    if tile is not None:
                        yield finish(label, sums)
                    tile = value[0]
                    mine, label = opened(value[1], value[2])
                    sums = np.zeros((len(mine), starts[-1]))
                theirs, groups = opened(value[3], value[4])
                member = np.zeros((len(theirs), starts[-1]))
                for i in range(len(sizes)):
                    member[np.arange(len(theirs)), starts[i] + groups[:, i]] = 1.0
                sums += _distance_sums(mine, theirs, member)
        if tile is not None:
            yield finish(label, sums)

    return judge


def euclidean_silhouettes(
    points: DataFrame, columns: Sequence[str], labels: Sequence[str], tile_rows: int = TILE_ROWS
) -> list[float | None]:
    """Mean Euclidean silhouette of each clustering of the same points.

    `labels` names integer columns with cluster numbers from 0. Every pair of points counts, so the
    work grows with the square of their number: give it a sample of a known size. Points are packed
    in tiles; each tile meets each other by an equi-join, and a task holds the sums of one tile, so
    memory depends on neither the number of points nor the size of a cluster. Rows with a missing
    coordinate or label are left out. A cluster of one point counts 0, as does a point with no other
    cluster; without any point there is no score (None).
    """
    rows = points.select(
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)],
        *[F.col(c).cast("int").alias(f"l{i}") for i, c in enumerate(labels)],
    ).dropna()
    rows = materialize(rows, "silhouette-points")
    counted = rows.agg(F.count(F.lit(1)), *[F.max(f"l{i}") for i in range(len(labels))]).first()
    n = counted[0]
    if not n:
        return [None] * len(labels)
    wide = [F.count_if(F.col(f"l{i}") == g) for i, top in enumerate(counted[1:]) for g in range(top + 1)]
    flat = iter(rows.agg(*wide).first())
    sizes = [np.array([next(flat) for _ in range(top + 1)], dtype=float) for top in counted[1:]]

    tiles = rows.repartition(math.ceil(n / tile_rows)).mapInArrow(_pack(len(columns), len(labels), tile_rows), TILE)
    tiles = materialize(tiles.withColumn("tile", F.monotonically_increasing_id()), "silhouette-tiles")
    groups = max(1, math.ceil(n / tile_rows))
    left = tiles.select("tile", "x", "label", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    right = tiles.select(
        F.pmod(F.xxhash64("tile"), F.lit(groups)).cast("int").alias("group"),
        F.col("x").alias("x2"),
        F.col("label").alias("label2"),
    )
    pairs = left.join(right, "group").drop("group").repartition(groups, "tile").sortWithinPartitions("tile")
    found = pairs.mapInArrow(_judge(len(columns), sizes), SUMS)
    means = found.groupBy("clustering").agg((F.sum("total") / F.sum("n")).alias("mean"))
    by_number = {r["clustering"]: r["mean"] for r in means.collect()}
    return [by_number[i] for i in range(len(labels))]
