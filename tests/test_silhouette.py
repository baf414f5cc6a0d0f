"""Euclidean silhouette against plain numpy."""

from __future__ import annotations

import numpy as np
import pytest

from tidewright.operators import clustering
from tidewright.operators.silhouette import euclidean_silhouettes


def plain(x: np.ndarray, label: np.ndarray) -> float:
    distance = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    scores = []
    for i in range(len(x)):
        own = label == label[i]
        others = [distance[i, label == g].mean() for g in set(label.tolist()) - {label[i]}]
        if own.sum() < 2 or not others:
            scores.append(0.0)
            continue
        a, b = distance[i, own].sum() / (own.sum() - 1), min(others)
        scores.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(scores))


@pytest.mark.parametrize("tile_rows", [7, 64, 5_000])
def test_as_plain_numpy(spark, tile_rows):
    """Tiles of any size; a cluster of one point, a number without points, one cluster alone, equal points."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(230, 3)).round(2)
    x[:20] = x[0]
    labels = np.stack([rng.integers(0, 4, 230), np.where(np.arange(230) == 99, 5, np.arange(230) % 2), np.zeros(230, int)], 1)
    data = [(*map(float, p), *map(int, g)) for p, g in zip(x, labels)]
    df = spark.createDataFrame(data, "a double, b double, c double, l int, m int, tile int")
    missing = [(None, 0.0, 0.0, 0, 0, 0), (1.0, 2.0, float("nan"), 1, 0, 0), (1.0, 2.0, 3.0, None, 0, 0)]
    df = df.unionByName(spark.createDataFrame(missing, df.schema)).repartition(5)
    got = euclidean_silhouettes(df, ["a", "b", "c"], ["l", "m", "tile"], tile_rows)
    assert got == pytest.approx([plain(x, labels[:, i]) for i in range(3)], abs=1e-12)


def test_without_points(spark):
    assert euclidean_silhouettes(spark.createDataFrame([], "a double, l int"), ["a"], ["l"]) == [None]


def test_choice_of_k(spark):
    rng = np.random.default_rng(5)
    centres = np.array([(0, 0), (9, 0), (0, 9), (9, 9)])
    data = [tuple(map(float, rng.normal(centres[i % 4], 0.4))) for i in range(200)]
    df = spark.createDataFrame(data, "a double, b double")
    scores = clustering.silhouettes_euclidean(df, ["a", "b"])
    assert [k for k, _ in scores] == [3, 4, 5, 6, 7] and clustering.best_k(scores) == 4
    obs = df.selectExpr("*", "a as station_id", "b as datetime")
    assert clustering.cluster_observations(obs, ["a", "b"], euclidean=True).select("cluster").distinct().count() == 4
