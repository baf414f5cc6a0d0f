"""Imputation, scaling, sampling, K-means."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import OBS, rows, ts
from pyspark.sql import functions as F

from tidewright.operators import clustering
from tidewright.schemas import MEASURES


def blobs(spark, per_blob=80, seed=6):
    rng = np.random.default_rng(seed)
    centres = [(0, 0, 0, 0), (50, 0, 9, 0), (0, 60, 0, 90), (50, 60, 9, 90)]
    data = []
    for b, c in enumerate(centres):
        for i in range(per_blob):
            x = [float(v) for v in rng.normal(c, 0.5).round(2)]
            data.append((f"s{b}", ts(f"2024-0{b + 1}-{i % 28 + 1:02d} {i // 28:02d}:00"), 1.0, 2.0, *x))
    return spark.createDataFrame(data, OBS), np.array([r[4:] for r in data])


def test_impute_and_scale(spark):
    df = spark.createDataFrame(
        [("a", ts("2024-01-01"), 1.0, None, 5.0, None), ("a", ts("2024-01-02"), float("nan"), None, 5.0, 2.0), ("a", ts("2024-01-03"), 4.0, None, 5.0, 3.0)],
        "station_id string, datetime timestamp_ntz, wave_height double, dominant_period double, average_period double, mean_wave_direction double",
    )
    scaling = clustering.fit_scaling(df)
    assert scaling.columns == ["wave_height", "average_period", "mean_wave_direction"]  # all-null column left out
    got = np.array([tuple(r) for r in scaling.apply(df).orderBy("datetime").select(*scaling.outputs).collect()])
    filled = np.array([[1.0, 5.0, 2.5], [2.5, 5.0, 2.0], [4.0, 5.0, 3.0]])
    std = filled.std(axis=0)
    std[std == 0] = 1.0
    np.testing.assert_allclose(got, (filled - filled.mean(axis=0)) / std, atol=1e-12)


def test_sample_is_the_same_for_any_partitioning(spark):
    df, _ = blobs(spark)
    a = rows(clustering.sample_rows(df, 100))
    b = rows(clustering.sample_rows(df.repartition(11), 100))
    assert len(a) == 100 and a == b and len(set(a)) == 100
    assert clustering.sample_rows(df, 1000).count() == 320


def test_sample_with_one_hot_key(spark):
    """Most rows share one key, hence one hash: the bound has to be raised, the size holds."""
    df = spark.range(1000).selectExpr("case when id < 900 then 0 else id end as k", "id")
    assert clustering.sample_rows(df, 50, ["k"]).count() == 50


def test_blobs_are_found(spark):
    df, x = blobs(spark)
    scaling = clustering.fit_scaling(df)
    scores = clustering.silhouettes(scaling.apply(df), scaling.outputs)
    assert [k for k, _ in scores] == [3, 4, 5, 6, 7] and clustering.best_k(scores) == 4
    got = clustering.cluster_observations(df)
    assert got.columns == [*df.columns, "cluster"] and got.count() == len(x)
    by_station = {(r["station_id"], r["cluster"]): r["n"] for r in clustering.cluster_histogram(got).collect()}
    assert sorted(by_station.values()) == [80] * 4 and len({c for _, c in by_station}) == 4


def test_labels_are_the_nearest_centre_and_centres_the_means(spark):
    df, _ = blobs(spark)
    scaling = clustering.fit_scaling(df)
    scaled = scaling.apply(df)
    got = clustering.cluster_observations(df, k=3).select(*MEASURES, "cluster").toPandas()
    x = scaled.select(*scaling.outputs).toPandas().to_numpy()
    z = (got[MEASURES].to_numpy() - np.array(scaling.means)) / np.array(scaling.stds)
    centres = np.array([z[got["cluster"] == k].mean(axis=0) for k in range(3)])
    nearest = ((z[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (nearest == got["cluster"]).all()
    assert x.shape == z.shape


def test_first_best_k_wins():
    assert clustering.best_k([(3, 0.5), (4, 0.7), (5, 0.7)]) == 4


def test_clusters_do_not_depend_on_the_partitioning(spark):
    df, _ = blobs(spark)
    found = []
    for parts in (2, 16):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = clustering.cluster_observations(df.repartition(parts), k=6)
            found.append(rows(got.select("station_id", "datetime", "cluster")))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
    assert found[0] == found[1]


def test_clusters_are_numbered_by_their_centres(spark):
    df, _ = blobs(spark)
    got = clustering.cluster_observations(df, k=4).groupBy("cluster").agg(*[F.avg(m).alias(m) for m in MEASURES])
    centres = [tuple(r[m] for m in MEASURES) for r in got.orderBy("cluster").collect()]
    assert centres == sorted(centres)


def test_k_is_chosen_on_a_sample_only_if_asked_for(spark):
    df, _ = blobs(spark)
    assert clustering.cluster_observations(df, sample=40).select("cluster").distinct().count() == 4
