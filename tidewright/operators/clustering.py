"""K-means clusters of observations, with k chosen by silhouette."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions.columns import null_if_nan
from tidewright.operators.silhouette import euclidean_silhouettes
from tidewright.schemas import KEY, MEASURES

# Size of a sample where the caller asks for one without saying how large.
SAMPLE_ROWS = 60_000
# Rows of a partition that K-means starts from. The number of partitions follows from the rows alone, so
# that its random start does not depend on the session.
PART_ROWS, LEAST_PARTS = 100_000, 8
CLUSTER_RANGE = range(3, 8)
SEED = 42


@dataclass(frozen=True)
class Scaling:
    """Mean and standard deviation of each usable column, after mean imputation."""

    columns: Sequence[str]
    means: Sequence[float]
    stds: Sequence[float]

    def apply(self, df: DataFrame) -> DataFrame:
        """Add `<column>_scaled`; a constant column scales to 0."""
        return df.withColumns(
            {
                f"{c}_scaled": (F.coalesce(null_if_nan(c), F.lit(m)) - F.lit(m)) / F.lit(s or 1.0)
                for c, m, s in zip(self.columns, self.means, self.stds)
            }
        )

    @property
    def outputs(self) -> list[str]:
        return [f"{c}_scaled" for c in self.columns]


def fit_scaling(df: DataFrame, columns: Sequence[str] = tuple(MEASURES)) -> Scaling:
    """Imputation means and population deviations from one aggregate.

    Filling gaps with the mean leaves the mean as it is and adds nothing to the sum of
    squares, so the deviation after imputation follows from the counts. A column without
    any value is left out.
    """
    clean = [null_if_nan(c) for c in columns]
    row = df.agg(
        F.count(F.lit(1)),
        *[f(c) for c in clean for f in (F.count, F.avg, F.var_pop)],
    ).first()
    kept, means, stds = [], [], []
    for i, c in enumerate(columns):
        n, mean, var = row[1 + 3 * i : 4 + 3 * i]
        if n:
            kept.append(c)
            means.append(mean)
            stds.append(math.sqrt(var * n / row[0]))
    return Scaling(kept, means, stds)


def impute_scale(df: DataFrame, columns: Sequence[str] = tuple(MEASURES)) -> DataFrame:
    return fit_scaling(df, columns).apply(df)


def sample_rows(df: DataFrame, n: int = SAMPLE_ROWS, key: Sequence[str] = tuple(KEY)) -> DataFrame:
    """At most `n` rows without replacement: those with the lowest MD5 of their key.

    The same rows come out for any partitioning and in another engine. Each task keeps its lowest
    `n`, then they are merged.
    """
    at = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]))
    return df.withColumn("_h", at).orderBy("_h", *df.columns).limit(n).drop("_h")


def with_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def fixed_layout(scaled: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The vectors in partitions by value, sorted: the same for any session and order of the rows.

    The scaling may differ in the last digits with the order of its sums, so values are rounded to
    find their place.
    """
    places = [F.round(c, 6) for c in columns]
    parts = max(LEAST_PARTS, math.ceil(scaled.count() / PART_ROWS))
    points = scaled.select(*columns).repartition(parts, *places).sortWithinPartitions(*places)
    return with_features(points, columns).select("features")


def fit_kmeans(points: DataFrame, k: int, seed: int = SEED) -> KMeansModel:
    """K-means; stops when the summed squared shift is below 1e-4. `points` comes from `fixed_layout`."""
    kmeans = KMeans(k=k, seed=seed, maxIter=300, tol=math.sqrt(1e-4 / k))
    return kmeans.setPredictionCol("_nearest").fit(points)


def with_cluster(model: KMeansModel, vectors: DataFrame) -> DataFrame:
    """Add `cluster`: the nearest centre, numbered in the order of the centres' coordinates."""
    centres = [tuple(c) for c in model.clusterCenters()]
    place = sorted(range(len(centres)), key=lambda i: centres[i])
    number = F.array(*[F.lit(place.index(i)) for i in range(len(centres))])
    return model.transform(vectors).withColumn("cluster", F.element_at(number, F.col("_nearest") + 1)).drop("_nearest")


def judged_models(
    scaled: DataFrame, columns: Sequence[str], ks: Sequence[int] = CLUSTER_RANGE
) -> list[tuple[int, float, KMeansModel]]:
    """For each k the mean squared-Euclidean silhouette over all rows, at a cost linear in them, and the model."""
    points = fixed_layout(scaled, columns).persist()
    judge = ClusteringEvaluator(predictionCol="cluster", metricName="silhouette")
    try:
        models = [(k, fit_kmeans(points, k)) for k in ks]
        return [(k, judge.evaluate(with_cluster(model, points)), model) for k, model in models]
    finally:
        points.unpersist()


def silhouettes(
    scaled: DataFrame, columns: Sequence[str], ks: Sequence[int] = CLUSTER_RANGE
) -> list[tuple[int, float]]:
    return [(k, score) for k, score, _ in judged_models(scaled, columns, ks)]


def silhouettes_euclidean(
    scaled: DataFrame, columns: Sequence[str], ks: Sequence[int] = CLUSTER_RANGE
) -> list[tuple[int, float]]:
    """Mean Euclidean silhouette for each k. Its cost is the square of the rows: give it a sample."""
    points = fixed_layout(scaled, columns).persist()
    try:
        labelled = points
        for k in ks:
            labelled = with_cluster(fit_kmeans(points, k), labelled).withColumnRenamed("cluster", f"_k{k}")
        x = vector_to_array("features")
        flat = labelled.select(*[x[i].alias(f"_x{i}") for i in range(len(columns))], *[f"_k{k}" for k in ks])
        found = euclidean_silhouettes(flat, [f"_x{i}" for i in range(len(columns))], [f"_k{k}" for k in ks])
    finally:
        points.unpersist()
    return list(zip(ks, found))


def best_k(scores: Sequence[tuple[int, float]]) -> int:
    """The k with the highest silhouette; the smallest of equals."""
    return max(scores, key=lambda s: (s[1], -s[0]))[0]


def cluster_observations(
    obs: DataFrame,
    columns: Sequence[str] = tuple(MEASURES),
    k: int | None = None,
    sample: int | None = None,
    euclidean: bool = False,
) -> DataFrame:
    """Observations with their `cluster`; k is chosen by silhouette unless it is given.

    All rows take part in the choice unless the caller names the size of a `sample`. With `euclidean`
    the choice goes by Euclidean distances instead of their squares, on a sample of `SAMPLE_ROWS` by default.
    """
    scaling = fit_scaling(obs, columns)
    scaled = scaling.apply(obs)
    names = scaling.outputs
    model = None
    if k is None and euclidean:
        k = best_k(silhouettes_euclidean(sample_rows(scaled, sample or SAMPLE_ROWS), names))
    elif k is None and sample:
        k = best_k(silhouettes(sample_rows(scaled, sample), names))
    elif k is None:  # the models of all rows are there already
        found = judged_models(scaled, names)
        k = best_k([(n, score) for n, score, _ in found])
        model = next(m for n, _, m in found if n == k)
    model = model or fit_kmeans(fixed_layout(scaled, names), k)
    return with_cluster(model, with_features(scaled, names)).select(*obs.columns, "cluster")


def cluster_histogram(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("station_id", "cluster").agg(F.count(F.lit(1)).alias("n"))
