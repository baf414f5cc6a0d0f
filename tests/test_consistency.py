"""Monthly spread, component score, tertiles and labels."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from conftest import OBS, ts

from tidewright.operators import consistency, quantiles
from tidewright.schemas import MEASURES, STD_COLUMNS

MONTHLY = "station_id string, month timestamp_ntz, " + ", ".join(f"{c} double" for c in STD_COLUMNS)


def observations(spark, n=4000, seed=3):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame(
        {
            "station_id": rng.choice(["a", "b", "c"], n, p=[0.7, 0.2, 0.1]),
            "datetime": pd.Timestamp("2023-11-05") + pd.to_timedelta(np.arange(n) * 37, unit="m"),
            "latitude": 1.0,
            "longitude": 2.0,
        }
    )
    for i, m in enumerate(MEASURES):
        pdf[m] = np.where(rng.random(n) < 0.05, np.nan, rng.normal(i, 1 + i, n))
    data = [
        tuple(None if v != v else (v.to_pydatetime() if isinstance(v, pd.Timestamp) else v) for v in r)
        for r in pdf.itertuples(index=False)
    ]
    return pdf, spark.createDataFrame(data, OBS)


def test_monthly_std_agrees_with_pandas(spark):
    pdf, sdf = observations(spark)
    pdf["month"] = pdf["datetime"].dt.to_period("M").dt.to_timestamp()
    want = pdf.groupby(["station_id", "month"])[MEASURES].std().reset_index()
    got = consistency.monthly_table(sdf).toPandas().sort_values(["station_id", "month"]).reset_index(drop=True)
    assert (got["month"] == want["month"]).all()
    np.testing.assert_allclose(got[STD_COLUMNS].to_numpy(float), want[MEASURES].to_numpy(float), rtol=1e-9)
    assert set(got["latitude"]) == {1.0}


def test_nan_counts_as_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [("a", ts(f"2024-01-0{d}"), 1.0, 2.0, h, 1.0, 1.0, 1.0) for d, h in ((1, 1.0), (2, nan), (3, 3.0))], OBS
    )
    assert consistency.monthly_std_dev(df).first()["wvht_monthly_std"] == pytest.approx(2**0.5)
    scores = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, nan)], "score double")
    assert [r["label"] for r in quantiles.with_tertiles(scores, "score").orderBy("score").collect()][-1] is None


def test_single_observation_has_no_spread(spark):
    df = spark.createDataFrame([("a", ts("2024-01-01"), 1.0, 2.0, 1.0, 1.0, 1.0, 1.0)], OBS)
    assert consistency.monthly_std_dev(df).first()[2:] == (None,) * 4


def test_location_is_the_first_known_one(spark):
    df = spark.createDataFrame(
        [
            ("a", ts("2024-01-01"), None, 9.0, 1.0, 1.0, 1.0, 1.0),
            ("a", ts("2024-01-02"), 5.0, 8.0, 1.0, 1.0, 1.0, 1.0),
            ("a", ts("2024-02-02"), 6.0, 7.0, 1.0, 1.0, 1.0, 1.0),
            ("b", ts("2024-02-02"), None, None, 1.0, 1.0, 1.0, 1.0),
        ],
        OBS,
    )
    want = {"a": (5.0, 9.0), "b": (None, None)}
    plain = {r["station_id"]: (r["latitude"], r["longitude"]) for r in consistency.station_locations(df).collect()}
    assert plain == want
    table = {(r["station_id"], r["latitude"], r["longitude"]) for r in consistency.monthly_table(df).collect()}
    assert table == {("a", 5.0, 9.0), ("b", None, None)}
    joined = consistency.with_locations(consistency.monthly_std_dev(df), consistency.station_locations(df))
    assert {(r["station_id"], r["latitude"], r["longitude"]) for r in joined.collect()} == table


def group_rows(plan) -> list[int]:
    """Rows that each grouping step of an executed plan gave."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return group_rows(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return group_rows(plan.plan())
    own = [plan.metrics().apply("numOutputRows").value()] if kind == "HashAggregateExec" else []
    below = plan.children()
    return sum((group_rows(below.apply(i)) for i in range(below.size())), own)


def test_no_task_holds_the_groups_of_another(spark):
    """Rows of every month in every input partition: each month is grouped in one place only."""
    data = [
        (f"s{i % 30}", ts("2024-01-01") + dt.timedelta(days=31 * (i // 30 % 2), hours=i), 1.0, 2.0, float(i), 1.0, 1.0, 1.0)
        for i in range(960)
    ]
    obs = spark.createDataFrame(data, OBS).repartition(8)
    groups = len({(r[0], r[1].month) for r in data})
    for found in (consistency.monthly_table(obs), consistency.monthly_std_dev(obs)):
        assert found.count() == len(found.collect()) == groups
        assert set(group_rows(found._jdf.queryExecution().executedPlan())) == {groups}


def test_component_agrees_with_numpy(spark):
    _, sdf = observations(spark)
    monthly = consistency.monthly_table(sdf)
    got = consistency.score_consistency(monthly).toPandas()
    x = got[STD_COLUMNS].to_numpy(float)
    centred = x - x.mean(axis=0)
    direction = np.linalg.svd(centred, full_matrices=False)[2][0]
    direction *= np.sign(direction[np.argmax(np.abs(direction))])
    np.testing.assert_allclose(got["consistency_score"].to_numpy(float), centred @ direction, atol=1e-9)


def test_incomplete_rows_are_unknown(spark):
    df = spark.createDataFrame(
        [(s, ts("2024-01-01"), float(i), 1.0, 1.0, float(i * i)) for i, s in enumerate("abcdef")]
        + [("g", ts("2024-01-01"), None, 1.0, 1.0, 1.0)],
        MONTHLY,
    )
    got = {r["station_id"]: r for r in consistency.label_consistency(consistency.score_consistency(df)).collect()}
    assert got["g"]["consistency_score"] is None
    assert got["g"]["consistency_label"] == "Unknown, not enough data"
    assert [got[s]["consistency_label"].split()[0] for s in "abcdef"] == ["High", "High", "Medium", "Medium", "Low", "Low"]


def test_no_complete_row(spark):
    df = spark.createDataFrame([("a", ts("2024-01-01"), None, 1.0, 1.0, 1.0)], MONTHLY)
    row = consistency.label_consistency(consistency.score_consistency(df)).first()
    assert row["consistency_score"] is None and row["consistency_label"] == "Unknown, not enough data"


def test_equal_scores_have_no_label(spark):
    for n in (1, 3):
        df = spark.createDataFrame([(str(i), ts("2024-01-01"), 1.0, 2.0, 3.0, 4.0) for i in range(n)], MONTHLY)
        got = consistency.label_consistency(consistency.score_consistency(df)).collect()
        assert {(r["consistency_score"], r["consistency_label"]) for r in got} == {(0.0, None)}


def test_attach_scores(spark):
    monthly = spark.createDataFrame([("a", ts("2024-01-01"), 1.0, 2.0, 3.0, 4.0), ("b", ts("2024-01-01"), 1.0, 2.0, 3.0, 4.0)], MONTHLY)
    scores = spark.createDataFrame([("a", ts("2024-01-01"), 0.5)], "station_id string, month timestamp_ntz, consistency_score double")
    got = {r["station_id"]: r["consistency_score"] for r in consistency.attach_scores(monthly, scores).collect()}
    assert got == {"a": 0.5, "b": None}


def test_result_does_not_depend_on_partitioning(spark):
    _, sdf = observations(spark)
    a = consistency.consistency_trends(sdf).toPandas()
    b = consistency.consistency_trends(sdf.repartition(13)).toPandas()
    key = ["station_id", "month"]
    a, b = (x.sort_values(key).reset_index(drop=True) for x in (a, b))
    assert (a["consistency_label"] == b["consistency_label"]).all()
    np.testing.assert_allclose(a["consistency_score"].to_numpy(float), b["consistency_score"].to_numpy(float), atol=1e-9)


def test_tertiles_agree_with_qcut(spark):
    x = np.random.default_rng(5).normal(size=1001)
    sdf = spark.createDataFrame([(float(v),) for v in x], "score double")
    got = quantiles.with_tertiles(sdf, "score").toPandas()
    want = pd.qcut(got["score"], 3, labels=quantiles.TERTILE_LABELS).astype(str)
    assert (got["label"] == want).all()


def test_tertiles_one_to_seven_and_ties(spark):
    sdf = spark.createDataFrame([(float(v),) for v in range(1, 8)], "score double")
    labels = {r["score"]: r["label"].split()[0] for r in quantiles.with_tertiles(sdf, "score").collect()}
    assert labels == {1: "High", 2: "High", 3: "High", 4: "Medium", 5: "Medium", 6: "Low", 7: "Low"}
    tied = spark.createDataFrame([(1.0,)] * 8 + [(2.0,), (None,)], "score double")
    got = {(r["score"], r["label"]) for r in quantiles.with_tertiles(tied, "score").collect()}
    assert got == {(1.0, "High Consistency"), (2.0, "Low Consistency"), (None, None)}


@pytest.mark.parametrize("kind", ["normal", "ties", "heavy_tail", "one_hot_value", "two_values"])
def test_quantiles_by_narrowing_are_exact(spark, kind):
    rng = np.random.default_rng(11)
    n = 20001
    x = {
        "normal": rng.normal(size=n),
        "ties": rng.integers(0, 300, n).astype(float),
        "heavy_tail": np.exp(rng.normal(0, 8, n)),
        "one_hot_value": np.where(rng.random(n) < 0.4, 0.0, rng.normal(size=n)),
        "two_values": (rng.random(n) < 0.5).astype(float),
    }[kind]
    sdf = spark.createDataFrame(pd.DataFrame({"x": x}))
    probs = [1 / 3, 2 / 3, 0.0, 1.0, 0.5]
    direct = sdf.agg(F.percentile("x", probs)).first()[0]
    for accuracy in (10_000, 300):
        found = quantiles.exact_quantiles(sdf, "x", probs, accuracy=accuracy)
        assert found.edges == list(direct)  # to the last bit, so that no tied score moves
        assert (found.n, found.low, found.high) == (n, x.min(), x.max())


@pytest.mark.parametrize(("n", "value"), [(8, -1.5058290012607418), (21, 0.9777226473527388)])
def test_an_edge_between_equal_values_is_that_value(spark, n, value):
    sdf = spark.createDataFrame([(value,)] * n + [(value + 5,)], "x double")
    for accuracy in (10_000, 2):
        assert quantiles.exact_quantiles(sdf, "x", [1 / 3, 0.5], accuracy=accuracy).edges == [value, value]


def test_scaled_component_agrees_with_numpy(spark):
    _, sdf = observations(spark)
    monthly = consistency.monthly_table(sdf)
    got = consistency.score_consistency(monthly, scale=True).toPandas()
    x = got[STD_COLUMNS].to_numpy(float)
    centred = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    direction = np.linalg.svd(centred, full_matrices=False)[2][0]
    direction *= np.sign(direction[np.argmax(np.abs(direction))])
    np.testing.assert_allclose(got["consistency_score"].to_numpy(float), centred @ direction, atol=1e-8)


def test_scaled_component_of_constant_columns(spark):
    flat = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    found = consistency.first_component(flat, ["a", "b"], scale=True)
    assert found.weights[1] == 0 and found.weights[0] > 0
    alone = consistency.first_component(flat.limit(1), ["a", "b"], scale=True)
    assert list(alone.weights) == [0, 0]
