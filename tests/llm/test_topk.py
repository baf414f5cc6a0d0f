"""MaxScore against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.llm import topk

SCHEMA = "vec_id long, embedding array<double>, rank int, weights string"


def plain(vectors, is_query, k=5, scale=256):
    """{query: [(vec_id, score)]}; vectors: {id: components}."""
    good = {i: [math.floor(scale * x) for x in v] for i, v in vectors.items() if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = {}
    for q in good:
        if is_query(q):
            scores = [(-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q]
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return {q: v for q, v in out.items() if v}


def asked(df, every=3, **options):
    found = {}
    for r in topk.top_k(df, F.col("vec_id") % every == 0, **options).orderBy("query_id", "rank").collect():
        own = found.setdefault(r.query_id, [])
        own.append((r.vec_id, r.score))
        assert r["rank"] == len(own)
    return found


def made(seed, n, width, kind):
    rng = random.Random(seed)
    out = {}
    for i in range(n):
        if kind == "sparse":
            v = [rng.choice([0.0] * 8 + [rng.uniform(-1, 3)]) for _ in range(width)]
        elif kind == "ties":
            v = [rng.choice([-1.0, 0.0, 1.0]) for _ in range(width)]
        elif kind == "negative":
            v = [-abs(rng.gauss(0, 1)) if i % 3 else abs(rng.gauss(0, 1)) for _ in range(width)]
        elif kind == "huge":
            v = [rng.gauss(0, 1) * 10.0 ** rng.randint(0, 6) for _ in range(width)]
        else:
            v = [rng.gauss(0, 1) for _ in range(width)]
        out[i] = v
    return out


@pytest.mark.parametrize("kind", ["dense", "sparse", "ties", "negative", "huge"])
def test_results_are_exact(spark, monkeypatch, kind):
    """Small shards, parts and blocks, so that scores meet across all of them."""
    monkeypatch.setattr(topk, "SHARD", 16)
    monkeypatch.setattr(topk, "PART_SHARDS", 3)
    monkeypatch.setattr(topk, "QUERIES", 7)
    vectors = made(5, 200, 12, kind)
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in vectors.items()], SCHEMA)
    assert asked(df) == plain(vectors, lambda q: q % 3 == 0)


def test_odd_vectors(spark):
    """Null, empty and non-finite vectors, other lengths, no id, a repeated row, one id with two vectors."""
    vectors = {0: [1.0, 2.0], 3: [1.0, 2.0], 4: None, 5: [], 6: [float("nan"), 1.0], 7: [None, 1.0], 8: [1.0], 9: [-1.0, 0.5, 4.0], 12: [float("inf")], 15: [0.001, -0.001]}
    rows = [(i, v, 1, "x") for i, v in vectors.items()] + [(3, [1.0, 2.0], 2, "y"), (None, [9.0, 9.0], 1, "x"), (0, [5.0, 5.0], 1, "z")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert asked(df) == plain(vectors, lambda q: q % 3 == 0)
    assert topk.top_k(df.where("false"), F.lit(True)).count() == 0
    assert topk.top_k(df, F.lit(False)).count() == 0
    assert asked(df.where("vec_id = 9")) == {}


def test_scores_beyond_a_long_stand_at_its_end(spark):
    vectors = {0: [1e300, 1.0], 1: [1e300, 2.0], 2: [-1e300, 0.0], 3: [1e-3, 1e15]}
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in vectors.items()], SCHEMA)
    found = asked(df, every=4)
    assert found[0][0] == (1, topk.LAST) and found[0][-1] == (2, -topk.LAST)


def test_only_essential_terms_are_traversed():
    """A vector that only weak terms hold is never probed; the split follows the bounds."""
    essential, others = topk.essential_terms(np.array([5.0, 1.0, 2.0, 0.0]), 3.5)
    assert essential.tolist() == [0] and others.tolist() == [2, 1, 3]
    essential, others = topk.essential_terms(np.array([5.0, 1.0, 2.0]), 3.0)  # together they reach it: a tie counts
    assert essential.tolist() == [0, 2] and others.tolist() == [1]
    assert len(topk.essential_terms(np.array([5.0, 1.0]), None)[1]) == 0
    terms = np.zeros((3, 1000))
    terms[0, :10], terms[1], terms[2] = 100.0, 1.0, 1.0
    shard, reads = topk.Shard(np.arange(1000), terms), []

    class Seen(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, tuple) and isinstance(key[1], np.ndarray):
                reads.append((int(key[0]), len(key[1])))
            return np.asarray(super().__getitem__(key))

    shard.terms = terms.view(Seen)
    ids, scores = topk.search(shard, np.array([1.0, 1.0, 1.0]), -1, 5, 50.0)
    assert ids.tolist() == [0, 1, 2, 3, 4] and set(scores.tolist()) == {102.0}
    assert reads == [(0, 10), (1, 10), (2, 10)] or reads == [(0, 10), (2, 10), (1, 10)]
