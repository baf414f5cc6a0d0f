"""Collocations against brute force."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest
from llm_helpers import make_docs, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from tidewright.llm import collocations as col

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least=10, top=2000, inside=50):
    """Rows of (lang, text)."""
    out = []
    by = collections.defaultdict(list)
    for lang, text in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        by[lang or "und" if lang is None else lang] += [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n-\r]", low)]
    for lang, pieces in by.items():
        f = collections.Counter(tuple(p[i : i + k]) for p in pieces for k in (1, 2, 3) for i in range(len(p) - k + 1))
        n = sum(c for g, c in f.items() if len(g) == 1)
        good = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        found = []
        for g, a in good.items():
            if any(len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h))) and 100 * b >= inside * a for h, b in good.items()):
                continue
            s, k = min((10**6 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-s, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -s))
    return sorted(out)


def mined(df, **options):
    return sorted(tuple(r) for r in col.collocations(df, **options).select(*COLUMNS).collect())


def prose(seed, n, words=30):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["Öl", "ß", "the", "THE", "New", "york"]
    texts = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(0, 60)):
            text += rng.choice(["new York city", rng.choice(vocabulary), vocabulary[min(int(rng.expovariate(0.3)), words)]])
            text += rng.choice([" "] * 8 + ["\t", ", ", "\n", ".", "!\r\n", "\x0b", " \x1c "])
        texts.append(text)
    return texts


@pytest.mark.parametrize("small", [False, True])
def test_phrases_equal_brute_force(spark, monkeypatch, small):
    """With small chunks, tiles and merges phrases cross chunks and counts meet in all ways."""
    if small:
        for name, value in {"CHUNK_WORDS": 97, "SLICE_CHARS": 50, "MERGE": 64, "BUCKET": 400, "DENSE": 40}.items():
            monkeypatch.setattr(col, name, value)
    texts = prose(3, 150) + [None, "", " \t", "word", " ".join(["la"] * 500)] + prose(3, 2)
    langs = ["en", "de", None, "und", ""]
    rows = [(langs[i % 5], t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n int, rank string").repartition(3)
    found = mined(df)
    assert found == plain(rows) and len(found) > 50
    assert mined(df, least=4, top=7, inside=80) == plain(rows, 4, 7, 80)


def test_odd_and_no_texts(spark, odd_docs, no_docs):
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    assert mined(odd_docs) == plain(rows)
    assert mined(no_docs) == []
    assert mined(make_docs(spark, ["a b"])) == []


def test_counts_of_tiles_do_not_depend_on_how_full_they_are(monkeypatch):
    rng = np.random.default_rng(1)
    left = rng.zipf(1.3, 50_000) % 400_000
    right = rng.zipf(1.3, 50_000) % 400_000
    there = col.address(left, right)
    assert all(np.array_equal(x, y) for x, y in zip(col.numbers_of(there), (left, right)))
    names, counts = np.unique(there, return_counts=True)
    for dense in (1, 300, 1 << 30):
        monkeypatch.setattr(col, "DENSE", dense)
        assert all(np.array_equal(x, y) for x, y in zip(col.tile_counts(there), (names, counts)))
        twice = col.tile_counts(np.concatenate([names, names]), np.concatenate([counts, counts]))
        assert np.array_equal(twice[0], names) and np.array_equal(twice[1], 2 * counts)
    with pytest.raises(OverflowError):
        col.address(np.array([1]), np.array([1 << col.RIGHT]))


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    row = spark.range(1).select(col.score(F.lit(big), F.lit(big + 1), F.lit(big)).alias("s")).first()
    assert row.s == 10**6 * big * big // ((big + 1) * big)
