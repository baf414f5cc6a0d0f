"""Fixtures and helpers of the tests in this folder."""

from __future__ import annotations

import pytest

#: Texts that every operator must take: null, empty, blank, one word, odd characters, long, and repeated.
ODD_TEXTS = [
    None,
    "",
    " \t\n",
    "word",
    "naïve 漢字 😀   ￾ ￿ é",
    "x" * 5000,
    "long " * 3000,
    "the same text twice, the same text twice, the same text twice",
    "the same text twice, the same text twice, the same text twice",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts with null and repeated ids, and columns that carry the operators' own names."""
    rows = [(None if i == 4 else min(i, 7), t, "en", None if i % 2 else "src", len(t or ""), "mine", 1) for i, t in enumerate(ODD_TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, spans int")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


def make_docs(spark, texts, start=0, sources=None):
    rows = [(start + i, t, "en", (sources or ["s"])[i % len(sources or ["s"])], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
