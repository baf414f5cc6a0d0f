"""The manifest against a plain tree."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from llm_helpers import make_docs, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from tidewright.llm import merkle, positions
from tidewright.llm.common import staged


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def up(nodes):
    """All levels of a plain tree, the root's last."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def plain_manifest(rows):
    """Rows of (doc_id, source, lang, n_chars, text) as the contract has them."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r, h(*map(field, r))))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {s: up([leaf for _, leaf in by[s]]) for s in names}
    top = up([trees[s][-1][0] for s in names])
    out = []
    for s in names:
        for i, (r, leaf) in enumerate(by[s]):
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if c.isascii() else c for c in text)
            value, proof = h(*map(field, (*r[:4], text))), []
            for levels, at in ((trees[s], i), (top, names.index(s))):
                for level in levels[:-1]:
                    low = at // 16 * 16
                    run, slot = level[low : low + 16], at - low
                    proof += run[:slot] + run[slot + 1 :]
                    value, at = h(*run[:slot], value, *run[slot + 1 :]), low // 16
            root = top[-1][0]
            out.append((r[0], leaf, trees[s][-1][0], root, h(*proof), value, value == root))
    return sorted(out, key=str)


def query(spark, df, tmp_path):
    from tidewright.llm.queries import op13_merkle_manifest

    df.write.parquet(str(tmp_path / "documents.parquet"))
    return sorted((tuple(r) for r in op13_merkle_manifest(spark, str(tmp_path)).collect()), key=str)


@pytest.mark.parametrize(("n", "sources"), [(1, 1), (16, 1), (17, 2), (300, 18), (9000, 2)])
def test_manifest_equals_a_plain_tree(spark, tmp_path, n, sources):
    rng = random.Random(n)
    rows = [(i * 3, f"s{rng.randint(1, sources) ** 2}" if i % 2 else "s1", "en", i, f"Text {i}") for i in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert query(spark, df, tmp_path) == plain_manifest(rows)


def test_odd_rows_are_leaves(spark, tmp_path, odd_docs):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in odd_docs.collect()]
    assert query(spark, odd_docs, tmp_path) == plain_manifest(rows)


def test_no_rows_give_none(no_docs):
    found = merkle.merkle_manifest(no_docs)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert found.count() == 0


def test_the_proof_folds_to_the_root(spark):
    found = merkle.merkle_manifest(make_docs(spark, [f"T{i}" for i in range(40)], sources=["a", "b"]), with_proof=True).collect()
    for r in found:
        assert h(*r.proof) == r.proof_sha256 and r.verified
    assert {len(r.proof) for r in found} == {3}  # two levels of 20 leaves, one of the two subroots


def test_the_state_before_a_slot_is_resumed(monkeypatch):
    """Folding hashes the replacement and the right siblings only."""
    nodes = [h(str(i)).encode() for i in range(40)]
    level = merkle.Parents(nodes)
    seen = []

    class Counted:
        def __init__(self, state):
            self.state = state

        def copy(self):
            return Counted(self.state.copy())

        def update(self, data):
            seen.append(len(data) // 64)
            self.state.update(data)

        def hexdigest(self):
            return self.state.hexdigest()

    level.states = [Counted(s) for s in level.states]
    new = h("new").encode()
    assert level.folded(20, new).decode() == h(*[n.decode() for n in nodes[16:20]], new.decode(), *[n.decode() for n in nodes[21:32]])
    assert seen == [1, 11]
    assert level.folded(39, new).decode() == h(*[n.decode() for n in nodes[32:39]], new.decode())


def test_places_of_rows(spark):
    rows = [(g, v) for g in (None, "a", "b") for v in range(50)] + [("a", 7)] * 30
    df = spark.createDataFrame(rows, "g string, v int").repartition(5)
    found = positions.numbered(staged(df, "t"), "g", [F.col("v")]).collect()
    for g, n in ((None, 50), ("a", 80), ("b", 50)):
        own = sorted((r.pos, r.v, r["size"]) for r in found if r.g == g)
        assert [p for p, _, _ in own] == list(range(n)) and [v for _, v, _ in own] == sorted(v for k, v in rows if k == g)
        assert {s for _, _, s in own} == {n}
