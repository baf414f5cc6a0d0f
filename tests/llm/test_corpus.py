"""Operators that look across documents, against brute force; mixing, chat formatting, the pipeline."""

from __future__ import annotations

import collections
import hashlib
import json
import random

import numpy as np
import pytest
from llm_helpers import make_docs, no_docs, odd_docs  # noqa: F401
from pyspark.sql import functions as F

from tidewright.llm import ann, chat, jaccard_join, mixing, pii, quality, queries, substring_dedup
from tidewright.llm.components import connected_components


def noise(rng, n):
    return [f"w{rng.randint(0, 10**9)}" for _ in range(n)]


# --- substring dedup ----------------------------------------------------------------------


def plain_dedup(docs, width=13):
    """{row position: (words, removed, kept)} by the rule of the contract."""
    split = [(i, [w.decode() for w in (t or "").encode().split()]) for i, t in docs]
    first = {}
    for i, words in split:
        for k in range(len(words) - width + 1) if i is not None else ():
            key = tuple(words[k : k + width])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, words in split:
        gone = {k + j for k in range(len(words) - width + 1) if i is not None and first[tuple(words[k : k + width])] < i for j in range(width)}
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


def passages(rng):
    shared = [noise(rng, n) for n in (13, 14, 30, 60)]
    texts = []
    for _ in range(120):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts += noise(rng, rng.randint(0, 20)) + (rng.choice(shared) if rng.random() < 0.6 else [])
        texts.append(rng.choice([" ", "\n", "\t "]).join(parts))
    return texts + texts[:10] + ["a " * 100, "a " * 40, " ".join(shared[3][:40]), None]


@pytest.mark.parametrize(("slice_words", "group"), [(1_000_000, 1 << 18), (150, 64)])
def test_windows_of_earlier_documents_go(spark, monkeypatch, slice_words, group):
    """With tiny slices and groups the windows meet across tasks and settled ones travel by document."""
    monkeypatch.setattr(substring_dedup, "SLICE_WORDS", slice_words)
    monkeypatch.setattr(substring_dedup, "GROUP_WINDOWS", group)
    rng = random.Random(12)
    docs = list(enumerate(passages(rng)))
    rng.shuffle(docs)
    docs += [(None, docs[0][1]), (docs[1][0], docs[2][1]), docs[3]]  # without id; one id, two texts; a repeated row
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = substring_dedup.dedup_substrings(frame).collect()
    mine = sorted(((r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["removed"]), r["kept"]) for r in got), key=str)
    assert mine == sorted(plain_dedup(docs), key=str)
    for r in got:  # maximal intervals do not touch
        assert all(a["end"] < b["start"] for a, b in zip(r["removed"], r["removed"][1:]))


def test_dedup_of_odd_and_no_documents(odd_docs, no_docs):
    assert substring_dedup.dedup_substrings(odd_docs).count() == 9
    assert substring_dedup.dedup_substrings(no_docs).count() == 0


# --- n-gram Jaccard join ------------------------------------------------------------------


def plain_classes(docs, similarity=0.8):
    sets = []
    for _, text in docs:
        words = (text or "").encode().split()
        grams = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
        sets.append(grams)
    links = collections.defaultdict(set)
    for a in range(len(docs)):
        for b in range(a):
            if docs[a][0] is not None and docs[b][0] is not None and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if both / (len(sets[a]) + len(sets[b]) - both) >= similarity:
                    links[a].add(b)
                    links[b].add(a)
    out = []
    for a, (i, _) in enumerate(docs):
        seen, todo = {a}, [a]
        while todo:
            todo += (new := links[todo.pop()] - seen)
            seen |= new
        out.append((i, None if i is None else min(docs[k][0] for k in seen), len(links[a])))
    return sorted(out, key=str)


def near_copies(rng):
    texts = []
    for _ in range(15):
        base = noise(rng, rng.randint(30, 200))
        for _ in range(rng.randint(1, 6)):
            words = list(base)
            for _ in range(rng.randint(0, len(base) // 40)):
                words[rng.randrange(len(words))] = noise(rng, 1)[0]
            texts.append(" ".join(words))
    boiler = noise(rng, 60)
    texts += [" ".join(boiler + noise(rng, rng.randint(3, 60))) for _ in range(30)]
    return texts + texts[:5] + ["a b c", "a b c", "a b", "", None, "a b c d e"]


@pytest.mark.parametrize(("node", "block"), [(1024, 1024), (4, 3)])
def test_classes_agree_with_all_pairs(spark, monkeypatch, node, block):
    """With tiny limits nodes split further and classes are compared in blocks."""
    monkeypatch.setattr(jaccard_join, "NODE_SETS", node)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", block)
    rng = random.Random(21)
    docs = list(enumerate(near_copies(rng)))
    rng.shuffle(docs)
    docs += [(None, docs[0][1]), docs[1]]
    got = jaccard_join.similarity_classes(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_classes(docs)


def one_large_class(rng, n):
    """Copies of one text with a few other words each, others that share a part of it, and small classes."""
    base = noise(rng, 120)
    texts = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = noise(rng, 1)[0]
        texts.append(" ".join(words))
    texts += [" ".join(base[: rng.randint(40, 110)] + noise(rng, rng.randint(5, 60))) for _ in range(n // 4)]
    return texts + near_copies(rng)


@pytest.mark.parametrize(("node", "leaders", "shingles"), [(16, 4, 500)])
def test_a_large_class_is_connected_and_the_rest_found(spark, monkeypatch, node, leaders, shingles):
    """Nodes of one large piece and a few others are compared across their pieces."""
    monkeypatch.setattr(jaccard_join, "NODE_SETS", node)
    monkeypatch.setattr(jaccard_join, "LEADERS", leaders)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", shingles)
    docs = list(enumerate(one_large_class(random.Random(5), 200)))
    got = jaccard_join.similarity_classes(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_classes(docs)


def test_the_work_for_a_class_grows_with_its_size(spark, monkeypatch):
    """Rows that are dealt for comparison per member are as many for a large class as for a small one."""
    monkeypatch.setattr(jaccard_join, "NODE_SETS", 32)
    monkeypatch.setattr(jaccard_join, "LEADERS", 4)
    rng, made = np.random.default_rng(2), {}
    base = rng.integers(0, 1 << 32, jaccard_join.PLACES, dtype=np.uint32)
    real = jaccard_join.staged

    def counted(df, label):
        out = real(df, label)
        made[label] = made.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard_join, "staged", counted)
    per_member = []
    for n in (100, 800):
        made.clear()
        near = np.where(rng.random((n, jaccard_join.PLACES)) < 0.97, base, base + 1 + np.arange(n)[:, None]).astype(np.uint32)
        rows = [(i, bytearray(x.tobytes())) for i, x in enumerate(near)]
        loose = jaccard_join._loose_classes(spark.createDataFrame(rows, "entry long, mark binary"), 0.8, jaccard_join.RECALL)
        assert loose.select("root").distinct().count() == 1 and loose.count() == n
        per_member.append((made["paths"] + made["shared"] + made.get("gathered", 0) + made.get("judged", 0)) / n)
    assert per_member[1] <= 1.5 * per_member[0]


def test_a_pair_at_the_threshold_meets_in_the_runs():
    """Signatures that agree in 80 % of the places share a node in nearly all cases."""
    rng = np.random.default_rng(3)
    runs = jaccard_join.runs_needed()
    met = 0
    for _ in range(400):
        a = rng.integers(0, 1 << 32, jaccard_join.PLACES, dtype=np.uint32)
        b = np.where(rng.random(jaccard_join.PLACES) < 0.8, a, a + 1).astype(np.uint32)
        who, nodes = jaccard_join.first_nodes(np.stack([a, b]), 0.8, runs)
        met += bool(set(nodes[who == 0]) & set(nodes[who == 1]))
    assert met >= 396


@pytest.mark.parametrize("depth", [2, 3, 4, 5])
def test_the_runs_reach_the_recall_at_every_depth(depth):
    """Nodes that split are compared further down; all that is lost stays below what the recall allows."""
    rng = np.random.default_rng(depth)
    runs, least = jaccard_join.runs_needed(depth=depth), jaccard_join.least_equal()
    n, places = 2000, jaccard_join.PLACES
    a = rng.integers(0, 1 << 32, (n, places), dtype=np.uint32)
    b = np.where(rng.random((n, places)) < 0.8, a, a + 1).astype(np.uint32)
    left, right = (np.stack(jaccard_join.first_nodes(x, 0.8, runs, depth)) for x in (a, b))
    met = set(zip(*left.tolist())) & set(zip(*right.tolist()))
    found = {i for i, _ in met} & set(np.flatnonzero((a == b).sum(1) >= least).tolist())
    assert jaccard_join.missed(runs, depth) <= 1 - jaccard_join.RECALL
    assert n - len(found) <= 5


def test_pairs_that_meet_only_in_split_nodes_are_proposed(spark, monkeypatch):
    """With a tiny limit every node that two pairs share splits down to the last depth."""
    monkeypatch.setattr(jaccard_join, "NODE_SETS", 1)
    monkeypatch.setattr(jaccard_join, "LEADERS", 0)
    rng = np.random.default_rng(9)
    n, places = 1500, jaccard_join.PLACES
    a = rng.integers(0, 1 << 32, (n, places), dtype=np.uint32)
    b = np.where(rng.random((n, places)) < 0.8, a, a + 1).astype(np.uint32)
    rows = [(i, bytearray(x.tobytes())) for i, x in enumerate(a)] + [(n + i, bytearray(x.tobytes())) for i, x in enumerate(b)]
    loose = jaccard_join._loose_classes(spark.createDataFrame(rows, "entry long, mark binary"), 0.8, jaccard_join.RECALL)
    root = {r["node"]: r["root"] for r in loose.collect()}
    assert sum(i in root and root[i] == root.get(n + i) for i in range(n)) >= n - 4


def test_one_document_of_each_class_stays(spark, odd_docs, no_docs):
    rng = random.Random(22)
    texts = near_copies(rng)
    left = {r["doc_id"] for r in jaccard_join.drop_near_duplicates(make_docs(spark, texts)).collect()}
    assert left == {c for _, c, _ in plain_classes(list(enumerate(texts)))}
    kept = jaccard_join.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns and kept.where("doc_id is null").count() == 1 and kept.where("doc_id = 7").count() == 1
    assert jaccard_join.similarity_classes(odd_docs).count() == 9
    assert jaccard_join.drop_near_duplicates(no_docs).count() == 0


def test_texts_of_one_id_are_judged_one_by_one(spark):
    """Only a copy goes: the text of a class whose smallest id it shares with another text stays."""
    rng = random.Random(8)
    a, b, c = (" ".join(noise(rng, 40)) for _ in range(3))
    rows = [(1, a, "x"), (1, b, "y"), (2, c, "z"), (3, b, "u"), (2, c, "z"), (4, "", "v"), (4, "", "v"), (4, " ", "v"), (None, a, "w")]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, _first string, _stay int, root int, `key` int")
    kept = sorted((r.doc_id or 0, r.text, r._first) for r in jaccard_join.drop_near_duplicates(docs).collect())
    assert kept == sorted([(1, a, "x"), (1, b, "y"), (2, c, "z"), (4, "", "v"), (4, " ", "v"), (0, a, "w")])
    assert jaccard_join.drop_near_duplicates(docs).columns == docs.columns


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, 1000 + i) for i in range(1, 60)]
    pairs = chain + star + [(rng.randint(2000, 2060), rng.randint(2000, 2060)) for _ in range(45)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    parent = {x: x for p in pairs for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for p in pairs if p[0] != p[1] for x in p}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- nearest neighbours -------------------------------------------------------------------


def vectors(n, seed=0, copies=30):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, n)] + 0.4 * rng.normal(size=(n, 16))).astype(np.float32)
    x[:copies] = x[0]  # one vector that many rows share
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


def test_recall_scores_and_ties(spark, monkeypatch):
    monkeypatch.setattr(ann, "ENTRIES", 300)
    monkeypatch.setattr(ann, "QUERIES", 20)
    monkeypatch.setattr(ann, "LEAF", 32)
    rows = vectors(3000)
    odd = [(5000, None), (5020, []), (5040, [0.0] * 16), (5060, [float("nan")] * 16), (5080, [float("inf")] + [1.0] * 15), (5100, [1.0, 2.0]), (None, [1.0] * 16), (5120, [1.0, None] + [1.0] * 14)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("rank", F.lit("mine"))
    got = collections.defaultdict(list)
    for r in ann.nearest_neighbours(frame, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(got[r["query_id"]]) + 1
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 3000, 20))
    x = np.array([v for _, v in rows], dtype=np.float64)
    hit = 0
    for q, found in got.items():
        assert len(found) == 20 and q not in dict(found)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        np.testing.assert_allclose([s for _, s in found], x[[v for v, _ in found]] @ x[q], rtol=1e-12)
        score = x @ x[q]
        true = sorted(range(3000), key=lambda i: (-score[i], i))
        hit += len(set(true[:21]) - {q} & set(true[:21])) and len({v for v, _ in found} & set([i for i in true if i != q][:20]))
    assert hit / (20 * len(got)) >= 0.9
    # the shared vector: all its nearest are its copies, smallest ids first
    assert [v for v, _ in got[0]][:20] == list(range(1, 21)) and [v for v, _ in got[20]] == list(range(20))


def test_rare_vectors_are_searched_as_well_as_a_dense_cluster(spark, monkeypatch):
    """6,000 vectors in one tight cluster, 60 spread ones: recall of both groups apart, and full lists."""
    monkeypatch.setattr(ann, "LEAF", 64)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=24)
    x = np.vstack([centre + 0.05 * rng.normal(size=(6000, 24)), rng.normal(size=(60, 24)) * rng.uniform(0.3, 2, (60, 1))])
    x = x[rng.permutation(len(x))]
    rare = np.linalg.norm(x - centre, axis=1) > 1.5
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    asked = [*np.flatnonzero(rare).tolist(), *np.flatnonzero(~rare)[::100].tolist()]
    got = collections.defaultdict(set)
    for r in ann.nearest_neighbours(frame, F.col("vec_id").isin(asked)).collect():
        got[r.query_id].add(r.vec_id)
    recall = {True: [], False: []}
    for q in asked:
        score = x @ x[q]
        score[q] = -np.inf
        true = set(np.argsort(-score, kind="stable")[:20].tolist())
        assert len(got[q]) == 20
        recall[bool(rare[q])].append(len(true & got[q]) / 20)
    assert np.mean(recall[True]) >= 0.9 and np.mean(recall[False]) >= 0.9


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in ann.nearest_neighbours(few, F.col("vec_id") % 20 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 2, 1.0), (0, 2, 1, 0.0)]
    assert ann.nearest_neighbours(few.where("false"), F.lit(True)).count() == 0


# --- mixing -------------------------------------------------------------------------------


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Cap, reshare, repeat."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > most * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in free}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= full
    return target


def mixed_corpus(spark):
    rng = random.Random(31)
    rows = []
    for i in range(900):
        source = rng.choice(["hot"] * 6 + ["a", "b", "Ä", None])
        rows.append((i, " ".join(noise(rng, rng.randint(0, 60) if i % 97 else 3000)), source))
    rows += [(None, "x y z", "a"), (5, "x y z", "a"), (5, "x y z", "a"), (901, None, "b"), (902, "lone words here", "tiny"), (903, None, "empty")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix_meets_its_targets(spark, monkeypatch):
    rows, docs = mixed_corpus(spark)
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    want = plain_targets(sizes)
    for shard_docs in (4096, 60):
        got = mixing.plan_mix(docs, shard_docs=shard_docs).collect()
        assert len(got) == len(rows)
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    taken = collections.Counter()
    by_doc = {i: s for i, _, s in rows if i is not None}
    for r in got:
        if r["doc_id"] is not None:
            assert r["source_size"] == sizes[by_doc[r["doc_id"]]]
            assert r["target"] == pytest.approx(want[by_doc[r["doc_id"]]])
            taken[by_doc[r["doc_id"]]] += r["taken"]
    for source in ("hot", "a", "b", "Ä", None):
        assert taken[source] == pytest.approx(want[source], rel=0.02)
    again = mixing.plan_mix(docs.repartition(7), shard_docs=60).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_documents_hold_the_words_that_are_taken(spark, odd_docs, no_docs):
    _, docs = mixed_corpus(spark)
    docs = docs.where("doc_id > 5").withColumn("n_chars", F.length("text").cast("long"))
    planned = {r["doc_id"]: r["taken"] for r in mixing.plan_mix(docs).collect()}
    held = collections.Counter()
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in mixing.mix_documents(docs).collect():
        held[r["doc_id"]] += len(r["text"].split())
        assert set(r["text"].split()) <= set(whole[r["doc_id"]].split()) and r["n_chars"] == len(r["text"])
    assert {k: v for k, v in planned.items() if v} == dict(held)
    assert mixing.plan_mix(odd_docs).count() == 9 and mixing.plan_mix(no_docs).count() == 0
    assert mixing.mix_documents(odd_docs).columns == odd_docs.columns


def test_columns_of_any_name_are_carried_and_rows_without_id_dealt(spark):
    """Columns with the names that the plan uses itself; null ids lie in several shards."""
    names = ["size", "target", "taken", "start", "place", "source_size", "passes", "rest_words", "rest", "blocks", "offset", "_order", "row", "mixed", "_row", "_key"]
    rng = random.Random(3)
    rows = [(None if i % 2 else i, " ".join(noise(rng, 30)), "s", "en", 1, *[f"mine{i}"] * len(names)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, " + ", ".join(f"{n} string" for n in names))
    mixed = mixing.mix_documents(docs, shard_docs=16).collect()
    assert mixed and all(r[n].startswith("mine") for r in mixed for n in names)
    plan = mixing.plan_mix(docs, shard_docs=16).where("doc_id is null")
    assert plan.select("offset", "blocks", "rest_words").distinct().count() > 1
    assert abs(sum(len(r.text.split()) for r in mixed) - 9000) <= 64


def test_a_tiny_source_does_not_shred_the_others(spark):
    texts = [" ".join(f"w{i}" for i in range(3000)) for _ in range(20)]
    docs = make_docs(spark, [*texts, "lone words here"], sources=["a"] * 5 + ["b"] * 15 + [None])
    sizes = {"a": 15000, "b": 45000, None: 3}
    want, taken = plain_targets(sizes), collections.Counter()
    for r in mixing.plan_mix(docs).select("doc_id", "source_size", "taken").collect():
        taken[{v: k for k, v in sizes.items()}[r["source_size"]]] += r["taken"]
    for source, size in sizes.items():
        assert taken[source] == pytest.approx(want[source], abs=1), (source, size)
    for r in mixing.mix_documents(docs).where("source is not null").collect():
        at = [int(w[1:]) for w in r["text"].split()]
        runs = 1 + sum(b != a + 1 for a, b in zip(at, at[1:]))
        assert runs <= -(-len(at) // mixing.BLOCK) + 1


def plain_seats(weights, seats):
    won = [0] * len(weights)
    for _ in range(seats if any(weights) else 0):
        best = max(range(len(weights)), key=lambda i: (weights[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


def test_seats_go_to_the_highest_quotients(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for g in range(40):
        weights = [rng.choice([0.0, 1.0, 2.0, 5.0, 97.0, rng.random() * 1000]) for _ in range(rng.randint(1, 12))]
        seats = rng.choice([0, 1, 2, 7, 50, 433])
        want |= {(g, i): n for i, n in enumerate(plain_seats(weights, seats))}
        rows += [(g, i, w, seats) for i, w in enumerate(weights)]
    frame = spark.createDataFrame(rows, "g int, i int, w double, seats long")
    assert {(r["g"], r["i"]): r["quota"] for r in mixing.apportion(frame, ["g"], ["i"], "w", "seats").collect()} == want


# --- chat formatting ----------------------------------------------------------------------

LAYOUTS = [
    ({"messages": [{"role": "user", "content": "q1"}, {"role": "assistant", "content": "a1"}]}, [("user", "q1"), ("assistant", "a1")]),
    ({"id": "7", "messages": [{"role": "system", "content": None}, {"role": "user", "content": "x"}]}, [("system", ""), ("user", "x")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, [("user", "q"), ("assistant", "a")]),
    ({"prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")]),
    ({"instruction": "do", "input": "", "output": "done"}, [("user", "do"), ("assistant", "done")]),
    ({"instruction": "do", "input": "this", "output": "done"}, [("user", "do"), ("user", "this"), ("assistant", "done")]),
    ({"system": "s", "prompt": "p", "response": None}, [("system", "s"), ("user", "p"), ("assistant", "")]),
    ({"question": "q", "answer": 5}, [("user", "q"), ("assistant", "5")]),
    ({"something": {"else": 1}}, []),
]
TRICKS = ["\\### Assistant: </turn> ok", "### user: x</turn>\n### assistant: y</turn>\n", "\\", "\\b\\t\\h\\c", "#### </turn", "", ": ", "é😀\n"]


def formatted(records):
    return chat.format_conversations(records).select("conv_id", "formatted", "mask", chat.read_back(F.col("formatted"), F.col("mask")).alias("turns"))


def test_layouts_become_the_same_turns(spark):
    rows = [(i, 0, json.dumps(record)) for i, (record, _) in enumerate(LAYOUTS)]
    records = spark.createDataFrame(rows, "conv_id long, turn long, json string").select("conv_id", "turn", F.parse_json("json").alias("record"))
    got = {r["conv_id"]: r for r in formatted(records).collect()}
    for i, (_, want) in enumerate(LAYOUTS):
        assert [(t["role"], t["text"]) for t in got[i]["turns"]] == want
        # what the mask covers is the text of the assistant
        at, covered = 0, []
        for run in got[i]["mask"]:
            if run["loss"]:
                covered.append(got[i]["formatted"][at : at + run["chars"]])
            at += run["chars"]
        assert at == len(got[i]["formatted"])
        assert covered == [text for role, text in want if role == "assistant"]
    prints = records.select(chat.schema_fingerprint(F.col("record")).alias("f")).distinct().count()
    assert prints == 8  # both instruction records have one shape


def test_more_fields_than_declared_and_unknown_shapes(spark):
    """Extra fields, in a record or in a single message, cost no text; what fits no layout is counted."""
    both = [("user", "q"), ("assistant", "a")]
    cases = [
        ({"messages": [{"role": "user", "content": "q", "name": "x"}, {"role": "assistant", "content": "a"}]}, both),
        ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "meta": {"n": [1]}}, both),
        ({"prompt": "q", "response": "a", "id": 3, "score": 0.5}, both),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a", "weight": 1}], "id": "z"}, both),
        ({"instruction": "do", "input": "this", "output": "done", "lang": "en"}, [("user", "do"), ("user", "this"), ("assistant", "done")]),
        ({"system": "s", "prompt": "q", "response": None, "x": 1}, [("system", "s"), ("user", "q"), ("assistant", "")]),
        ({"role": "user", "text": "q", "at": "noon"}, [("user", "q")]),
        # a field that one message lacks reads as empty; a message with other names altogether fits nothing
        ({"messages": [{"role": "user"}, {"content": "a", "role": "assistant"}]}, [("user", ""), ("assistant", "a")]),
        ({"messages": [{"role": "user", "content": "q"}, {"who": "assistant", "says": "a"}]}, []),
        ({"messages": []}, []),
        ({"something": {"else": 1}}, []),
        ({"something": {"else": "one"}}, []),
        ("only a text", []),
        (None, []),
    ]
    rows = [(i, 0, None if record is None else json.dumps(record)) for i, (record, _) in enumerate(cases)]
    rows += [(2, 1, json.dumps({"something": {"else": 2}}))]
    records = spark.createDataFrame(rows, "conv_id long, turn long, json string").select("conv_id", "turn", F.parse_json("json").alias("record"))
    got = {r["conv_id"]: r for r in formatted(records).collect()}
    for i, (_, want) in enumerate(cases):
        assert [(t["role"], t["text"]) for t in got[i]["turns"]] == want, cases[i]
    unknown = {r["conv_id"]: len(r["unknown"]) for r in chat.format_conversations(records).collect()}
    assert unknown == {**{i: 0 for i in range(14)}, 2: 1, 8: 1, 9: 1, 10: 1, 11: 1, 12: 1}
    shapes = {r["shape"]: r["n"] for r in chat.unknown_shapes(records).collect()}
    assert len(shapes) == 4 and shapes["OBJECT<something: OBJECT<else: BIGINT>>"] == 3
    assert chat.unknown_shapes(records.where("false")).count() == 0


def test_texts_that_imitate_the_template_come_back(spark):
    rng = random.Random(3)
    rows = []
    for conv in range(30):
        for turn in range(rng.randint(1, 6)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "odd: role", "### x", None]), "".join(rng.choice(TRICKS) for _ in range(3))))
    rows += [(None, None, "user", "late"), (None, 3, "assistant", None), (1000, 0, "user", "same"), (1000, 0, "user", "same")]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    said = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    got = formatted(frame.select("conv_id", "turn", F.to_variant_object(said).alias("record"))).collect()
    want = collections.defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        want[conv].append((role or "", text or ""))
    assert {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in got} == want
    assert formatted(frame.where("false").select("conv_id", "turn", F.to_variant_object(said).alias("record"))).count() == 0


# --- the queries and the pipeline ---------------------------------------------------------


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in queries.llm_queries()] == [f"op{i}" for i in range(1, 14)]


def test_the_pipeline_stage_by_stage(spark):
    """Each stage against plain Python on what the stage before kept."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    from tidewright.llm import bpe

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "personal_data", "source_mix", "token_ids"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns = docs.columns
    good = corpus_pipeline.STAGES[0][1](spark, docs, "")
    kept = {r["doc_id"] for r in quality.judge_quality(docs).where("kept").collect()}
    assert {r["doc_id"] for r in good.collect()} == kept and good.columns == columns
    single = corpus_pipeline.STAGES[1][1](spark, good, "")
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    assert {r["doc_id"] for r in single.collect()} == {c for _, c, _ in plain_classes(rows)} and single.columns == columns
    clean = corpus_pipeline.STAGES[2][1](spark, single, "")
    assert clean.columns == columns and clean.count() == single.count()
    assert pii.find_personal_data(clean).where("size(base) > 0").count() == 0
    mix = corpus_pipeline.STAGES[3][1](spark, clean, "")
    planned = {r["doc_id"]: r["taken"] for r in mixing.plan_mix(clean).collect() if r["taken"]}
    held = collections.Counter()
    for r in mix.collect():
        held[r["doc_id"]] += len(r["text"].encode().split())
    assert dict(held) == planned and mix.columns == columns
    tokens = corpus_pipeline.STAGES[4][1](spark, mix, "").collect()
    tokenizer = Tokenizer.from_file(bpe.TOKENIZER)
    want = collections.Counter((r["doc_id"], tuple(tokenizer.encode(r["text"], add_special_tokens=False).ids)) for r in mix.collect())
    assert collections.Counter((r["doc_id"], tuple(r["ids"])) for r in tokens) == want
    assert all(r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest() for r in tokens)
    whole = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert collections.Counter(r["ids_sha256"] for r in whole.collect()) == collections.Counter(r["ids_sha256"] for r in tokens)
