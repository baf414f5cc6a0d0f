"""Similarity join on word shingles by chosen paths.

Every text is the set of its 5-word shingles; equal sets are one entry. A signature of 64 minimum hashes
stands for the set: two signatures agree in as many places as the sets are similar, so that a place
with its value is a token of the signature. A path picks at each node places at random, 1 / similarity
of them on average, and goes on with the values there; the same node picks the same places for all
sets. Similar sets keep meeting along paths, others part. Nodes with few sets are compared by brute
force, larger ones split further, and as many independent runs are made as the wanted recall needs.

Nodes only propose: their similar signatures form loose classes, within which the sets themselves are
compared, all with all, in blocks. So every link inside a loose class is found, and no pair of
documents is ever a row: tasks return counts of links and a spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import staged, text_or_empty
from tidewright.llm.components import connected_components
from tidewright.llm.windows import mixed, window_hashes, word_slices

SHINGLE, SIMILARITY = 5, 0.8
PLACES = 64
#: Wanted share of the pairs at the threshold that are proposed, and the first and last depth that is looked at.
RECALL, DEPTH, DEEPEST = 0.9995, 2, 5
#: Sets of a node that are compared at once, and members that every block of a larger node sees, on average.
NODE_SETS, LEADERS = 1024, 32
#: Sets and shingles in a block of the exact comparison, and shingles compared at a time.
BLOCK_SETS, BLOCK_SHINGLES, BLOCK_TOKENS = 1024, 2_000_000, 8192
#: Part of the allowed loss that is left to the signatures, which may lie below the threshold by chance.
SIGNATURE_LOSS = 0.3
SLICE_WORDS = 500_000

_RNG = np.random.default_rng(20240501)
_FACTORS = _RNG.integers(1, 1 << 63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _RNG.integers(0, 1 << 63, PLACES, dtype=np.uint64)
_PLACE_MARKS = mixed(np.arange(1, PLACES + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_sets(texts: Iterable[str], width: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each text. A text of fewer words is one shingle; one without words, none."""
    for _, split in word_slices(texts, SLICE_WORDS):
        hashes, owner = window_hashes(split, width)
        bounds = np.searchsorted(owner, np.arange(len(split) + 1))
        for i, own in enumerate(split):
            if len(own) >= width:
                yield np.unique(hashes[bounds[i] : bounds[i + 1]])
            else:
                yield np.array([xxhash.xxh3_64_intdigest(b" ".join(own))] if own else [], dtype=np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of minimum hashes per set, none of which may be empty."""
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), PLACES), dtype=np.uint32)
    for i in range(PLACES):
        out[:, i] = np.minimum.reduceat((flat * _FACTORS[i] + _TERMS[i]) >> np.uint64(32), starts)
    return out


def _entry(shingles: np.ndarray) -> int | None:
    """The 64-bit mark of a set; None for the empty one."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63) if len(shingles) else None


def _equal_places(similarity: float) -> np.ndarray:
    """The probability of 0, 1, ... equal places in the signatures of two sets of that similarity."""
    return np.array([math.comb(PLACES, m) * similarity**m * (1 - similarity) ** (PLACES - m) for m in range(PLACES + 1)])


def least_equal(similarity: float = SIMILARITY, recall: float = RECALL) -> int:
    """Equal places that a pair must have to be proposed; pairs at the threshold have fewer with a
    probability of at most `SIGNATURE_LOSS` of what `recall` allows."""
    below = np.cumsum(_equal_places(similarity))
    return int(np.searchsorted(below, SIGNATURE_LOSS * (1 - recall), side="right"))


def missed(runs: int, depth: int = DEPTH, similarity: float = SIMILARITY, recall: float = RECALL) -> float:
    """The probability that a pair at the threshold has too few equal places or meets in none of the runs
    at a node of that depth. With m equal places a run is a branching process: every one of them is
    picked with the same probability and leads to a shared child."""
    places = np.arange(PLACES + 1)
    meets = np.ones(PLACES + 1)
    for _ in range(depth):
        meets = 1 - (1 - meets * min(1.0, 1 / (similarity * PLACES))) ** places
    apart = np.where(places < least_equal(similarity, recall), 1.0, (1 - meets) ** runs)
    return float(_equal_places(similarity) @ apart)


def runs_needed(recall: float = RECALL, depth: int = DEPTH, similarity: float = SIMILARITY) -> int:
    """Runs after which a pair at the threshold that is compared at `depth` is proposed with probability `recall`."""
    runs = 1
    while missed(runs, depth, similarity, recall) > 1 - recall:
        runs += 1
    return runs


def next_nodes(nodes: np.ndarray, sets: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(index into `nodes`, child) of all paths that go on from each node with its signature."""
    dice = mixed(nodes[:, None] ^ _PLACE_MARKS[None, :])
    which, place = np.nonzero(dice < np.uint64(int(2.0**64 / (similarity * PLACES))))
    value = sets[which, place].astype(np.uint64)
    return which, mixed(dice[which, place] + value * np.uint64(0x9E3779B97F4A7C15))


def first_nodes(sets: np.ndarray, similarity: float, runs: int, depth: int = DEPTH, done: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(index into `sets`, node) of all paths of the runs after the first `done` at the first depth looked at."""
    roots = mixed(np.arange(done + 1, runs + 1, dtype=np.uint64))
    who = np.repeat(np.arange(len(sets)), runs - done)
    nodes = np.tile(roots, len(sets))
    for _ in range(depth):
        which, nodes = next_nodes(nodes, sets[who], similarity)
        who = who[which]
    pairs = np.unique(np.stack([who.astype(np.uint64), nodes]), axis=1)
    return pairs[0].astype(np.int64), pairs[1]


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, rows: np.ndarray, columns: np.ndarray) -> list[tuple[int, int]]:
        """The pairs that connect something new."""
        made = []
        for i, j in zip(rows.tolist(), columns.tolist()):
            a, b = self.find(i), self.find(j)
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                made.append((i, j))
        return made


def similar_forest(sets: np.ndarray, least: int, pieces: np.ndarray | None = None, step: int = 128) -> list[tuple[int, int]]:
    """Pairs of signatures with `least` equal places that connect what is not connected yet. Rows of one
    piece are connected from the start; blocks of rows within one tree are passed over."""
    n, made, forest = len(sets), [], Forest(len(sets))
    if pieces is not None:
        _, first, own = np.unique(pieces, return_index=True, return_inverse=True)
        forest.parent = first[own]
    starts = list(range(0, n, step))
    blocks = [(a, a) for a in starts] + [(a, b) for i, a in enumerate(starts) for b in starts[i + 1 :]]
    for a, b in blocks:
        roots = {forest.find(i) for s in {a, b} for i in range(s, min(s + step, n))}
        if len(roots) == 1:
            continue
        x, y = sets[a : a + step], sets[b : b + step]
        equal = np.zeros((len(x), len(y)), dtype=np.uint8)
        for place in range(PLACES):
            equal += x[:, place, None] == y[None, :, place]
        rows, columns = np.nonzero(equal >= least)
        keep = rows + a < columns + b
        made += forest.join(rows[keep] + a, columns[keep] + b)
    return made


def gathered_pieces(sets: np.ndarray, entry: np.ndarray, leaders: int, least: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """(pairs that connect, piece of each row) of a block whose first rows are the leaders of its node.

    The leaders alone make pieces that all blocks of the node agree on. A row is in the piece of leaders that
    the block connects it with, else in one of the block alone; a piece has the smallest entry as name."""
    among = Forest(len(sets))
    pairs = similar_forest(sets[:leaders], least)
    among.join(*np.array(pairs, dtype=int).reshape(-1, 2).T)
    lead = np.array([among.find(i) for i in range(len(sets))])
    pairs += similar_forest(sets, least, lead)
    for i, j in pairs:
        among.join(np.array([i]), np.array([j]))
    roots = np.array([among.find(i) for i in range(len(sets))])
    named = np.where(roots < leaders, lead[roots], roots)
    named[:leaders] = lead[:leaders]
    least_of = np.full(len(sets), np.iinfo(np.int64).max)
    np.minimum.at(least_of, named[:leaders], entry[:leaders])
    alone = named >= leaders
    np.minimum.at(least_of, named[alone], entry[alone])
    return pairs, least_of[named]


def exact_links(sets: list[np.ndarray], split: int, similarity: float) -> np.ndarray:
    """Whether each pair of sets, between the first `split` and the rest, or among all for 0, is similar."""
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    left, right = (slice(0, split), slice(split, None)) if split else (slice(None), slice(None))
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes.astype(int))
    _, token, seen = np.unique(flat, return_inverse=True, return_counts=True)
    shared = seen[token] > 1  # what only one set has is in no intersection
    renumbered = np.cumsum(seen > 1) - 1
    token, owner = renumbered[token[shared]], owner[shared]
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    n_tokens = int(token[-1]) + 1 if len(token) else 0
    both = np.zeros((len(sizes[left]), len(sizes[right])), dtype=np.float32)
    for low in range(0, n_tokens, BLOCK_TOKENS):
        a, b = np.searchsorted(token, (low, low + BLOCK_TOKENS))
        dense = np.zeros((len(sets), min(BLOCK_TOKENS, n_tokens - low)), dtype=np.float32)
        dense[owner[a:b], token[a:b] - low] = 1.0
        both += dense[left] @ dense[right].T
    common = both.astype(np.float64)
    out = common / (sizes[left][:, None] + sizes[right][None, :] - common) >= similarity
    if not split:
        np.fill_diagonal(out, False)
    return out


def component_roots(linked: np.ndarray) -> np.ndarray:
    """The smallest position in the component of each, from a symmetric matrix of links."""
    root = np.arange(len(linked))
    while True:
        new = np.minimum(root, np.where(linked, root[None, :], len(root)).min(1, initial=len(root)))
        new = new[new]
        if (new == root).all():
            return root
        root = new


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The groups of rows that agree in the first `keys` columns; the rows come sorted by them."""
    open_parts: list[pa.RecordBatch] = []
    open_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)])
        starts = np.flatnonzero(np.concatenate(([True], (values[:, 1:] != values[:, :-1]).any(0))))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
            key = tuple(values[:, a].tolist())
            if key != open_key and open_parts:
                yield pa.Table.from_batches(open_parts)
                open_parts = []
            open_key = key
            open_parts.append(batch.slice(a, b - a))
    if open_parts:
        yield pa.Table.from_batches(open_parts)


def in_blocks(rows: DataFrame, blocks: Column) -> DataFrame:
    """`rows` with `i`, `j`, `side`: a group of rows becomes `blocks` blocks, and a row of block k comes
    once for each pair of blocks i <= j it is in; `side` says on which side of the pair."""
    blocks = F.greatest(F.lit(1), F.ceil(blocks).cast("int"))
    own = F.pmod(F.xxhash64("entry"), blocks).cast("int")
    rows = rows.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    pair = {"i": F.least("_own", "_other"), "j": F.greatest("_own", "_other"), "side": (F.col("_own") > F.col("_other")).cast("int")}
    return rows.withColumns(pair).drop("_own", "_other")


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4").reshape(-1, PLACES)


def similarity_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """Per row of `docs`: `id_col`, `class_id`, `n_links`.

    Two documents are linked if the Jaccard similarity of their shingle sets is at least `similarity`;
    `n_links` counts the other rows a row is linked to, copies included. A class holds what links
    connect; `class_id` is its smallest id. Texts without words link to nothing and are their own
    class, as are rows without id, whose class is null. Repeated rows are copies of each other; rows of one
    id with different texts are different members. Other columns are not read. An empty table gives none.
    """
    signed, found = _classes(docs, id_col, text_col, similarity, recall)
    alone = signed.where("doc is null or entry is null").select(
        F.col("doc").alias(id_col), F.col("doc").alias("class_id"), F.lit(0).cast("long").alias("n_links")
    )
    known = signed.where("doc is not null and entry is not null").select("doc", "entry")
    out = known.join(found, "entry").select(F.col("doc").alias(id_col), "class_id", "n_links")
    return out.unionByName(alone)


def _classes(docs: DataFrame, id_col: str, text_col: str, similarity: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """(`doc`, `key` of the text, `entry` of its set per row; `entry`, `root`, `class_id`, `n_links` per set)."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("key"), text.alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries, sizes, marks = [], [], []
            held: list[np.ndarray] = []

            def close() -> None:
                full = [s for s in held if len(s)]
                made = iter(signatures(full)) if full else iter(())
                for s in held:
                    entries.append(_entry(s))
                    sizes.append(len(s))
                    marks.append(next(made).tobytes() if len(s) else None)
                held.clear()

            words = 0
            for s in shingle_sets(t.as_py() for t in batch.column(2)):
                held.append(s)
                words += len(s)
                if words >= SLICE_WORDS:
                    close()
                    words = 0
            close()
            columns = [batch.column(0), batch.column(1), pa.array(entries, pa.int64()), pa.array(sizes, pa.int64()), pa.array(marks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "key", "entry", "size", "mark"])

    signed = staged(rows.mapInArrow(sign, "doc long, key long, entry long, size long, mark binary"), "signed")
    known = signed.where("doc is not null and entry is not null")
    # equal sets have equal signatures, so any of them will do
    entries = known.groupBy("entry").agg(F.min("doc").alias("first"), F.count("*").alias("copies"), F.max("size").alias("size"), F.max("mark").alias("mark"))
    entries = staged(entries, "entries")
    loose = _loose_classes(entries.select("entry", "mark"), similarity, recall)
    linked, partial = _exact_classes(rows, entries, loose, similarity)
    counted = partial.groupBy("entry").agg(F.sum("links").alias("links"))
    found = entries.select("entry", "first", "copies").join(linked, F.col("entry") == F.col("node"), "left")
    found = found.join(counted, "entry", "left").withColumn("root", F.coalesce("root", "entry"))
    named = found.groupBy("root").agg(F.min("first").alias("class_id"))
    n_links = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long")
    return signed.select("doc", "key", "entry"), found.join(named, "root").select("entry", "root", "class_id", n_links.alias("n_links"))


def _loose_classes(entries: DataFrame, similarity: float, recall: float) -> DataFrame:
    """`node`, `root`: entries that nodes of the paths hold together, by similar signatures.

    Nodes of up to NODE_SETS sets are compared whole. A larger one is first read once in blocks that also
    see the leaders of the node, which connects large classes into pieces. What is open then are the pairs
    between different pieces: a node of one piece is done, one with few open pairs is compared across
    its pieces, and only one with more splits further, at DEEPEST into blocks. Its members get the runs that
    the last depth needs, as a pair that meets only there is compared where fewer pairs meet in a run.
    """
    runs, most = runs_needed(recall, DEPTH, similarity), runs_needed(recall, DEEPEST, similarity)
    least = least_equal(similarity, recall)

    def start(upto: int, done: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, 1024):
                    part = batch.slice(a, 1024)
                    who, nodes = first_nodes(_matrix(part.column(1)), similarity, upto, done=done)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes.view(np.int64)), part.column(0).take(pa.array(who))], names=["path", "entry"]
                    )

        return work

    def further(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0).to_numpy().view(np.uint64)
            which, children = next_nodes(nodes, _matrix(batch.column(2)), similarity)
            yield pa.RecordBatch.from_arrays(
                [pa.array(children.view(np.int64)), batch.column(1).take(pa.array(which))], names=["path", "entry"]
            )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, 2):
            if group.num_rows < 2:
                continue
            entry = group["entry"].to_numpy()
            pairs = similar_forest(_matrix(group["mark"]), least, group["piece"].to_numpy())
            a, b = entry[[i for i, _ in pairs]], entry[[j for _, j in pairs]]
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each block the edges that connect something (no path), and the piece of each member."""
        for group in groups(batches, 2):
            entry, leads, own = (group[c].to_numpy() for c in ("entry", "leads", "own"))
            first = np.argsort(~leads.astype(bool), kind="stable")
            entry, own, sets = entry[first], own[first].astype(bool), _matrix(group["mark"])[first]
            pairs, piece = gathered_pieces(sets, entry, int(leads.sum()), least)
            a, b = entry[[i for i, _ in pairs]], entry[[j for _, j in pairs]]
            path = pa.array([None] * len(a) + [group["path"][0].as_py()] * int(own.sum()), pa.int64())
            columns = [path, pa.array(np.concatenate([a, entry[own]])), pa.array(np.concatenate([b, piece[own]]))]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "a", "b"])

    def together(paths: DataFrame) -> DataFrame:
        return staged(paths.join(paths.groupBy("path").agg(F.count("*").alias("sets")).where("sets > 1"), "path"), "shared")

    def compared(there: DataFrame) -> DataFrame:
        """Edges of the rows (path, block, piece, entry) within each block."""
        there = there.select("path", F.col("block").cast("long").alias("block"), "piece", "entry").join(entries, "entry")
        there = there.select("path", "block", "piece", "entry", "mark").repartition("path", "block").sortWithinPartitions("path", "block", "piece")
        return staged(there.mapInArrow(compare, "a long, b long"), "loose")

    def gathered(nodes: DataFrame) -> DataFrame:
        """What `gather` finds in blocks of large nodes; a leader is in all blocks of its node."""
        blocks = F.ceil(F.col("sets") / NODE_SETS).cast("int")
        own = F.pmod(F.xxhash64("entry", F.lit("block")), blocks).cast("int")
        leads = F.pmod(F.xxhash64("path", "entry"), F.col("sets")) < LEADERS
        seen = F.when(leads, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(own))
        there = nodes.select("path", own.alias("home"), leads.cast("int").alias("leads"), F.explode(seen).alias("block"), "entry")
        there = there.select("path", F.col("block").cast("long").alias("block"), "leads", (F.col("home") == F.col("block")).cast("int").alias("own"), "entry")
        there = there.join(entries, "entry").select("path", "block", "leads", "own", "entry", "mark")
        there = there.repartition("path", "block").sortWithinPartitions("path", "block", "entry")
        return staged(there.mapInArrow(gather, "path long, a long, b long"), "gathered")

    def judged(told: DataFrame) -> DataFrame:
        """Members (path, entry, piece) of the nodes that hold more than one piece, with the `largest` one
        and its size `held`, and the numbers of `sets` and of `open` pairs."""
        sizes = told.groupBy("path", "piece").agg(F.count("*").alias("n"))
        sizes = sizes.groupBy("path").agg(F.sum("n").alias("sets"), F.sum(F.col("n") * F.col("n")).alias("inner"), F.max(F.struct("n", "piece")).alias("top"))
        sizes = sizes.select("path", "sets", ((F.col("sets") * F.col("sets") - F.col("inner")) / 2).alias("open"), F.col("top.n").alias("held"), F.col("top.piece").alias("largest"))
        return staged(told.join(sizes.where("open > 0"), "path"), "judged")

    def across(nodes: DataFrame) -> DataFrame:
        """Blocks of the largest piece, each with all other members of the node, which are few."""
        blocks = F.ceil(F.col("held") / NODE_SETS).cast("int")
        own = F.array(F.pmod(F.xxhash64("entry"), blocks).cast("int"))
        seen = F.when(F.col("piece") == F.col("largest"), own).otherwise(F.sequence(F.lit(0), blocks - 1))
        return nodes.select("path", F.explode(seen).alias("block"), "piece", "entry")

    found: list[DataFrame] = []

    def settled(shared: DataFrame) -> DataFrame | None:
        """Compares what can be compared here; the rows (path, entry, piece, ...) of nodes that split further."""
        large = F.col("sets") > NODE_SETS
        found.append(compared(shared.where(~large).select("path", F.lit(0).alias("block"), F.col("entry").alias("piece"), "entry")))
        if shared.where(large).isEmpty():
            return None
        told = gathered(shared.where(large))
        found.append(told.where("path is null").select("a", "b"))
        nodes = judged(told.where("path is not null").select("path", F.col("a").alias("entry"), F.col("b").alias("piece")))
        wide = F.col("open") > NODE_SETS * NODE_SETS / 2
        if not nodes.where(~wide).isEmpty():
            found.append(compared(across(nodes.where(~wide))))
        return None if nodes.where(wide).isEmpty() else nodes.where(wide)

    split = settled(together(staged(entries.mapInArrow(start(runs, 0), "path long, entry long"), "paths")))
    if split is not None and most > runs:
        again = entries.join(split.select("entry").distinct(), "entry", "left_semi")
        extra = settled(together(staged(again.mapInArrow(start(most, runs), "path long, entry long"), "paths")))
        split = split if extra is None else split.unionByName(extra)
    for _ in range(DEPTH, DEEPEST):
        if split is None:
            break
        deeper = split.select("path", "entry").join(entries, "entry").select("path", "entry", "mark")
        split = settled(together(staged(deeper.mapInArrow(further, "path long, entry long").distinct(), "paths")))
    if split is not None:
        rest = in_blocks(split, F.col("sets") / NODE_SETS)
        found.append(compared(rest.withColumn("block", F.col("i") * F.lit(1 << 31) + F.col("j"))))
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return connected_components(edges)


def _exact_classes(rows: DataFrame, entries: DataFrame, loose: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(`node`, `root` of the true classes; `entry`, `links`, to be summed) from the sets of loose classes."""
    loose = loose.withColumnRenamed("root", "loose")
    members = loose.join(entries.select("entry", "first", "copies", "size"), F.col("node") == F.col("entry"))
    blocks = F.greatest(F.count("*") / BLOCK_SETS, F.sum("size") / BLOCK_SHINGLES)
    members = members.join(members.groupBy("loose").agg(blocks.alias("blocks")), "loose")
    members = members.select("loose", "blocks", "entry", "first", "copies")
    texts = rows.join(members, F.col("doc") == F.col("first")).select("loose", "blocks", "entry", "copies", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["loose", "blocks", "entry", "copies", "shingles"]
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                sets = list(shingle_sets(t.as_py() for t in part.column(4)))
                # rows that share an id may have other texts
                own = [_entry(s) == e.as_py() for s, e in zip(sets, part.column(2))]
                shingles = pa.array([s.tobytes() for s in sets], pa.binary())
                made = pa.RecordBatch.from_arrays([*(part.column(i) for i in range(4)), shingles], names=names)
                yield made.filter(pa.array(own, pa.bool_()))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, 3):
            table = group.sort_by("side")
            sets = [np.frombuffer(x, "<u8") for x in table["shingles"].to_pylist()]
            entry, copies = table["entry"].to_numpy(), table["copies"].to_numpy()
            within = table["i"][0] == table["j"][0]
            split = 0 if within else int((table["side"].to_numpy() == 0).sum())
            if len(sets) < 2 or not within and split in (0, len(sets)):
                continue
            linked = exact_links(sets, split, similarity)
            if split:
                links = np.concatenate([linked @ copies[split:], linked.T @ copies[:split]])
            else:
                links = linked @ copies
            whole = linked
            if split:
                whole = np.zeros((len(sets), len(sets)), dtype=bool)
                whole[:split, split:], whole[split:, :split] = linked, linked.T
            root = component_roots(whole)
            under = np.flatnonzero(root != np.arange(len(sets)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([entry, entry[under]])),
                    pa.array(np.concatenate([links, np.zeros(len(under))]).astype(np.int64)),
                    pa.array([None] * len(entry) + entry[root[under]].tolist(), pa.int64()),
                ],
                names=["entry", "links", "to"],
            )

    sets = texts.mapInArrow(read, "loose long, blocks double, entry long, copies long, shingles binary").dropDuplicates(["entry"])
    there = in_blocks(sets, F.col("blocks"))
    there = there.select("loose", "i", "j", "side", "entry", "copies", "shingles")
    there = there.repartition("loose", "i", "j").sortWithinPartitions("loose", "i", "j")
    made = staged(there.mapInArrow(compare, "entry long, links long, to long"), "links")
    linked = connected_components(made.where(F.col("to").isNotNull()).select(F.col("entry").alias("a"), F.col("to").alias("b")))
    return linked, made.where(F.col("to").isNull()).select("entry", "links")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, recall: float = RECALL
) -> DataFrame:
    """The rows of `docs` without near duplicates: of each class the row with the smallest id stays.

    Classes are those of texts, so that an id with different texts may stay several times; of equal ids in one
    class one text stays, and of rows that share id and text one. Texts without words and rows without id
    all stay, but for repeated rows of the former. Columns of any name are carried along.
    """
    signed, found = _classes(docs, id_col, text_col, similarity, recall)
    signed = signed.where("doc is not null").join(found.select("entry", "root"), "entry", "left")
    alone = signed.where("root is null").select("doc", "key")
    stay = signed.where("root is not null").groupBy("root").agg(F.min(F.struct("doc", "key")).alias("least")).select("least.*")
    stay = staged(stay.unionByName(alone).distinct(), "stay")
    rows = docs.where(F.col(id_col).isNotNull())
    rows = rows.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_or_empty(text_col)).alias("key"), F.struct(*docs.columns).alias("row"))
    kept = rows.join(stay, ["doc", "key"]).groupBy("doc", "key").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return kept.select("row.*").unionByName(docs.where(F.col(id_col).isNull()))
