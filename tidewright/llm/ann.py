"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample of the vectors and every vector is filed in a leaf. A query walks
the tree best bin first: a priority queue holds the nodes not yet opened, nearest first, and the
leaves come out in the order in which they promise neighbours. How many leaves a query visits is calibrated
for the leaf it starts in: visits widen until the queries of the sample that start there, and all
together, find the wanted share of their true neighbours. So a dense cluster does not decide for rare
vectors. Nor does a query end before its leaves hold enough vectors.
Nearness is the inner product. Vectors get one more component that makes their norms equal, so that
the nearest vector by distance is the one of largest inner product.

Equal vectors are one entry of the index with their smallest ids: no more than k + 1 of them can be
among the k nearest of any row, so nothing is lost, and a vector that very many rows share costs one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import staged

K = 20
#: Vectors the tree is fitted on at most, and bytes of them.
SAMPLE, SAMPLE_BYTES = 65_536, 64 << 20
#: Children of a node, sample vectors of a leaf, rounds of k-means per node.
BRANCHES, LEAF, ROUNDS = 16, 256, 8
#: Wanted share of true neighbours, and queries it is measured on per leaf at most.
RECALL, CALIBRATION = 0.94, 16
#: Entries of the index that make a part of their own, and queries that meet one part at most on average.
ENTRIES, QUERIES = 8192, 1024
#: Rows with the same vector that one group numbers on average.
SALT_ROWS = 1 << 16

FOUND = pa.schema([("entry", pa.int64()), ("vec_id", pa.list_(pa.int64())), ("score", pa.list_(pa.float64()))])
WALK = pa.schema([("part", pa.int32()), ("entry", pa.int64()), ("leaves", pa.binary()), ("vector", pa.list_(pa.float64()))])


@dataclass
class Tree:
    """Inner nodes hold their children's centres and numbers; a child below 0 is leaf -1 - child."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaves: int = 0
    norm: float = 1.0

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Entries with the component that makes all norms equal."""
        return np.hstack([x, np.sqrt(np.maximum(self.norm**2 - (x * x).sum(1), 0.0))[:, None]])

    def file(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each entry: down the nearest centres."""
        out = np.zeros(len(x), dtype=np.int64)
        lifted = self.lifted(x)
        todo = [(0, np.arange(len(x)))] if self.centres else []
        while todo:
            node, rows = todo.pop()
            nearest = _nearest(lifted[rows], self.centres[node])
            for i, child in enumerate(self.children[node]):
                own = rows[nearest == i]
                if not len(own):
                    continue
                if child < 0:
                    out[own] = -1 - child
                else:
                    todo.append((child, own))
        return out

    def visit(self, query: np.ndarray) -> Iterator[int]:
        """The leaves in best-bin-first order."""
        if not self.centres:
            yield 0
            return
        lifted = np.append(query / max(float(np.linalg.norm(query)), 1e-300) * self.norm, 0.0)
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if node < 0:
                yield -1 - node
                continue
            distances = ((self.centres[node] - lifted) ** 2).sum(1)
            for child, distance in zip(self.children[node], distances.tolist()):
                heapq.heappush(queue, (distance, child))

    def visited(self, query: np.ndarray, visits: np.ndarray, held: dict[int, int], least: int) -> list[int]:
        """The leaves for a query: as many as the first one asks for, and until they hold `least` vectors."""
        found, seen, most = [], 0, 1
        for leaf in self.visit(query):
            if not found:
                most = int(visits[leaf])
            elif len(found) >= most and seen >= least:
                break
            found.append(leaf)
            seen += held.get(leaf, 0)
        return found


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1)[None, :] - 2.0 * (x @ centres.T)).argmin(1)


def fit_tree(sample: np.ndarray, norm: float, seed: int = 7) -> Tree:
    """K-means splits of the sample, node by node, until a node has at most LEAF vectors."""
    tree, rng = Tree(norm=norm), np.random.default_rng(seed)
    lifted = tree.lifted(sample)

    def grow(rows: np.ndarray) -> int:
        x = lifted[rows]
        if len(rows) <= LEAF:
            return _leaf()
        centres = x[rng.choice(len(x), min(BRANCHES, len(x)), replace=False)]
        for _ in range(ROUNDS):
            own = _nearest(x, centres)
            sums = np.zeros_like(centres)
            np.add.at(sums, own, x)
            sizes = np.bincount(own, minlength=len(centres))
            centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
        own = _nearest(x, centres)
        used = np.unique(own)
        if len(used) < 2:
            return _leaf()
        node = len(tree.centres)
        tree.centres.append(centres[used])
        tree.children.append([])
        tree.children[node] = [grow(rows[own == i]) for i in used]
        return node

    def _leaf() -> int:
        tree.leaves += 1
        return -tree.leaves

    if grow(np.arange(len(sample))) < 0:
        return Tree(leaves=1, norm=norm)
    return tree


def calibrate(tree: Tree, sample: np.ndarray, k: int, recall: float = RECALL, seed: int = 11) -> np.ndarray:
    """Per leaf, the least number of visits with which the queries of the sample that start there reach the
    recall, and not fewer than all queries need together. A query is not its own neighbour."""
    if not tree.centres:
        return np.ones(1, dtype=np.int64)
    rng = np.random.default_rng(seed)
    filed = tree.file(sample)
    order = rng.permutation(len(sample))
    order = order[np.argsort(filed[order], kind="stable")]
    nth = np.arange(len(order)) - np.searchsorted(filed[order], filed[order])
    queries = order[nth < CALIBRATION]
    weight = np.bincount(filed, minlength=tree.leaves) / np.maximum(1, np.bincount(filed[queries], minlength=tree.leaves))
    # how many neighbours a leaf's queries have in the leaf they visit n-th
    needed = np.zeros((tree.leaves, tree.leaves))
    for low in range(0, len(queries), 16):
        some = queries[low : low + 16]
        below = -(sample[some] @ sample.T)
        below[np.arange(len(some)), some] = np.inf
        near = np.argpartition(below, min(k, len(sample) - 1) - 1, axis=1)[:, : min(k, len(sample) - 1)]
        for i, own in zip(some.tolist(), near):
            rank = np.empty(tree.leaves, dtype=np.int64)
            way = list(tree.visit(sample[i]))
            rank[way] = np.arange(len(way))
            np.add.at(needed[way[0]], rank[filed[own]], weight[filed[i]])
    enough = lambda x: np.argmax(np.cumsum(x, -1) >= recall * x.sum(-1, keepdims=True), -1) + 1
    return np.maximum(enough(needed), enough(needed.sum(0)))


def usable(vector: Column) -> Column:
    """Neither null nor empty nor zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(rows: DataFrame, k: int = K) -> DataFrame:
    """`entry` (smallest id), `ids` (the k + 1 smallest), `vector`: one row per distinct vector of
    `rows` (vec_id, vector). Rows of one vector are first cut down in many groups, then in one."""
    salts = 1 + rows.count() // SALT_ROWS
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(salts))
    order = Window.partitionBy("vector", "salt").orderBy("vec_id")
    few = rows.withColumn("salt", salt).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)
    ids = F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1)
    return few.groupBy("vector").agg(ids.alias("ids")).select(F.col("ids")[0].alias("entry"), "ids", "vector")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64).reshape(len(column), -1)


def part_of_leaves(sizes: dict[int, int], leaves: int, entries: int = ENTRIES) -> list[tuple[int, int]]:
    """(first part, number of parts) of every leaf: leaves next to each other share a part until it is
    full, a leaf that is larger than a part gets several of its own."""
    out, part, filled = [], 0, 0
    for leaf in range(leaves):
        size = sizes.get(leaf, 0)
        if filled and filled + size > entries:
            part, filled = part + 1, 0
        count = max(1, -(-size // entries))
        out.append((part, count))
        filled += size
        if count > 1:
            part, filled = part + count, 0
    return out


def best(query: np.ndarray, leaves: list[np.ndarray], entries: np.ndarray, leaf: np.ndarray, ids: list[list[int]], k: int) -> Iterator[tuple[list[int], list[float]]]:
    """Per query the ids and scores of its k + 1 nearest rows in its leaves, ties to smaller ids."""
    order = np.argsort(leaf, kind="stable")
    names, starts = np.unique(leaf[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    for low in range(0, len(query), 256):
        own = query[low : low + 256]
        scores = np.full((len(own), len(entries)), -np.inf)
        for name, a, b in zip(names, starts, ends):
            asks = [i for i, seen in enumerate(leaves[low : low + 256]) if (s := np.searchsorted(seen, name)) < len(seen) and seen[s] == name]
            rows = order[a:b]
            scores[np.ix_(asks, rows)] = own[asks] @ entries[rows].T
        for row in scores:
            least = np.partition(row, len(row) - k - 1)[len(row) - k - 1] if len(row) > k + 1 else -np.inf
            near = np.flatnonzero((row >= least) & (row > -np.inf))
            found = sorted((-float(row[i]), v) for i in near for v in ids[i])[: k + 1]
            yield [v for _, v in found], [-s for s, _ in found]


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    recall: float = RECALL,
) -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id`, `score` for every row of `vectors` where `is_query`.

    Candidates are all rows but the query's own. Rows without id, and vectors that are not `usable` or not
    of the commonest length, take no part. Equal scores rank by id. A table without usable vectors
    gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), is_query.alias("asks")
    )
    rows = staged(rows, "vectors")
    length = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if length is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vector") == length["d"])
    entries = staged(distinct_vectors(rows, k), "entries")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    n, longest = entries.agg(F.count("*"), F.max(norm)).first()
    most = max(LEAF, min(SAMPLE, SAMPLE_BYTES // (8 * length["d"])))
    sample = entries.orderBy(F.xxhash64("entry"), "entry").limit(most).select("vector").collect()
    sample = np.array([r["vector"] for r in sample], dtype=np.float64)
    tree = fit_tree(sample, float(longest))
    visits = calibrate(tree, sample, k, recall)

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = pa.array(tree.file(_matrix(batch.column(2))), pa.int32())
            yield pa.RecordBatch.from_arrays([leaf, *batch.columns], names=["leaf", *batch.schema.names])

    index = staged(entries.mapInArrow(filed, "leaf int, entry long, ids array<long>, vector array<double>"), "index")
    # a row per leaf of the bounded tree
    leaves = index.groupBy("leaf").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("held")).collect()
    sizes, held = {r["leaf"]: r["n"] for r in leaves}, {r["leaf"]: r["held"] for r in leaves}
    parts = part_of_leaves(sizes, tree.leaves)

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for entry, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_part: dict[int, list[int]] = {}
                for leaf in tree.visited(np.array(vector), visits, held, k + 1):
                    first, count = parts[leaf]
                    for part in range(first, first + count):
                        by_part.setdefault(part, []).append(leaf)
                rows = [(p, entry, np.sort(np.array(x, "<i4")).tobytes(), vector) for p, x in by_part.items()]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), WALK)], schema=WALK)

    asked = rows.where("asks").select("vec_id", "vector")
    asked = asked.join(entries.select("entry", F.col("vector").alias("same")), F.col("vector") == F.col("same"))
    asked = staged(asked.select(F.col("vec_id").alias("query_id"), "entry"), "asked")
    asking = entries.join(asked.select("entry").distinct(), "entry", "left_semi").select("entry", "vector")
    walks = staged(asking.mapInArrow(visited, "part int, entry long, leaves binary, vector array<double>"), "walks")
    # where very many queries come to a part, they come in turns
    load = walks.groupBy("part").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("turns"))
    places = F.array(*(F.struct(F.lit(f).alias("first"), F.lit(c).alias("count")) for f, c in parts))
    place = F.element_at(places, F.col("leaf") + 1)
    index = index.withColumn("part", (place["first"] + F.pmod(F.xxhash64("entry"), place["count"])).cast("int"))
    index = index.join(load, "part").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
    walks = walks.join(load, "part").withColumn("turn", F.pmod(F.xxhash64("entry"), F.col("turns")).cast("int"))
    index = index.select("part", "turn", "leaf", "ids", "vector")
    walks = walks.select("part", "turn", "entry", "leaves", "vector")

    def search(asks: pa.Table, there: pa.Table) -> pa.Table:
        if not asks.num_rows or not there.num_rows:
            return FOUND.empty_table()
        leaves = [np.frombuffer(x, "<i4") for x in asks["leaves"].to_pylist()]
        made = list(best(_matrix(asks["vector"]), leaves, _matrix(there["vector"]), there["leaf"].to_numpy(), there["ids"].to_pylist(), k))
        columns = [asks["entry"].combine_chunks(), pa.array([v for v, _ in made], pa.list_(pa.int64())), pa.array([s for _, s in made], pa.list_(pa.float64()))]
        return pa.table(columns, schema=FOUND)

    found = walks.groupBy("part", "turn").cogroup(index.groupBy("part", "turn")).applyInArrow(
        search, "entry long, vec_id array<long>, score array<double>"
    )
    pairs = F.zip_with("vec_id", "score", lambda v, s: F.struct((-s).alias("low"), v.alias("vec_id")))
    found = found.groupBy("entry").agg(F.slice(F.array_sort(F.flatten(F.collect_list(pairs))), 1, k + 1).alias("near"))
    out = asked.join(found, "entry")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = out.select("query_id", F.posexplode(others).alias("pos", "x"))
    return out.select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.low")).alias("score")
    )
