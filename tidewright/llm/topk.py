"""Exact top-k search by MaxScore over integer vectors.

A component of a vector is the weight of a term: floor(scale * x). The vectors are dealt into shards; a
shard holds one posting list per term, with positions where the weight is not zero, and the range of
its weights. A query gives every term a bound, the most it can add to a score in the shard. The terms
with the smallest bounds, which together stay below the k-th score found so far, are non-essential: a
vector that no essential term raises cannot enter. So only the postings of the essential terms are
traversed; vectors that they raise are probed in the other terms, largest bound first, while the score
so far and the bounds left can still reach the k-th. Bounds are compared with "below", so ties stay.

A task takes a block of queries and the shards of one part, one after another, and carries the k-th
scores on. The best of all parts are merged by a grouped top-k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import staged
from tidewright.llm.jaccard_join import groups

K, SCALE = 5, 256
#: Vectors of a shard, shards of a part, and queries of a block.
SHARD, PART_SHARDS, QUERIES = 2048, 8, 1024

FOUND = "query_id long, vec_id long, score long"
LAST = (1 << 63) - 1


class Shard:
    """Posting lists by term. `terms` has a row per term and a column per vector; `ids` ascend."""

    def __init__(self, ids: np.ndarray, terms: np.ndarray):
        self.ids, self.terms = ids, terms
        self.low, self.high = terms.min(1, initial=0), terms.max(1, initial=0)
        #: None where the term is in every vector
        self.positions = [None if (row != 0).all() else np.flatnonzero(row) for row in terms]

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """The most that each term can add to a score."""
        return np.maximum(query * self.low, query * self.high)


def essential_terms(bounds: np.ndarray, least) -> tuple[np.ndarray, np.ndarray]:
    """(essential, others), both by falling bound. The others together stay below `least`."""
    order = np.argsort(bounds, kind="stable")
    n = int(np.searchsorted(np.cumsum(bounds[order]), least, side="left")) if least is not None else 0
    return order[n:][::-1], order[:n][::-1]


def search(shard: Shard, query: np.ndarray, own: int, k: int, least) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the vectors of a shard that may be among the k best; no other has a score of
    `least` (None: not known yet) or more, and of those at most the k best by score and id."""
    bounds = shard.bounds(query)
    essential, others = essential_terms(bounds, least)
    score = np.zeros(len(shard.ids), dtype=np.result_type(query.dtype, shard.terms.dtype))
    raised = np.full(len(shard.ids), least is None or least <= 0)
    for t in essential:
        if not query[t]:
            continue
        at = shard.positions[t]
        if at is None:
            added = query[t] * shard.terms[t]
            score += added
            raised |= added > 0
        else:
            added = query[t] * shard.terms[t, at]
            score[at] += added
            raised[at] |= added > 0
    alive = np.flatnonzero(raised & (shard.ids != own))
    score = score[alive]
    # what is left after each of the others, the largest first
    left = np.append(np.cumsum(bounds[others][::-1])[::-1], 0)
    for i, t in enumerate(others):
        if least is not None:
            stay = score + left[i] >= least
            if not stay.all():
                alive, score = alive[stay], score[stay]
        if not len(alive):
            break
        if query[t]:
            score = score + query[t] * shard.terms[t, alive]
    if least is not None:
        stay = score >= least
        alive, score = alive[stay], score[stay]
    if len(alive) > k:
        stay = score >= np.sort(score)[-k]
        alive, score = alive[stay], score[stay]
        # ids ascend, so a stable sort keeps the smaller ones
        best = np.argsort(-score, kind="stable")[:k]
        alive, score = alive[best], score[best]
    return shard.ids[alive], score


def exact_type(queries: np.ndarray, terms: np.ndarray) -> np.dtype:
    """A type in which no sum of products of the two can be inexact."""
    largest = lambda x: max(-float(x.min(initial=0)), float(x.max(initial=0)))
    most = largest(queries) * largest(terms) * max(1, len(terms))
    return np.dtype(np.float64 if most < 2.0**52 else np.int64 if most < 2.0**62 else object)


def search_shards(query_ids: np.ndarray, queries: np.ndarray, shards: Iterator[tuple[np.ndarray, np.ndarray]], k: int) -> Iterator[tuple[int, int, int]]:
    """(query, vector, score) of the k best vectors in all shards for every query."""
    best: list[list[tuple[int, int]]] = [[] for _ in queries]
    for ids, terms in shards:
        # shorter vectors lack the last terms
        width = min(len(terms), queries.shape[1])
        own, terms = queries[:, :width], terms[:width]
        kind = exact_type(own, terms)
        own, shard = own.astype(kind), Shard(ids, terms.astype(kind))
        for i, query in enumerate(own):
            least = -best[i][-1][0] if len(best[i]) == k else None
            found, scores = search(shard, query, int(query_ids[i]), k, least)
            best[i] = sorted(best[i] + [(-int(s), int(v)) for s, v in zip(scores, found)])[:k]
    for name, near in zip(query_ids, best):
        yield from ((int(name), v, max(-LAST, min(LAST, -s))) for s, v in near)


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, at the ends of a long where it is beyond; null unless all
    components are finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(blobs: list[bytes], rows: list[int]) -> np.ndarray:
    width = max((len(b) // (8 * n) for b, n in zip(blobs, rows) if n), default=0)
    out = np.zeros((sum(rows), width), dtype=np.int64)
    at = 0
    for b, n in zip(blobs, rows):
        own = np.frombuffer(b, "<i8").reshape(n, -1)
        out[at : at + n, : own.shape[1]] = own
        at += n
    return out


def top_k(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    scale: int = SCALE,
) -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id`, `score` of the k highest integer inner products for every row of
    `vectors` where `is_query`; all where there are fewer. Ties go to the smaller id.

    Candidates are all rows but the query's own. Rows without id or vector, and vectors with a null or
    non-finite component, take no part. Components that a vector lacks count as zero. Of rows that share
    an id the smallest vector counts, and is a query if any of them is. Floors and scores beyond the range of
    a long stand at its end. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    vector = F.col(vector_col)
    rows = vectors.where(F.col(id_col).isNotNull() & vector.isNotNull())
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), quantised(vector, scale).alias("weights"), is_query.alias("asks"))
    rows = rows.where("weights is not null").groupBy("vec_id").agg(F.min("weights").alias("weights"), F.coalesce(F.max("asks"), F.lit(False)).alias("asks"))
    rows = staged(rows, "weights")
    n, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    if not asking:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    parts, blocks = 1 + n // (SHARD * PART_SHARDS), 1 + asking // QUERIES

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shards of the rows of a part: ids and weights of vectors, the ids ascending."""
        for part in groups(batches, 1):
            for low in range(0, part.num_rows, SHARD):
                own = part.slice(low, SHARD).combine_chunks()
                lists = own["weights"].combine_chunks()
                lengths = np.diff(lists.offsets.to_numpy())
                wide = np.zeros((own.num_rows, int(lengths.max(initial=0))), dtype="<i8")
                wide[np.arange(wide.shape[1])[None, :] < lengths[:, None]] = lists.flatten().to_numpy()
                columns = [[own["part"][0].as_py()], [own.num_rows], [own["vec_id"].to_numpy().astype("<i8").tobytes()], [wide.tobytes()]]
                kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["part", "n", "ids", "weights"])

    def packed(some: DataFrame, of: str, many: int) -> DataFrame:
        dealt = some.select(F.pmod(F.xxhash64("vec_id", F.lit(of)), F.lit(many)).alias("part"), "vec_id", "weights")
        dealt = dealt.repartition("part").sortWithinPartitions("part", "vec_id")
        return dealt.mapInArrow(pack, "part long, n int, ids binary, weights binary")

    shards = staged(packed(rows, "shard", parts), "shards").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = packed(rows.where("asks"), "query", blocks).withColumnRenamed("part", "block")
    asked = staged(asked, "queries").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    columns = [F.col("block").cast("long"), F.col("part").cast("long")]
    met = asked.select(*columns, F.lit(0).alias("kind"), "n", "ids", "weights")
    met = met.unionByName(shards.select(*columns, F.lit(1).alias("kind"), "n", "ids", "weights"))
    met = met.repartition("block", "part").sortWithinPartitions("block", "part", "kind")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, 2):
            asks = group.filter(pc.equal(group["kind"], 0))
            there = group.filter(pc.equal(group["kind"], 1))
            if not asks.num_rows:
                continue
            ids = np.frombuffer(b"".join(asks["ids"].to_pylist()), "<i8")
            queries = _matrix(asks["weights"].to_pylist(), asks["n"].to_pylist())
            shards = (
                (np.frombuffer(i.as_py(), "<i8"), np.ascontiguousarray(np.frombuffer(w.as_py(), "<i8").reshape(m.as_py(), -1).T))
                for m, i, w in zip(there["n"], there["ids"], there["weights"])
            )
            found = list(search_shards(ids, queries, shards, k))
            columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(),) * 3)] if found else []
            if columns:
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = met.mapInArrow(work, FOUND).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
