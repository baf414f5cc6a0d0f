"""Merkle manifest of a dataset by SHA-256 midstates.

Rows are leaves; 16 nodes next to each other become their hash, up to one root per group and one root of
all groups. A parent keeps a copy of its hash state before each child's slot. To fold a path anew, the copy
at the slot is resumed with the replacement and the siblings right of it; what lies left is not hashed again.

A block is the subtree of three levels, 4,096 leaves at most. A first pass turns blocks into their top
nodes, the few levels above are grouped in SQL, and each block gets one row with its way up to the root.
A second pass reads blocks with their ways: the states of all their parents, and those above, are in the
task that folds the block's leaves. No task sees more than a block, and no group or source is a key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import staged
from tidewright.llm.jaccard_join import groups
from tidewright.llm.positions import numbered

#: Children of a node, levels of a block.
ARITY, LEVELS = 16, 3
BLOCK = ARITY**LEVELS
#: Characters of a digest.
HEX = 64
#: What a manifest covers, in the order of the hash.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

WAY = "way array<struct<children: string, slot: int>>"
FOUND = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def leaf_digest(values: list[Column]) -> Column:
    """Hash of the values: `-` for null, else the number of UTF-8 bytes, a colon and the value."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


class Parents:
    """The parents of a run of nodes, with the copied states before each child's slot."""

    def __init__(self, nodes: list[bytes]):
        self.flat = memoryview(b"".join(nodes))
        self.states, self.digests = [], []
        for low in range(0, len(nodes), ARITY):
            state = hashlib.sha256()
            for child in nodes[low : low + ARITY]:
                self.states.append(state.copy())
                state.update(child)
            self.digests.append(state.hexdigest().encode())

    def left(self, i: int) -> memoryview:
        return self.flat[i // ARITY * ARITY * HEX : i * HEX]

    def right(self, i: int) -> memoryview:
        return self.flat[(i + 1) * HEX : (i // ARITY + 1) * ARITY * HEX]

    def folded(self, i: int, value: bytes) -> bytes:
        """The digest of the parent of node i with `value` in its slot."""
        state = self.states[i].copy()
        state.update(value)
        state.update(self.right(i))
        return state.hexdigest().encode()


def subtree(leaves: list[bytes], size: int) -> list[Parents]:
    """The levels of a block of a tree with `size` leaves: one node that is alone in its tree gets no parent."""
    made = []
    while size > 1 and len(made) < LEVELS:
        made.append(Parents(made[-1].digests if made else leaves))
        size = -(-size // ARITY)
    return made


def ways_up(nodes: DataFrame) -> DataFrame:
    """`tree`, `pos`, `way`, `top` for all `nodes` (tree, pos, size, digest): the children of every parent
    on the way with the slot that leads there, and the root of the tree."""
    children = F.array_sort(F.collect_list(F.struct("pos", "digest")))
    levels = [staged(nodes.withColumn("children", F.lit(None).cast("string")), "nodes")]
    while not levels[-1].where("size > 1").isEmpty():
        below = levels[-1].where("size > 1").groupBy("tree", "size", F.floor(F.col("pos") / ARITY).alias("up"))
        made = below.agg(F.array_join(F.transform(children, lambda x: x["digest"]), "").alias("children"))
        made = made.select(
            "tree", F.col("up").alias("pos"), F.ceil(F.col("size") / ARITY).alias("size"), F.sha2(F.col("children").cast("binary"), 256).alias("digest"), "children"
        )
        levels.append(staged(made, "nodes"))
    found, above = None, None
    for level in reversed(levels):
        none = F.expr("cast(array() as array<struct<children: string, slot: int>>)")
        here = level.where("size = 1").select("tree", "pos", none.alias("way"), F.col("digest").alias("top"))
        if above is not None:
            over = above.select("tree", F.col("pos").alias("up"), "children").join(found.withColumnRenamed("pos", "up"), ["tree", "up"])
            lower = level.where("size > 1").withColumn("up", F.floor(F.col("pos") / ARITY)).drop("children").join(over, ["tree", "up"])
            step = F.struct("children", (F.col("pos") % ARITY).cast("int").alias("slot"))
            here = here.unionByName(lower.select("tree", "pos", F.concat(F.array(step), F.col("way")).alias("way"), "top"))
        found, above = here, level
    return found


def _blocks(batches: Iterator[pa.RecordBatch], work: Callable[[pa.Table], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in groups(batches, 2):
        yield work(block.combine_chunks())


def _tops(block: pa.Table) -> pa.RecordBatch:
    """The top node of a block: tree, pos, size, digest."""
    size = block["size"][0].as_py()
    leaves = [x.encode() for x in block["leaf"].to_pylist()]
    levels = subtree(leaves, size)
    top = levels[-1].digests[0] if levels else leaves[0]
    columns = [[block["tree"][0].as_py()], [block["block"][0].as_py()], [-(-size // BLOCK)], [top.decode()]]
    return pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2]), pa.array(columns[3])], names=["tree", "pos", "size", "digest"])


def _folds(block: pa.Table, with_proof: bool) -> pa.RecordBatch:
    """Proofs and folded roots of the leaves of a block; its first row is the way up."""
    way, subroot, root = (block[c][0].as_py() for c in ("way", "subroot", "root"))
    rows = block.slice(1)
    leaves = [x.encode() for x in rows["leaf"].to_pylist()]
    levels = subtree(leaves, rows["size"][0].as_py())
    above, right_of = [], []
    for step in way:
        flat, at = step["children"].encode(), step["slot"] * HEX
        above.append((hashlib.sha256(flat[:at]), flat[at + HEX :]))
        right_of.append(flat[:at] + flat[at + HEX :])
    higher = b"".join(right_of)
    proofs, folded, siblings = [], [], []
    for i, value in enumerate(x.encode() if x else leaves[k] for k, x in enumerate(rows["replacement"].to_pylist())):
        proof, at, own = hashlib.sha256(), i, []
        for level in levels:
            left, right = level.left(at), level.right(at)
            proof.update(left)
            proof.update(right)
            if with_proof:
                own.append(bytes(left).decode() + bytes(right).decode())
            value, at = level.folded(at, value), at // ARITY
        proof.update(higher)
        for state, right in above:
            state = state.copy()
            state.update(value)
            state.update(right)
            value = state.hexdigest().encode()
        proofs.append(proof.hexdigest())
        folded.append(value.decode())
        siblings.append(own + [x.decode() for x in right_of])
    n = rows.num_rows
    columns = [rows["doc_id"].combine_chunks(), rows["leaf"].combine_chunks(), pa.array([subroot] * n), pa.array([root] * n), pa.array(proofs), pa.array(folded), pa.array([x == root for x in folded])]
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    if with_proof:
        columns.append(pa.array(siblings, pa.list_(pa.string())))
        names.append("proof")
    return pa.RecordBatch.from_arrays(columns, names=names)


def merkle_manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "source",
    fields: tuple[str, ...] = FIELDS,
    replacement: Column | None = None,
    with_proof: bool = False,
) -> DataFrame:
    """Per row of `docs`: `id_col`, `leaf`, `subroot` of its group, `root`, `proof_sha256` of its siblings up to
    the root, `folded_root` from its `replacement` (the digest of a changed leaf; null: the leaf as it is)
    and `verified`, whether that is the root. `with_proof` adds `proof`, the siblings of each level as one text.

    Leaves of a group stand in the order of their ids, nulls first, equal ids by their digest; groups in the
    order of their names, null first. Null and empty values have different leaves. Repeated rows are leaves
    of their own. Other columns are not read. An empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(group_col).cast("string").alias("source"),
        leaf_digest([F.col(c) for c in fields]).alias("leaf"),
        (F.lit(None).cast("string") if replacement is None else replacement).alias("replacement"),
    )
    # rows of one id and one leaf may have different replacements
    placed = staged(numbered(staged(rows, "leaves"), "source", [F.col("doc_id"), F.col("leaf"), F.col("replacement")]), "placed")
    sources = numbered(placed.select("source").distinct().withColumn("all", F.lit("")), "all", [F.col("source")])
    sources = staged(sources.select(F.col("source").alias("_source"), F.col("pos").alias("tree"), F.col("size").alias("trees")), "sources")
    placed = placed.join(sources, placed["source"].eqNullSafe(sources["_source"])).withColumn("block", F.floor(F.col("pos") / BLOCK))
    placed = placed.select("tree", "block", "pos", "size", "doc_id", "leaf", "replacement")
    dealt = placed.select("tree", "block", "pos", "size", "leaf").repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    tops = dealt.mapInArrow(lambda b: _blocks(b, _tops), "tree long, pos long, size long, digest string")
    ways = staged(ways_up(tops), "ways")
    roots = ways.groupBy("tree").agg(F.min("top").alias("digest")).join(sources, "tree")
    roots = roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("trees").alias("size"), "digest")
    last = ways_up(roots).select(F.col("pos").alias("tree"), F.col("way").alias("last"), F.col("top").alias("root"))
    ways = ways.join(last, "tree").select(
        "tree", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), F.concat("way", "last").alias("way"), F.col("top").alias("subroot"), "root"
    )
    met = ways.unionByName(placed, allowMissingColumns=True)
    met = met.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    schema = FOUND + (", proof array<string>" if with_proof else "")
    return met.mapInArrow(lambda b: _blocks(b, lambda x: _folds(x, with_proof)), schema).withColumnRenamed("doc_id", id_col)
