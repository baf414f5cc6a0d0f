"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """`node`, `root` for every node of `edges` (a, b); the root is the smallest node of the component.

    A large star hangs the larger neighbours of each node under the smallest one, a small star the
    smaller ones. Both keep the components; when nothing changes, each component is one star.
    Minima are combined before they travel, and each round is written down.
    """
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    down = staged(down, "edges")
    before = None
    while True:
        count, mark = down.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if (count, mark) == before:
            break
        before = (count, mark)
        both = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u != v"), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        down = staged(small, "small")
    leaves = down.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(down.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
