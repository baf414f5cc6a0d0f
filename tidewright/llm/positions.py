"""Places of rows in the order of their group, without a task that sees a whole group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from tidewright.llm.common import staged


def numbered(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """`rows` with `pos`, the place from 0 by `order` among the rows of its `group`, and `size`, their number.

    Rows are sorted in ranges, each numbers its own, and what lies before a range is added: a row per
    group and range. Rows that tie may take any order among themselves, also across ranges, so `order`
    must tell all rows apart that are not the same. Null is a group.
    """
    at = rows.columns.index(group)
    ranges = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = [F.col(group), *order, F.col("_tie")]
    ranges = ranges.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    schema = StructType([*rows.schema.fields])
    schema = schema.add("_part", IntegerType()).add("_nth", LongType())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column(at).dictionary_encode(null_encoding="encode").indices.to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
            nth = np.arange(batch.num_rows) - np.repeat(starts, np.diff(np.append(starts, batch.num_rows)))
            if batch.column(at)[0].as_py() == last:
                nth[: starts[1] if len(starts) > 1 else None] += seen
            last, seen = batch.column(at)[-1].as_py(), int(nth[-1]) + 1
            columns = [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(nth)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_part", "_nth"])

    there = staged(ranges.mapInArrow(place, schema), "ranges")
    counts = there.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_of")).agg(F.count("*").alias("_n"))
    whole = Window.partitionBy("_group")
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("_group", "_of", before.alias("_before"), F.sum("_n").over(whole).alias("size"))
    found = there.join(counts, there[group].eqNullSafe(counts["_group"]) & (there["_part"] == counts["_of"]))
    return found.select(*(there[c] for c in rows.columns), (F.col("_before") + F.col("_nth")).alias("pos"), "size")
