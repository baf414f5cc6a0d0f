"""Incremental ingest of landed buoy files.

Every landed file is read once. Each micro-batch is merged per (station, datetime) and committed as
one part of a log, named by its batch number, so a repeated batch replaces itself and nothing stored
is rewritten. Rows that add nothing to the log are left out: a station file is landed again and again
with mostly the same rows. Reading the log merges it by key: earlier batches win, later ones fill what
was NULL.

Nothing is dropped for being late, so no watermark is set: the log is the state, and only
the months a batch touches are looked up in it. Compaction exchanges batches for one state in a single
commit, so that it may run beside readers and the ingest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewright.operators.merge import first_non_null
from tidewright.schemas import KEY, MEASURES, OBSERVATION, POSITION
from tidewright.session import materialize
from tidewright.sinks import versions
from tidewright.sinks.tables import MONTH, by_month
from tidewright.sources.buoy_text import (
    ORDER,
    parse_observations,
    stream_buoy_lines,
    with_line_order,
)

BATCH = "batch_id"
VALUES = POSITION + MEASURES

LOG = T.StructType(
    OBSERVATION.fields + [T.StructField(BATCH, T.LongType()), T.StructField(MONTH, T.StringType())]
)

# A compacted state has the rows of all batches up to the one its part names; in the log it comes before all batches.
UPTO, STATE = "upto-", -1


def batch_observations(lines: DataFrame) -> DataFrame:
    """Lines of one micro-batch to one row per (station, datetime)."""
    parsed = parse_observations(with_line_order(lines))
    return first_non_null(parsed.where("valid"), ORDER)


def news(batch: DataFrame, log: DataFrame) -> DataFrame:
    """Rows of the batch that are new to the log or fill a value it lacks.

    The log is cut down to the keys of the batch first, as in `absent_rows`.
    """
    hits = log.join(batch.select(*KEY), KEY, "left_semi")
    stored = first_non_null(hits, [BATCH]).withColumnsRenamed({c: f"_{c}" for c in VALUES})
    adds = [F.col(c).isNotNull() & F.col(f"_{c}").isNull() for c in VALUES]
    known = stored.withColumn("_known", F.lit(True))
    return (
        batch.join(known, KEY, "left")
        .where(F.col("_known").isNull() | reduce(lambda a, b: a | b, adds))
        .select(*batch.columns)
    )


def _upto(commit: Row | None) -> int:
    """The last batch that the state of a commit holds."""
    parts = [f["part"] for f in commit["folders"]] if commit else []
    return max([int(p.removeprefix(UPTO)) for p in parts if p.startswith(UPTO)], default=STATE)


def _stored(rows: DataFrame, batch_id: int) -> DataFrame:
    return by_month(rows).withColumn(BATCH, F.lit(batch_id).cast("long")).select(*LOG.fieldNames())


def store_batch(lines: DataFrame, batch_id: int, log: str) -> None:
    """Commit one micro-batch to the log; the same batch again replaces itself, and is passed over where a
    state holds it already."""
    spark = lines.sparkSession
    now = versions.latest(spark, log)
    if batch_id <= _upto(now):
        return
    rows = materialize(batch_observations(lines), "batch")
    if now is not None:
        months = by_month(rows).agg(F.min(MONTH), F.max(MONTH)).first()
        earlier = versions.read(spark, log, LOG, at=now)
        rows = news(rows, earlier.where((F.col(BATCH) < batch_id) & F.col(MONTH).between(*months)))
    stored = _stored(rows, batch_id).hint("rebalance", MONTH)
    versions.rewrite(stored, log, str(batch_id), [BATCH, MONTH])


def ingest_landing(
    spark: SparkSession, landing: str, log: str, checkpoint: str, max_files: int | None = None
) -> StreamingQuery:
    """Read all files that landed since the last run into the log, then stop."""
    return (
        stream_buoy_lines(spark, landing, max_files)
        .writeStream.foreachBatch(lambda lines, batch_id: store_batch(lines, batch_id, log))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """The last compacted state and the batches after it."""
    return versions.read(spark, log, LOG)


def merged_observations(spark: SparkSession, log: str) -> DataFrame:
    """The ingested observations: one row per (station, datetime)."""
    return first_non_null(read_log(spark, log), [BATCH])


def compact(spark: SparkSession, log: str) -> None:
    """Exchange the batches of the log for one merged state, in one commit.

    Repeating it changes nothing. An ingest may commit batches meanwhile: they stay beside the state.
    """
    now = versions.latest(spark, log)
    batches = [f["part"] for f in now["folders"] if not f["part"].startswith(UPTO)] if now else []
    if not batches:
        return
    gone, upto = {f["part"] for f in now["folders"]}, max(map(int, batches))
    merged = first_non_null(versions.read(spark, log, LOG, at=now), [BATCH])
    folder = versions.store(_stored(merged, STATE).hint("rebalance", MONTH), log, [BATCH, MONTH])
    state = (f"{UPTO}{upto}", folder)
    versions.commit(spark, log, lambda there: [state, *(f for f in there if f[0] not in gone)], LOG)
