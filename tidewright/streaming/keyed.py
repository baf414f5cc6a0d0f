"""Incremental ingest with the open observations in Spark's state store.

The other way to `ingest`: each (station, datetime) is kept as state, from the first file that names it until
the watermark has passed it, and is then stored once and for good. Nothing stored is read again, so a run
costs what its new files cost; in return an observation comes after a delay, and rows that are later than
the delay are not stored but counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewright.operators.merge import first_non_null
from tidewright.schemas import OBSERVATION
from tidewright.sinks import versions
from tidewright.sinks.tables import MONTH, STORED_OBSERVATION, by_month
from tidewright.sources.buoy_text import ORDER, parse_observations, stream_buoy_files

DELAY = "2 days"
_KEPT_REPORTS = "spark.sql.streaming.numRecentProgressUpdates"


def _store(rows: DataFrame, batch_id: int, target: str) -> None:
    """Commit the observations that became final; the same batch again replaces itself."""
    spark = rows.sparkSession
    final = by_month(rows.withColumn("datetime", F.col("datetime").cast("timestamp_ntz")))
    # A batch without final rows leaves no part, but the first one makes the table.
    if not rows.isEmpty() or versions.latest(spark, target) is None:
        final = final.select(*STORED_OBSERVATION.fieldNames()).hint("rebalance", MONTH)
        versions.rewrite(final, target, str(batch_id), [MONTH])


def ingest_keyed(
    spark: SparkSession, landing: str, target: str, checkpoint: str, delay: str = DELAY, max_files: int | None = None
) -> StreamingQuery:
    """Read all files that landed since the last run, store the observations that are final, then stop.

    An observation is final when one more than `delay` later was seen; the first value of each measure
    in the order of the sources counts, over all files that came until then. A file is read as a whole, so
    it must fit in a row. Invalid rows and rows without a station are left out.
    """
    parsed = parse_observations(stream_buoy_files(spark, landing, max_files)).where("valid")
    timed = parsed.withColumn("datetime", F.col("datetime").cast("timestamp")).withWatermark("datetime", delay)
    return (
        first_non_null(timed, ORDER)
        .writeStream.outputMode("append")
        .foreachBatch(lambda rows, batch_id: _store(rows, batch_id, target))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def final_observations(spark: SparkSession, target: str) -> DataFrame:
    """What is stored: one row per (station, datetime)."""
    return versions.read(spark, target, STORED_OBSERVATION).select(*OBSERVATION.fieldNames())


def late_keys(spark: SparkSession, run: StreamingQuery) -> int:
    """How many (station, datetime) came too late in a finished run, counted once per micro-batch."""
    reports = run.recentProgress
    if len(reports) >= int(spark.conf.get(_KEPT_REPORTS)):
        raise RuntimeError(f"reports of earlier batches may be gone: raise {_KEPT_REPORTS}")
    return sum(s["numRowsDroppedByWatermark"] for r in reports for s in r["stateOperators"])
