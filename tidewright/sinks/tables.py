"""Tables: create, append, replace, insert-if-absent, upsert, partition rewrite, reload.

A target is a path (it contains `/`) or a catalog table name. Data is Parquet. Writes to a path are all
or nothing (see `versions`); a plain folder without commits can be read and is replaced as a whole.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.columns import instant, partition_key_of, with_bookkeeping
from tidewright.operators.merge import absent_rows, first_row
from tidewright.schemas import (
    ASSET_SCHEMAS,
    BOOKKEEPING,
    KEY,
    OBSERVATION,
    PARTITION_KEY,
    STATION_TABLE,
)
from tidewright.session import materialize
from tidewright.sinks import versions

# Observations are stored by month, so date predicates skip whole folders.
MONTH = "_month"
MONTH_FORMAT = "yyyyMM"
# Stations of a file that its Bloom filter is laid out for, and the rows of a page: what a read of one
# station opens at least.
STATION_FILTER = {
    "parquet.bloom.filter.enabled#station_id": "true",
    "parquet.bloom.filter.expected.ndv#station_id": "10000",
    "parquet.page.row.count.limit": "5000",
}
# A batch with at most so many stations names them to the scan of the stored keys.
NAMED_STATIONS = 200


def is_path(target: str) -> bool:
    return "/" in target


def table_exists(spark: SparkSession, target: str) -> bool:
    """Whether a catalog table, or the folder of a path, is there."""
    if not is_path(target):
        return spark.catalog.tableExists(target)
    if versions.begun(spark, target):
        return versions.latest(spark, target) is not None
    return versions.folder_exists(spark, target)


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    location: str | None = None,
) -> None:
    """Create the schema (database) and the table unless they exist."""
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    )
    parts = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partition_by)})" if partition_by else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}{place}")


def read_table(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored table; the schema keeps text partition keys text."""
    if not is_path(target):
        return spark.table(target)
    if versions.begun(spark, target):
        return versions.read(spark, target, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(target)


def _save(
    df: DataFrame, name: str, mode: str, partition_by: Sequence[str], options: Mapping[str, str] | None = None
) -> None:
    writer = df.write.format("parquet").mode(mode).options(**(options or {}))
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def append(
    df: DataFrame, target: str, partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None
) -> None:
    """Add rows; readers see all of them or none, but for a plain folder, which stays one."""
    if is_path(target):
        if table_exists(df.sparkSession, target) and not versions.begun(df.sparkSession, target):
            df.write.mode("append").options(**(options or {})).partitionBy(*partition_by).parquet(target)
        else:
            versions.append(df, target, partition_by, options=options)
    else:
        _save(df, target, "append", partition_by, options)


def replace(df: DataFrame, target: str, partition_by: Sequence[str] = (), made_from: int | None = None) -> None:
    """Write a result table anew; until it is complete the old one is read. At a path, `df` may read from the
    target; made from a version that is no longer the last one, it raises."""
    if is_path(target):
        versions.replace(df, target, partition_by, made_from)
    else:
        _save(df, target, "overwrite", partition_by)


# --- observations -----------------------------------------------------------------------

STORED_OBSERVATION = T.StructType(OBSERVATION.fields + [T.StructField(MONTH, T.StringType())])


def stored_observations(spark: SparkSession, target: str) -> DataFrame:
    """The observation table with its month folder column."""
    return read_table(spark, target, STORED_OBSERVATION)


def read_observations(spark: SparkSession, target: str) -> DataFrame:
    return stored_observations(spark, target).select(*OBSERVATION.fieldNames())


def by_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, F.date_format("datetime", MONTH_FORMAT))


def append_observations(df: DataFrame, target: str) -> None:
    """Append rows that are known to be new."""
    append(_spread_by_month(df), target, [MONTH], STATION_FILTER)


def _spread_by_month(df: DataFrame) -> DataFrame:
    """Observation columns and the month, laid out so that each task writes few folders.

    The layout is a rebalancing hint: adaptive execution splits a month that holds many rows
    over several tasks and joins small ones. Each file is sorted by station and time, so a read of
    few stations skips pages by their bounds, and whole files by the Bloom filter on the station.
    """
    return (
        by_month(df.select(*OBSERVATION.fieldNames())).hint("rebalance", MONTH).sortWithinPartitions(MONTH, *KEY)
    )


def insert_observations_if_absent(
    new: DataFrame, target: str, order: Sequence[str] = ()
) -> int:
    """Append the rows whose (station, datetime) is not stored; returns how many.

    Of several rows for one key the first in `order` counts, then in the order of the remaining
    columns. Rows without a key are left out. Only the months the batch touches are searched
    for stored keys. The batch is written down once, as it must not change between reading the
    stored keys and appending to them.
    """
    spark = new.sparkSession
    columns = OBSERVATION.fieldNames()
    keyed = new.where(F.col("station_id").isNotNull() & F.col("datetime").isNotNull())
    batch = first_row(keyed.select(*dict.fromkeys([*columns, *order])), list(order))
    batch = materialize(batch.select(*columns), "batch")
    first, last = batch.agg(F.min("datetime"), F.max("datetime")).first()
    if first is None:
        return 0
    if table_exists(spark, target):
        known = stored_observations(spark, target).where(
            F.col(MONTH).between(first.strftime("%Y%m"), last.strftime("%Y%m"))
            & F.col("datetime").between(instant(first), instant(last))
        )
        few = batch.select("station_id").distinct().limit(NAMED_STATIONS + 1).collect()
        if len(few) <= NAMED_STATIONS:  # a filter the scan can use; the rows that count are the same
            known = known.where(F.col("station_id").isin([r[0] for r in few]))
        batch = absent_rows(batch, known, KEY)
    n = batch.count()  # reads the keys only
    if n:
        append_observations(batch, target)
    return n


# --- stations ---------------------------------------------------------------------------


def merge_stations(stored: DataFrame, incoming: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Stored stations updated by the incoming ones.

    A new station gets `created_at`; a changed one keeps it and gets `updated_at`. Both
    sides are combined by one grouping on the id, so neither is broadcast.
    """
    now = instant(as_of)
    values = ["latitude", "longitude"]
    audit = ["created_at", "updated_at"]
    old = stored.select(
        "station_id",
        F.struct(*values, *audit).alias("old"),
        F.lit(None).cast("struct<latitude:double,longitude:double>").alias("new"),
    )
    new = incoming.select(
        "station_id",
        F.lit(None).cast(old.schema["old"].dataType).alias("old"),
        F.struct(*values).alias("new"),
    )
    both = old.unionByName(new).groupBy("station_id").agg(F.max("old").alias("o"), F.max("new").alias("n"))
    added, given = F.col("o").isNull(), F.col("n").isNotNull()
    changed = given & ~F.struct("o.latitude", "o.longitude").eqNullSafe(F.struct("n.latitude", "n.longitude"))
    return both.select(
        "station_id",
        *[F.when(given, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in values],
        F.when(added, now).otherwise(F.col("o.created_at")).alias("created_at"),
        F.when(added | changed, now).otherwise(F.col("o.updated_at")).alias("updated_at"),
    )


def upsert_stations(incoming: DataFrame, target: str, as_of: dt.datetime) -> None:
    """Insert or update stations by id; all of the batch or none.

    A write that another one overtakes raises and leaves the other's rows.
    """
    spark = incoming.sparkSession
    before = versions.version(spark, target) if is_path(target) else None
    if table_exists(spark, target):
        stored = read_table(spark, target, STATION_TABLE)
    else:
        stored = spark.createDataFrame([], STATION_TABLE)
    merged = merge_stations(stored, incoming, as_of)
    replace(merged if is_path(target) else materialize(merged, "stations"), target, made_from=before)


def insert_stations_if_absent(incoming: DataFrame, target: str, as_of: dt.datetime) -> None:
    """Add the stations whose id is not stored; stored ones stay as they are.

    Of several rows for one id the first by latitude, then longitude, counts; rows without id are left out.
    """
    spark = incoming.sparkSession
    now = instant(as_of)
    rows = incoming.where(F.col("station_id").isNotNull()).select("station_id", "latitude", "longitude")
    rows = first_row(rows, [], ["station_id"]).withColumns({"created_at": now, "updated_at": now})
    if table_exists(spark, target):
        rows = absent_rows(rows, read_table(spark, target, STATION_TABLE), ["station_id"])
    append(materialize(rows, "stations"), target)


# --- asset tables -----------------------------------------------------------------------


def asset_table(asset: str) -> str:
    return f"wave_data_{asset}"


def _asset_target(base: str, asset: str) -> str:
    return f"{base.rstrip('/')}/{asset_table(asset)}"


def write_asset(
    df: DataFrame,
    asset: str,
    base: str,
    as_of: dt.datetime,
    partition_key: str | None = None,
    asset_partition: str | None = None,
) -> dict[str, object]:
    """Store an asset with its bookkeeping columns; returns what was written.

    With a `partition_key` that partition is rewritten and the others stay; without one the
    rows are appended under the month of `as_of`. Declared column types are applied.
    """
    rows = with_bookkeeping(df, as_of, asset_partition or partition_key, partition_key)
    if asset in ASSET_SCHEMAS:
        declared = [f for f in ASSET_SCHEMAS[asset].fields if f.name in rows.columns]
        rows = rows.to(T.StructType([T.StructField(f.name, f.dataType) for f in declared]))
    target = _asset_target(base, asset)
    key = partition_key or partition_key_of(as_of)
    written = Observation("written")
    counted = rows.observe(written, F.count(F.lit(1)).alias("row_count"))
    folder = versions.store(counted, target, [PARTITION_KEY])
    n = written.get["row_count"]

    def change(there: versions.Folders) -> versions.Folders:
        kept = [f for f in there if partition_key is None or f[0] != key]
        return [*kept, (key, folder)] if n else kept

    versions.commit(df.sparkSession, target, change, rows.schema)
    return {"table": asset_table(asset), "partition": key, "row_count": n, "columns": rows.columns}


def load_asset(
    spark: SparkSession,
    asset: str,
    base: str,
    partition_key: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """An asset, or one of its partitions, without the bookkeeping columns."""
    target = _asset_target(base, asset)
    schema = schema or ASSET_SCHEMAS.get(asset)
    wanted = None if partition_key is None else lambda part: part == partition_key
    rows = versions.read(spark, target, schema, wanted)
    if partition_key is not None:
        rows = rows.where(F.col(PARTITION_KEY) == partition_key)
    return rows.drop(*BOOKKEEPING)
