"""All-or-nothing writes: killed writers, readers beside writers, two writers, compaction beside an ingest."""

from __future__ import annotations

import pytest
from conftest import ts
from pyspark.sql import functions as F

from tidewright.schemas import STATION_TABLE
from tidewright.sinks import tables, versions
from tidewright.streaming import ingest

DAY1, DAY2 = ts("2024-12-15"), ts("2024-12-16")


def ids(df):
    return sorted(r[0] for r in df.collect())


def broken(spark, n=4):
    """Rows of which the last cannot be made."""
    return spark.range(n).repartition(2).select(F.when(F.col("id") < n - 1, F.col("id")).otherwise(F.raise_error(F.lit("killed")).cast("long")).alias("id"))


def test_a_killed_write_leaves_the_table(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    with pytest.raises(Exception, match="killed"):
        tables.replace(broken(spark), target)
    assert not tables.table_exists(spark, target)
    tables.replace(spark.range(3), target)
    for write in (tables.replace, tables.append):
        with pytest.raises(Exception, match="killed"):
            write(broken(spark), target)
        assert ids(tables.read_table(spark, target)) == [0, 1, 2]
    # killed between the data and the commit
    monkeypatch.setattr(versions, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        tables.replace(spark.range(9), target)
    monkeypatch.undo()
    assert ids(tables.read_table(spark, target)) == [0, 1, 2] and versions.version(spark, target) == 1


def test_a_reader_keeps_what_it_began_with(spark, tmp_path):
    target = str(tmp_path / "t")
    tables.replace(spark.range(3), target)
    before = tables.read_table(spark, target)
    tables.replace(before.where("id > 0"), target)  # reads what it replaces
    tables.append(spark.range(10, 12), target)
    assert ids(before) == [0, 1, 2] and ids(tables.read_table(spark, target)) == [1, 2, 10, 11]
    assert versions.version(spark, target) == 3


def test_partitions_and_empty_tables(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = spark.range(4).select("id", (F.col("id") % 2).cast("string").alias("p"))
    for part in ("0", "1"):
        versions.rewrite(rows.where(F.col("p") == part), target, part, ["p"])
    versions.rewrite(rows.where("id = 3").withColumn("id", F.lit(30).cast("long")), target, "1", ["p"])
    assert ids(versions.read(spark, target)) == [0, 2, 30]
    assert ids(versions.read(spark, target, part=lambda p: p == "0")) == [0, 2]
    for part in ("0", "1"):
        versions.drop_part(spark, target, part, rows.schema)
    empty = tables.read_table(spark, target)
    assert empty.count() == 0 and empty.columns == ["id", "p"]
    with pytest.raises(FileNotFoundError):
        versions.read(spark, str(tmp_path / "none"))


def test_two_writers(spark, tmp_path, monkeypatch):
    """An append goes on top of what came first; an upsert made from an older version raises."""
    target = str(tmp_path / "t")
    tables.replace(spark.range(1), target)
    real, others = versions.latest, [True]

    def overtaken(session, where):
        found = real(session, where)
        if others and where == target:
            others.clear()
            versions.append(session.range(100, 101), target)
        return found

    monkeypatch.setattr(versions, "latest", overtaken)
    tables.append(spark.range(7, 8), target)
    monkeypatch.undo()
    assert ids(tables.read_table(spark, target)) == [0, 7, 100]
    with pytest.raises(versions.ConflictError):
        versions.replace(spark.range(2), target, made_from=1)
    assert ids(tables.read_table(spark, target)) == [0, 7, 100]


def test_an_upsert_that_is_overtaken_raises(spark, tmp_path, monkeypatch):
    target, schema = str(tmp_path / "st"), "station_id string, latitude double, longitude double"
    tables.upsert_stations(spark.createDataFrame([("a", 1.0, 2.0)], schema), target, DAY1)
    real = tables.merge_stations

    def slow(*args):
        monkeypatch.undo()
        tables.upsert_stations(spark.createDataFrame([("b", 1.0, 2.0)], schema), target, DAY1)
        return real(*args)

    monkeypatch.setattr(tables, "merge_stations", slow)
    with pytest.raises(versions.ConflictError):
        tables.upsert_stations(spark.createDataFrame([("c", 1.0, 2.0)], schema), target, DAY2)
    assert ids(tables.read_table(spark, target, STATION_TABLE).select("station_id")) == ["a", "b"]


def test_compaction_beside_an_ingest(spark, tmp_path, monkeypatch):
    """A batch that arrives while the state is written stays; a repeated old batch changes nothing."""
    log = str(tmp_path / "log")
    row = "struct<station_id:string,datetime:timestamp_ntz>"
    made = spark.createDataFrame([("a", DAY1), ("b", DAY1), ("c", DAY2)], row[7:-1].replace(":", " "))

    def batch(ids_):
        rows = made.where(F.col("station_id").isin(ids_))
        return rows.select("*", *[F.lit(float(len(ids_))).alias(c) for c in ingest.VALUES])

    monkeypatch.setattr(ingest, "batch_observations", lambda lines: lines)
    ingest.store_batch(batch(["a"]), 0, log)
    ingest.store_batch(batch(["a", "b"]), 1, log)
    real = versions.store

    def store(df, *args):
        folder = real(df, *args)
        monkeypatch.setattr(versions, "store", real)
        ingest.store_batch(batch(["c"]), 2, log)
        return folder

    monkeypatch.setattr(versions, "store", store)
    ingest.compact(spark, log)
    assert ids(ingest.read_log(spark, log).select("batch_id")) == [-1, -1, 2]
    want = sorted(ingest.merged_observations(spark, log).collect(), key=str)
    ingest.store_batch(batch(["a", "b"]), 1, log)
    for _ in range(2):
        ingest.compact(spark, log)
    assert sorted(ingest.merged_observations(spark, log).collect(), key=str) == want and len(want) == 3
    assert [f["part"] for f in versions.latest(spark, log)["folders"]] == ["upto-2"]


def test_plain_folders_are_read_and_replaced(spark, tmp_path):
    target = str(tmp_path / "t")
    spark.range(3).write.parquet(target)
    assert tables.table_exists(spark, target) and ids(tables.read_table(spark, target)) == [0, 1, 2]
    tables.append(spark.range(7, 8), target)
    tables.replace(tables.read_table(spark, target).where("id in (1, 7)"), target)
    assert ids(tables.read_table(spark, target)) == [1, 7]
