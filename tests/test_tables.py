"""Sinks: idempotence, upsert, partition rewrite, reload, incremental ingest."""

from __future__ import annotations

import pytest
from conftest import OBS, rows, ts
from pyspark.sql import functions as F

from tidewright.operators.merge import first_non_null
from tidewright.plans import jobs
from tidewright.schemas import OBSERVATION, STATION_TABLE
from tidewright.sinks import tables
from tidewright.sources import buoy_text
from tidewright.sources.buoy_text import ORDER, scan_buoy_files
from tidewright.streaming import ingest

DAY1, DAY2 = ts("2024-12-15"), ts("2024-12-16")


def obs(spark, *data):
    full = [(s, t, 1.0, 2.0, h, None, None, None) for s, t, h in data]
    return spark.createDataFrame(full, OBS)


def heights(df):
    return rows(df.select("station_id", "datetime", "wave_height"))


def test_a_key_comes_once_per_batch(spark, tmp_path):
    target = str(tmp_path / "obs")
    twice = obs(spark, ("a", DAY1, 2.0), ("a", DAY1, 1.0), ("b", None, 1.0), (None, DAY1, 1.0))
    assert tables.insert_observations_if_absent(twice, target) == 1
    assert heights(tables.read_observations(spark, target)) == [("a", DAY1, 1.0)]
    places = spark.createDataFrame([("s", 2.0, 1.0), ("s", 1.0, 5.0), (None, 0.0, 0.0)], "station_id string, latitude double, longitude double")
    for _ in range(2):
        tables.insert_stations_if_absent(places, str(tmp_path / "st"), DAY1)
    stored = tables.read_table(spark, str(tmp_path / "st"), STATION_TABLE)
    assert rows(stored.select("station_id", "latitude")) == [("s", 1.0)]


def test_insert_if_absent_is_idempotent(spark, tmp_path):
    target = str(tmp_path / "obs")
    first = obs(spark, ("a", DAY1, 1.0), ("b", ts("2024-11-30 23:00"), 2.0))
    assert tables.insert_observations_if_absent(first, target) == 2
    assert tables.insert_observations_if_absent(first, target) == 0
    overlap = obs(spark, ("a", DAY1, 9.0), ("a", DAY2, 3.0))
    assert tables.insert_observations_if_absent(overlap, target) == 1
    assert heights(tables.read_observations(spark, target)) == [
        ("a", DAY1, 1.0), ("a", DAY2, 3.0), ("b", ts("2024-11-30 23:00"), 2.0),
    ]
    assert tables.insert_observations_if_absent(first.where("false"), target) == 0


def test_first_of_several_rows_for_one_key(spark, tmp_path):
    batch = obs(spark, ("a", DAY1, 5.0), ("a", DAY1, 4.0)).withColumn("n", -F.col("wave_height"))
    assert tables.insert_observations_if_absent(batch, str(tmp_path / "o"), ["n"]) == 1
    assert heights(tables.read_observations(spark, str(tmp_path / "o"))) == [("a", DAY1, 5.0)]


def test_stored_keys_are_read_from_the_touched_months_only(spark, tmp_path):
    target = str(tmp_path / "obs")
    tables.insert_observations_if_absent(obs(spark, ("a", DAY1, 1.0), ("a", ts("2023-01-01"), 1.0)), target)
    stored = tables.stored_observations(spark, target).where(F.col(tables.MONTH).between("202412", "202412"))
    assert len(stored.inputFiles()) == 2  # the listing holds both months; the scan prunes
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_month" in plan


def test_station_upsert_keeps_created_and_moves_updated(spark, tmp_path):
    target = str(tmp_path / "st")
    schema = "station_id string, latitude double, longitude double"
    tables.upsert_stations(spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 4.0)], schema), target, DAY1)
    tables.upsert_stations(spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.5, 4.0), ("c", 5.0, 6.0)], schema), target, DAY2)
    got = rows(tables.read_table(spark, target, STATION_TABLE))
    assert got == [
        ("a", 1.0, 2.0, DAY1, DAY1),
        ("b", 3.5, 4.0, DAY1, DAY2),
        ("c", 5.0, 6.0, DAY2, DAY2),
    ]
    tables.insert_stations_if_absent(spark.createDataFrame([("a", 0.0, 0.0), ("d", 7.0, 8.0)], schema), target, DAY2)
    assert rows(tables.read_table(spark, target, STATION_TABLE).select("station_id", "latitude")) == [
        ("a", 1.0), ("b", 3.5), ("c", 5.0), ("d", 7.0),
    ]


def test_asset_partition_is_rewritten_alone(spark, tmp_path):
    base = str(tmp_path)
    for _ in range(2):
        done = tables.write_asset(obs(spark, ("a", DAY1, 1.0)), "raw_buoy_data", base, DAY1, "202412")
    tables.write_asset(obs(spark, ("a", DAY2, 2.0)), "raw_buoy_data", base, DAY2, "202501")
    assert done == {
        "table": "wave_data_raw_buoy_data",
        "partition": "202412",
        "row_count": 1,
        "columns": [*OBSERVATION.fieldNames(), "_updated_at", "_asset_partition", "_partition_key"],
    }
    assert heights(tables.load_asset(spark, "raw_buoy_data", base)) == [("a", DAY1, 1.0), ("a", DAY2, 2.0)]
    one = tables.load_asset(spark, "raw_buoy_data", base, "202412")
    assert one.columns == OBSERVATION.fieldNames() and heights(one) == [("a", DAY1, 1.0)]
    assert "PartitionFilters: [isnotnull(_partition_key" in one._jdf.queryExecution().executedPlan().toString()
    tables.write_asset(obs(spark, ("a", DAY1, 1.0)).where("false"), "raw_buoy_data", base, DAY1, "202412")
    assert heights(tables.load_asset(spark, "raw_buoy_data", base)) == [("a", DAY2, 2.0)]


def test_unpartitioned_asset_appends(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "col1 int, col2 string")
    tables.write_asset(df, "plain", str(tmp_path), DAY1)
    assert rows(tables.load_asset(spark, "plain", str(tmp_path))) == [(1, "a"), (2, "b")]
    tables.write_asset(df, "plain", str(tmp_path), DAY1)
    assert tables.load_asset(spark, "plain", str(tmp_path), "202412").count() == 4


def test_declared_types_are_applied(spark, tmp_path):
    df = obs(spark, ("a", DAY1, 1.0)).withColumn("wave_height", F.lit(2))
    tables.write_asset(df, "raw_buoy_data", str(tmp_path), DAY1, "202412")
    assert dict(tables.load_asset(spark, "raw_buoy_data", str(tmp_path)).dtypes)["wave_height"] == "double"


def test_create_and_find_tables(spark, tmp_path):
    name = "raw_data_test.stations"
    for _ in range(2):
        tables.create_table(spark, name, STATION_TABLE, location=str(tmp_path / "t"))
    try:
        assert tables.table_exists(spark, name) and not tables.table_exists(spark, "raw_data_test.nothing")
        assert not tables.table_exists(spark, str(tmp_path / "nothing"))
        assert spark.table(name).columns == STATION_TABLE.fieldNames()
    finally:
        spark.sql("DROP TABLE raw_data_test.stations")
        spark.sql("DROP DATABASE raw_data_test")


def test_replace(spark, tmp_path):
    target = str(tmp_path / "r")
    for n in (5, 3):
        tables.replace(spark.range(n), target)
    assert tables.read_table(spark, target).count() == 3


# --- incremental ingest -------------------------------------------------------------------

HEAD = "#YY MM DD hh mm\n#yr mo dy hr mn\n"


def txt(*lines):
    return HEAD + "".join(f"2024 12 {d} {h} 00 300 5 7 {v} {p} 6.5 280 1013 18 16 10 MM -0.5 MM\n" for d, h, v, p in lines)


def spec(*lines):
    return HEAD + "".join(f"2024 12 {d} {h} 00 {v} 1.0 8.0 0.5 4.0 SW WSW STEEP 6.1 225\n" for d, h, v in lines)


def run_ingest(spark, tmp_path, **options):
    paths = {k: str(tmp_path / k) for k in ("landing", "log", "offsets")}
    ingest.ingest_landing(spark, paths["landing"], paths["log"], paths["offsets"], **options).awaitTermination()
    return paths["log"]


def test_stream_equals_batch(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1.txt").write_text(txt((1, 0, "MM", 9), (1, 1, 2.0, "MM"), (1, 1, 3.0, 7)))
    (landing / "1.spec").write_text(spec((1, 0, 1.5)))
    (landing / "2.txt").write_text(txt((2, 0, 4.0, 8)))
    log = run_ingest(spark, tmp_path)
    streamed = ingest.merged_observations(spark, log)
    batch = first_non_null(scan_buoy_files(spark, str(landing)).where("valid"), ORDER)
    assert rows(streamed.select(*sorted(batch.columns))) == rows(batch.select(*sorted(batch.columns)))


def test_stream_reads_each_file_once_and_stored_values_win(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1.txt").write_text(txt((1, 0, 1.0, "MM"), (1, 1, 2.0, 8)))
    log = run_ingest(spark, tmp_path)
    run_ingest(spark, tmp_path)
    again = tmp_path / "landing" / "later"
    again.mkdir()
    # the same rows again, one with another value and the missing period, and a new row
    (again / "1.txt").write_text(txt((2, 0, 5.0, 9), (1, 0, 7.0, 6), (1, 1, 2.0, 8)))
    run_ingest(spark, tmp_path)
    got = rows(ingest.merged_observations(spark, log).select("datetime", "wave_height", "dominant_period"))
    assert got == [
        (ts("2024-12-01 00:00"), 1.0, 6.0),
        (ts("2024-12-01 01:00"), 2.0, 8.0),
        (ts("2024-12-02 00:00"), 5.0, 9.0),
    ]
    # the row that added nothing was not stored again
    assert ingest.read_log(spark, log).count() == 4


def test_stream_in_many_batches_keeps_every_row(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    for day in range(1, 7):
        (landing / f"s{day}.txt").write_text(txt(*[(day, h, h + 0.5, 8) for h in range(5)]))
    log = run_ingest(spark, tmp_path, max_files=2)
    assert ingest.merged_observations(spark, log).count() == 30
    assert ingest.read_log(spark, log).select("batch_id").distinct().count() == 3
    want = rows(ingest.merged_observations(spark, log))
    for _ in range(2):  # the second time changes nothing
        ingest.compact(spark, log)
        assert ingest.read_log(spark, log).count() == 30
        assert rows(ingest.merged_observations(spark, log)) == want
    (landing / "s1.spec").write_text(spec((1, 0, 99.0), (9, 0, 1.5)))
    run_ingest(spark, tmp_path)
    ingest.compact(spark, log)
    got = {r["datetime"]: r["wave_height"] for r in ingest.merged_observations(spark, log).where("station_id = 's1'").collect()}
    assert got[ts("2024-12-01 00:00")] == 0.5 and got[ts("2024-12-09 00:00")] == 1.5 and len(got) == 6


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    (tmp_path / "1.txt").write_text(txt((1, 0, 1.0, "MM"), (1, 1, 2.0, 8)))
    log = str(tmp_path / "log")
    lines = stream_lines(spark, tmp_path)
    for batch_id in (0, 0, 1, 0):
        ingest.store_batch(lines, batch_id, log)
    assert ingest.read_log(spark, log).count() == 2
    assert ingest.merged_observations(spark, log).count() == 2


def stream_lines(spark, path):
    """The columns of the stream for files that are already there."""
    return buoy_text._lines(spark.read, str(path))


# --- jobs -----------------------------------------------------------------------------------


def test_daily_job_twice_is_daily_job_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1.txt").write_text(txt((14, 0, 1.0, 8), (15, 9, 2.0, 8), (99, 0, 1.0, 8)))
    (landing / "9.txt").write_text(txt((15, 9, 2.0, 8)))
    st, ob, assets = (str(tmp_path / p) for p in ("st", "ob", "assets"))
    known = spark.createDataFrame([("1", 35.0, -120.5)], "station_id string, latitude double, longitude double")
    tables.upsert_stations(known, st, DAY1)
    args = (spark, str(landing), st, ob, assets, ts("2024-12-15 12:00"), "202412")
    first, second = jobs.daily_buoy_asset(*args), jobs.daily_buoy_asset(*args)
    assert (first["inserted"], second["inserted"]) == (2, 0)
    assert (second["record_count"], second["stations_count"], second["missing_data_pct"]) == (1, 1, 0.0)
    assert (second["stations_processed"], second["rows_failed"]) == (1, 1)
    assert heights(tables.load_asset(spark, "raw_buoy_data", assets)) == [("1", ts("2024-12-15 09:00"), 2.0)]


def test_consistency_and_cluster_jobs(spark, tmp_path):
    data = [
        (s, ts(f"2024-{m:02d}-{d:02d}"), 1.0, 2.0, float(d * m + i), float(d % 5), float(d % 3 + m), float(d * i))
        for i, s in enumerate("abc") for m in (1, 2, 3) for d in range(1, 11)
    ]
    target = str(tmp_path / "ob")
    tables.append_observations(spark.createDataFrame(data, OBS), target)
    for _ in range(2):
        jobs.consistency_labelling(spark, target, str(tmp_path / "trends"))
    trends = tables.read_table(spark, str(tmp_path / "trends"))
    assert trends.count() == 9
    assert {r[0].split()[0] for r in trends.select("consistency_label").collect()} == {"High", "Medium", "Low"}
    histogram = jobs.cluster_job(spark, target, str(tmp_path / "clusters"), k=3)
    assert histogram.agg(F.sum("n")).first()[0] == 90


def test_station_refresh_and_coverage(spark, tmp_path):
    first, second, target = tmp_path / "1.xml", tmp_path / "2.xml", str(tmp_path / "st")
    first.write_text('<stations><station id="a" lat="1" lon="2" met="y"/><station id="b" lat="3" lon="4" met="n"/></stations>')
    second.write_text('<stations><station id="a" lat="1.5" lon="2" met="y"/><station id="c" lat="5" lon="6"/></stations>')
    jobs.station_refresh(spark, str(first), target, DAY1)
    jobs.station_refresh(spark, str(second), target, DAY2)
    assert rows(tables.read_table(spark, target, STATION_TABLE)) == [("a", 1.5, 2.0, DAY1, DAY2)]
    assert rows(jobs.coverage_job(spark, str(first), target)) == [
        ("a", 1.5, 2.0, "with_met"),
        ("b", 3.0, 4.0, "without_met"),
    ]


@pytest.mark.parametrize("name", ["a/b", "x"])
def test_targets(name):
    assert tables.is_path(name) == ("/" in name)
