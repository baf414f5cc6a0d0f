"""Date and month checks, read queries, map feeds, catalogue and spot scans."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import OBS, rows, ts

from tidewright.functions import columns as fc
from tidewright.plans import queries
from tidewright.sources import catalogue

NOW = ts("2025-01-15 08:00")


def test_date_range_check():
    check = queries.validate_date_range
    assert check("2024-12-01", "2025-01-01", NOW) == (ts("2024-12-01"), ts("2025-01-01"))
    for start, end in [("2024-13-01", "2024-12-02"), ("2024-12-02", "2024-12-01"), ("2024-12-01", "2025-01-02"), ("2025-01-10", "2025-01-16")]:
        with pytest.raises(ValueError):
            check(start, end, NOW)


def test_month_range_check():
    assert queries.validate_month_range("2024-01", "2024-02") == (ts("2024-01-01"), ts("2024-02-01"))
    for bad in [("2024-1x", "2024-02"), ("2024-03", "2024-02")]:
        with pytest.raises(ValueError):
            queries.validate_month_range(*bad)


def test_wave_data(spark):
    obs = spark.createDataFrame(
        [(s, ts(t), 1.0, 2.0, 1.0, None, None, None) for s in "ab" for t in ("2024-12-01", "2024-12-02", "2024-12-02 00:01")],
        OBS,
    )
    assert queries.wave_data(obs, "2024-12-01", "2024-12-02", now=NOW).count() == 4
    assert queries.wave_data(obs, "2024-12-01", "2024-12-02", "a", now=NOW).count() == 2
    assert queries.wave_data(obs, "2024-12-01", "2024-12-02", "a", now=NOW, end_inclusive_day=True).count() == 3
    with pytest.raises(queries.NoDataFound):
        queries.wave_data(obs, "2024-11-01", "2024-11-02", now=NOW, require=True)
    assert queries.last_day(obs, ts("2024-12-02 00:01")).count() == 4


def test_predicates_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "obs")
    spark.createDataFrame([("a", ts("2024-12-01"), 1.0, 2.0, 1.0, None, None, None)], OBS).write.parquet(path)
    df = queries.wave_data(spark.read.parquet(path), "2024-12-01", "2024-12-02", "a", now=NOW)
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "EqualTo(station_id,a)" in pushed and "GreaterThanOrEqual(datetime" in pushed


def test_stations(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, True)], "station_id string, latitude double, longitude double, met boolean")
    assert rows(queries.stations(df, require=True)) == [("a", 1.0, 2.0)]
    with pytest.raises(queries.NoDataFound):
        queries.stations(df.where("false"), require=True)


def trends(spark):
    scores = [None, float("nan"), float("inf"), float("-inf"), 0.5, 0.8]
    months = ["2024-01-01"] * 5 + ["2024-03-01"]
    return spark.createDataFrame(
        [(str(i), ts(m), 1.0, 2.0, "High Consistency", s) for i, (s, m) in enumerate(zip(scores, months))],
        "station_id string, month timestamp_ntz, latitude double, longitude double, consistency_label string, consistency_score double",
    )


def test_consistency_needs_a_finite_score(spark):
    assert [r["station_id"] for r in queries.consistency(trends(spark), "2024-01", "2024-02").collect()] == ["4"]
    assert queries.consistency(trends(spark), "2024-01", "2024-03").count() == 2
    with pytest.raises(queries.NoDataFound):
        queries.consistency(trends(spark), "2020-01", "2020-02", require=True)


def test_label_colours(spark):
    labels = [*fc.LABEL_COLOURS, "something", None]
    df = spark.createDataFrame([("s", 1.0, 2.0, x) for x in labels], "station_id string, latitude double, longitude double, consistency_label string")
    assert [r["colour"] for r in queries.consistency_map(df).collect()] == ["blue", "orange", "red", "gray", "black", "black"]


def test_score_bands(spark):
    df = spark.createDataFrame([(x,) for x in (0.8, 0.79, 0.6, 0.4, 0.2, 0.19, -3.0, None, 7.0)], "s double")
    got = [r[0] for r in df.select(fc.score_colour("s")).collect()]
    red, yellow, lime, cyan, low = "#ff0000", "#ffff00", "#00ff00", "#00ffff", "#4169e1"
    assert got == [red, yellow, yellow, lime, cyan, low, low, low, red]


def test_popup_texts(spark):
    row = queries.consistency_popups(trends(spark)).where("station_id = '4'").first()
    assert (row["month"], row["score_text"], row["latitude_text"]) == ("2024-01", "0.50", "1.00")


def test_scans_by_name(spark):
    df = spark.createDataFrame([("a", ts("2024-01-02"), 1.0, 2.0, 1.0, 2.0, 3.0, 4.0), ("a", ts("2024-01-01"), 1.0, 2.0, 5.0, 6.0, 7.0, 8.0)], OBS)
    assert queries.short_named(df).columns == ["station_id", "latitude", "longitude", "datetime", "wvht", "dpd", "apd", "mwd"]
    ordered = queries.ordered_series(df)
    assert ordered.columns == ["datetime", "wvht", "dpd", "apd", "mwd"]
    assert [r["wvht"] for r in ordered.collect()] == [5.0, 1.0]


def test_column_helpers(spark):
    df = spark.createDataFrame([(float("nan"), 9999.0, ts("2024-02-29 23:59"))], "a double, b double, t timestamp_ntz")
    row = fc.null_nan(df).select("a", fc.null_if_missing("b"), fc.month_start("t"), fc.month_text("t")).first()
    assert tuple(row) == (None, None, ts("2024-02-01"), "2024-02")
    kept = fc.with_bookkeeping(df.select("a"), dt.datetime(2024, 2, 3), "p").first()
    assert (kept["_partition_key"], kept["_updated_at"], kept["_asset_partition"]) == ("202402", ts("2024-02-03"), "p")


def test_catalogue(spark, tmp_path):
    path = tmp_path / "stations.xml"
    path.write_text(
        '<?xml version="1.0"?>\n<stations created="2024" count="5">\n'
        '<station id="0a1" lat="1.5" lon="-2.5" name="x" met="y"/>\n'
        '<station id="b" lat="3" lon="4" met="n"/>\n'
        '<station id="c" lat="5" lon="6"/>\n'
        '<station id="d" lat="7" lon="8" met="y"/>\n'
        '<station id="d" lat="9" lon="10" met="y"/>\n'
        "</stations>\n"
    )
    found = catalogue.scan_station_catalogue(spark, str(path))
    assert found.count() == 5
    assert rows(catalogue.meteorological_stations(found)) == [("0a1", 1.5, -2.5), ("d", 9.0, 10.0)]


def test_catalogue_with_one_station(spark, tmp_path):
    path = tmp_path / "one.xml"
    path.write_text('<stations><station id="41001" lat="34.7" lon="-72.2" met="y"/></stations>')
    assert rows(catalogue.meteorological_stations(catalogue.scan_station_catalogue(spark, str(path)))) == [("41001", 34.7, -72.2)]


def test_spots(spark, tmp_path):
    path = tmp_path / "spots.json"
    path.write_text('[{"name": "A", "country": "X", "lat": "1.5", "lng": -2},\n {"name": "B", "lat": 3, "lng": 4}]')
    assert rows(catalogue.scan_spots(spark, str(path))) == [("A", "X", 1.5, -2.0), ("B", None, 3.0, 4.0)]


@pytest.mark.parametrize("packed", ["1", "200", str(1 << 20)])
def test_the_last_element_of_the_document_wins(spark, tmp_path, packed):
    """Ids repeat within and across files of very different size; tasks read a few bytes, one file or all."""
    for name, n, shift in (("a.xml", 200, 0.0), ("b.xml", 3, 1.0), ("c.xml", 40, 2.0)):
        body = "".join(f'<station id="s{i % 20}" lat="{shift + i / 1000}" lon="1" met="y"/>\n' for i in range(n))
        (tmp_path / name).write_text(f"<stations>\n{body}</stations>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", packed)
    try:
        found = catalogue.meteorological_stations(catalogue.scan_station_catalogue(spark, str(tmp_path)))
        assert {r.station_id: r.latitude for r in found.collect()} == {f"s{i}": 2.0 + (20 + i) / 1000 for i in range(20)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
