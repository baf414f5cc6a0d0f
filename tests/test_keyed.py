"""Ingest through keyed state against the log."""

from __future__ import annotations

from conftest import rows

from tidewright.streaming import ingest, keyed

HEAD = "#YY  MM DD hh mm WVHT  DPD   APD MWD\n#yr  mo dy hr mn m sec sec degT\n"


def spec(*lines):
    """Station file in the layout of spectral summaries: time, then height and the rest."""
    return HEAD + "".join(f"{t} {h} 1.0 8.0 0.5 5.0 W W AVERAGE 6.1 270\n" for t, h in lines)


def land(folder, station, text, ending="spec"):
    (folder / f"{station}.{ending}").write_text(text)


def paths(tmp_path):
    (tmp_path / "landing").mkdir()
    return tmp_path / "landing", *(f"{tmp_path}/{p}" for p in ("final", "state", "log", "offsets"))


def ran(spark, landing, target, state, **options):
    run = keyed.ingest_keyed(spark, str(landing), target, state, delay="1 day", **options)
    run.awaitTermination()
    return keyed.late_keys(spark, run)


def test_as_the_log_for_rows_in_time(spark, tmp_path):
    """What is final equals the log; what is not yet is kept in the state over a restart; late keys are counted."""
    landing, target, state, log, offsets = paths(tmp_path)
    land(landing, "a1", spec(("2024 03 01 00 00", 1.0), ("2024 03 02 00 00", 1.5), ("2024 03 02 00 00", 9.0), ("2024 13 01 00 00", 7.0)))
    land(landing, "b1", spec(("2024 03 01 06 00", 2.0), ("2024 03 03 12 00", 2.5)))
    assert ran(spark, landing, target, state) == 0
    assert {r[1].isoformat() for r in rows(keyed.final_observations(spark, target))} == {"2024-03-01T00:00:00", "2024-03-02T00:00:00", "2024-03-01T06:00:00"}
    assert ran(spark, landing, target, state) == 0  # nothing new
    assert keyed.final_observations(spark, target).count() == 3

    # the watermark stands at 03-02 12:00: this is in time, and pushes it on
    land(landing, "c1", spec(("2024 03 03 00 00", 3.0), ("2024 03 09 00 00", 3.5)))
    assert ran(spark, landing, target, state) == 0
    ingest.ingest_landing(spark, str(landing), log, offsets).awaitTermination()
    in_time = ingest.merged_observations(spark, log).where("datetime <= timestamp_ntz'2024-03-08'")
    final = keyed.final_observations(spark, target)
    assert rows(final) == rows(in_time.select(*final.columns)) and final.count() == 5

    # two late keys, one of them twice, one stored already; the last row alone is new
    land(landing, "d1", spec(("2024 03 01 00 00", 8.0), ("2024 03 01 00 00", 8.5), ("2024 03 08 12 00", 4.0), ("2024 03 20 00 00", 4.5)))
    land(landing, "a2", spec(("2024 03 01 00 00", 8.0)))
    assert ran(spark, landing, target, state) == 2
    assert keyed.final_observations(spark, target).count() == 7


def test_many_batches_give_what_one_gives(spark, tmp_path):
    landing, target, state, log, offsets = paths(tmp_path)
    for n in range(5):  # all within the delay, whatever the order of the files
        land(landing, f"s{n}", spec(*((f"2024 04 01 {hour}{n} 00", hour + n) for hour in (0, 1))))
    land(landing, "t", spec(("2024 04 01 00 00", 1.0)))
    assert ran(spark, landing, target, state, max_files=2) == 0
    land(landing, "u", spec(("2024 05 01 00 00", 1.0)))
    assert ran(spark, landing, target, state, max_files=2) == 0
    final = keyed.final_observations(spark, target)
    assert final.count() == 11 == final.select("station_id", "datetime").distinct().count()


def test_no_valid_row(spark, tmp_path):
    landing, target, state, *_ = paths(tmp_path)
    land(landing, "a", HEAD)
    assert ran(spark, landing, target, state) == 0
    assert keyed.final_observations(spark, target).count() == 0
