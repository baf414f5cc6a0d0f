from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidewright.session import build_session  # noqa: E402

OBS = (
    "station_id string, datetime timestamp_ntz, latitude double, longitude double, "
    "wave_height double, dominant_period double, average_period double, mean_wave_direction double"
)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tidewright-tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": 4,
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": 10000,
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows(df, *order):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
