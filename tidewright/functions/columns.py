"""Column expressions: date parts, null cleaning, decoding, colours."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.schemas import ASSET_PARTITION, PARTITION_KEY, UPDATED_AT

# Value that marks a missing grid point (fixed value).
GRID_MISSING = 9999.0

# Marker colour of each consistency label, and of anything else (fixed values).
LABEL_COLOURS = {
    "High Consistency": "blue",
    "Medium Consistency": "orange",
    "Low Consistency": "red",
    "Unknown, not enough data": "gray",
}
OTHER_LABEL_COLOUR = "black"

# Lower bound of each score band and its colour, highest first (fixed values).
SCORE_BANDS = [(0.8, "#ff0000"), (0.6, "#ffff00"), (0.4, "#00ff00"), (0.2, "#00ffff")]
LOWEST_BAND_COLOUR = "#4169e1"

Col = Column | str


def _col(c: Col) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc(at: dt.datetime) -> dt.datetime:
    """Without a zone; an instant with one is taken to UTC first."""
    return at if at.tzinfo is None else at.astimezone(dt.timezone.utc).replace(tzinfo=None)


def instant(at: dt.datetime) -> Column:
    """A literal timestamp without a time zone, whatever the session zone is."""
    return F.lit(utc(at).isoformat(sep=" ")).cast("timestamp_ntz")


def month_start(ts: Col) -> Column:
    """First instant of the month, without a time zone whatever the session zone is."""
    return F.trunc(_col(ts).cast("date"), "MM").cast("timestamp_ntz")


def cycle_floor(ts: Col, hours: int = 6) -> Column:
    """Start of the model cycle that contains `ts` (00, 06, 12 or 18 h)."""
    ts = _col(ts)
    cycle = (F.floor(F.hour(ts) / hours) * hours).cast("int")
    return ts.cast("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), cycle)


def null_if_nan(c: Col) -> Column:
    return F.nullif(_col(c), F.lit(float("nan")))


def null_nan(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Turn NaN into NULL in the given columns, or in every float column."""
    names = columns or [f for f, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: null_if_nan(c) for c in names})


def null_if_missing(value: Col, sentinel: float = GRID_MISSING) -> Column:
    return F.nullif(null_if_nan(value), F.lit(sentinel))


def decode_scaled(value: Col, scale_factor: Col | None = None, fill: Col | None = None) -> Column:
    """Packed value to physical value: the fill value is NULL, no scale factor means 1."""
    raw = _col(value)
    if fill is not None:
        raw = F.when(raw.eqNullSafe(_col(fill)), F.lit(None)).otherwise(raw)
    if scale_factor is not None:
        raw = raw * F.coalesce(_col(scale_factor), F.lit(1.0))
    return raw


def is_finite(c: Col) -> Column:
    """Not NULL, not NaN, not infinite (Spark orders NaN above infinity)."""
    c = _col(c)
    return c.isNotNull() & (F.abs(c) < F.lit(float("inf")))


def units_or_unknown(units: Col) -> Column:
    return F.coalesce(_col(units), F.lit("unknown"))


def label_colour(label: Col) -> Column:
    pairs = [F.lit(x) for pair in LABEL_COLOURS.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[_col(label)], F.lit(OTHER_LABEL_COLOUR))


def score_colour(score: Col) -> Column:
    """Colour band of a score; NULL and NaN fall to the lowest band."""
    score = null_if_nan(score)
    bands = F.when(score >= SCORE_BANDS[0][0], SCORE_BANDS[0][1])
    for bound, colour in SCORE_BANDS[1:]:
        bands = bands.when(score >= bound, colour)
    return bands.otherwise(LOWEST_BAND_COLOUR)


def two_decimals(c: Col) -> Column:
    return F.format_string("%.2f", _col(c))


def month_text(ts: Col) -> Column:
    return F.date_format(_col(ts), "yyyy-MM")


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def partition_key_of(as_of: dt.datetime) -> str:
    """Month key `yyyyMM` under which a run is stored."""
    return utc(as_of).strftime("%Y%m")


def with_bookkeeping(
    df: DataFrame, as_of: dt.datetime, asset_partition: str | None = None, partition_key: str | None = None
) -> DataFrame:
    return df.withColumns(
        {
            UPDATED_AT: instant(as_of),
            ASSET_PARTITION: F.lit(asset_partition).cast("string"),
            PARTITION_KEY: F.lit(partition_key or partition_key_of(as_of)),
        }
    )
