"""Canonical schemas: one column vocabulary for every source, operator and table."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = ["station_id", "datetime"]
MEASURES = ["wave_height", "dominant_period", "average_period", "mean_wave_direction"]
POSITION = ["latitude", "longitude"]

# Short measure names used by the consistency and forecast columns (fixed values).
SHORT_NAMES = {
    "wave_height": "wvht",
    "dominant_period": "dpd",
    "average_period": "apd",
    "mean_wave_direction": "mwd",
}
STD_COLUMNS = [f"{SHORT_NAMES[m]}_monthly_std" for m in MEASURES]

_STRING, _DOUBLE, _NTZ = T.StringType(), T.DoubleType(), T.TimestampNTZType()

OBSERVATION = T.StructType(
    [T.StructField("station_id", _STRING, False), T.StructField("datetime", _NTZ, False)]
    + [T.StructField(c, _DOUBLE) for c in POSITION + MEASURES]
)

STATION = T.StructType(
    [
        T.StructField("station_id", _STRING, False),
        T.StructField("latitude", _DOUBLE, False),
        T.StructField("longitude", _DOUBLE, False),
    ]
)

# The station table as stored: the API columns plus the audit columns.
STATION_TABLE = T.StructType(
    STATION.fields + [T.StructField("created_at", _NTZ), T.StructField("updated_at", _NTZ)]
)

SPOT = T.StructType(
    [
        T.StructField("name", _STRING),
        T.StructField("country", _STRING),
        T.StructField("lat", _DOUBLE),
        T.StructField("lng", _DOUBLE),
    ]
)

# One gridded field ("message") is identified by these columns.
MESSAGE = ["param", "units", "analysis_ts", "forecast_hours"]

GRID_VALUE = T.StructType(
    [
        T.StructField("param", _STRING),
        T.StructField("units", _STRING),
        T.StructField("analysis_ts", _NTZ),
        T.StructField("forecast_hours", T.IntegerType()),
        T.StructField("grid_idx", T.LongType()),
        T.StructField("lat", _DOUBLE),
        T.StructField("lon", _DOUBLE),
        T.StructField("value", _DOUBLE),
    ]
)

CONSISTENCY = T.StructType(
    [T.StructField("station_id", _STRING), T.StructField("month", _NTZ)]
    + [T.StructField(c, _DOUBLE) for c in STD_COLUMNS + POSITION + ["consistency_score"]]
    + [T.StructField("consistency_label", _STRING)]
)

# The measures of the wide model-sample table, in stored order (fixed values).
SWELL_MEASURES = [
    "wind_speed",
    "wind_direction",
    "u_component_of_wind",
    "v_component_of_wind",
    "sig_height_combined_waves",
    "primary_wave_mean_period",
    "primary_wave_direction",
    "sig_height_wind_waves",
    "sig_height_total_swell",
    "mean_period_wind_waves",
    "mean_period_total_swell",
    "direction_wind_waves",
    "direction_swell_waves",
]

SWELL = T.StructType(
    [
        T.StructField("surf_spot_name", _STRING),
        T.StructField("country", _STRING),
        T.StructField("lat", _DOUBLE),
        T.StructField("lng", _DOUBLE),
    ]
    + [
        f
        for m in SWELL_MEASURES
        for f in (T.StructField(m, _DOUBLE), T.StructField(f"{m}_units", _STRING))
    ]
    + [
        T.StructField("date", T.DateType()),
        T.StructField("time", _STRING),
        T.StructField("forecast_hours", T.IntegerType()),
    ]
)

# Bookkeeping columns of an asset table.
PARTITION_KEY, UPDATED_AT, ASSET_PARTITION = "_partition_key", "_updated_at", "_asset_partition"
BOOKKEEPING = [PARTITION_KEY, UPDATED_AT, ASSET_PARTITION]

# Declared column types of each asset table.
ASSET_SCHEMAS = {
    "raw_buoy_data": T.StructType(
        OBSERVATION.fields
        + [
            T.StructField(UPDATED_AT, _NTZ),
            T.StructField(ASSET_PARTITION, _STRING),
            T.StructField(PARTITION_KEY, _STRING),
        ]
    )
}
