"""Table schemas, unique keys and series dictionaries of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# unbounded NUMERIC in the sources: wide enough that published values are not rounded
DEC = T.DecimalType(34, 16)
DIST = T.DecimalType(9, 3)

# --- fixed values -----------------------------------------------------------
# Local zone of every wall-clock value in the sources.
LOCAL_TZ = "Europe/Tallinn"
# Open end of an SCD2 validity interval.
OPEN_END = "9999-12-31 00:00:00"
# Hydro series name -> silver.hydro column (names as published, NFC).
HYDRO_SERIES = {
    "WL avg": "wl_avg",
    "WL min": "wl_min",
    "WL max": "wl_max",
    "WT avg": "wt_avg",
    "WT min": "wt_min",
    "WT max": "wt_max",
    "Äravool avg": "discharge_avg",
    "Äravool min": "discharge_min",
    "Äravool max": "discharge_max",
}
# Meteo element code -> silver.meteo column.
METEO_ELEMENTS = {
    "PR1H": "precipitation_mm",
    "TA": "temp_avg",
    "TAN1H": "temp_min",
    "TAX1H": "temp_max",
    "RH": "humidity_pct",
    "PA0": "pressure_hpa",
    "WS10M": "wind_speed_ms",
    "WSX1H": "wind_gust_ms",
    "WD10M": "wind_direction_deg",
    "SDUR1H": "sunshine_duration_min",
}
# Allowed run-log states.
RUN_STATUSES = ("running", "success", "error", "triggered", "skipped")
# Number of nearest weather stations kept per gauge.
PROXIMITY_K = 3
# Raw files older than this many days (by file date) are archived.
RETENTION_DAYS = 7
# Days between a run's interval start and the day it loads.
SOURCE_LAG_DAYS = 3
# --------------------------------------------------------------------------

HYDRO_KEY = ["jaam_kood", "timeline_ts_utc", "aegrida_nimi"]
METEO_KEY = ["jaam_kood", "aasta", "kuu", "paev", "tund", "element_kood"]
HYDRO_REQUIRED = ["jaam_kood", "timeline_ts_utc", "aegrida_nimi"]
METEO_REQUIRED = ["jaam_kood", "aasta", "kuu", "paev", "tund", "element_kood"]

HYDRO_RAW = T.StructType(
    [
        T.StructField("jaam_kood", T.IntegerType()),
        T.StructField("jaam_nimi", T.StringType()),
        T.StructField("jaam_taisnimi", T.StringType()),
        T.StructField("valgala_nimi", T.StringType()),
        T.StructField("valgala_suurus_km2", DEC),
        T.StructField("kaugus_suudmest_km", DEC),
        T.StructField("jaam_laiuskraad", DEC),
        T.StructField("jaam_pikkuskraad", DEC),
        T.StructField("veekogu_nimi", T.StringType()),
        T.StructField("timeline_ts_utc", T.TimestampType()),
        T.StructField("timeline_ts_local", T.TimestampType()),
        T.StructField("aegrida_nimi", T.StringType()),
        T.StructField("vaartus", DEC),
    ]
)

METEO_RAW = T.StructType(
    [
        T.StructField("jaam_kood", T.StringType()),
        T.StructField("jaam_nimi", T.StringType()),
        T.StructField("aasta", T.IntegerType()),
        T.StructField("kuu", T.IntegerType()),
        T.StructField("paev", T.IntegerType()),
        T.StructField("tund", T.IntegerType()),
        T.StructField("vaartus", DEC),
        T.StructField("element_kood", T.StringType()),
        T.StructField("element_nimi_eng", T.StringType()),
        T.StructField("element_yhik_eng", T.StringType()),
        T.StructField("avaandmed_ts", T.TimestampType()),
    ]
)

HYDRO_STATION_COLS = [
    "station_code",
    "station_category",
    "station_name",
    "station_fullname",
    "water_body",
    "catchment_name",
    "catchment_size_km2",
    "distance_from_mouth_km",
    "station_altitude_msl_m",
    "latitude",
    "longitude",
    "is_active",
]
HYDRO_STATION_CHECK = [c for c in HYDRO_STATION_COLS if c != "station_code"]
HYDRO_STATION_NULLABLE = [
    "station_fullname",
    "water_body",
    "catchment_name",
    "catchment_size_km2",
    "distance_from_mouth_km",
    "station_altitude_msl_m",
]
HYDRO_STATIONS = T.StructType(
    [
        T.StructField("station_code", T.IntegerType(), False),
        T.StructField("station_category", T.StringType(), False),
        T.StructField("station_name", T.StringType(), False),
        T.StructField("station_fullname", T.StringType()),
        T.StructField("water_body", T.StringType()),
        T.StructField("catchment_name", T.StringType()),
        T.StructField("catchment_size_km2", DEC),
        T.StructField("distance_from_mouth_km", DEC),
        T.StructField("station_altitude_msl_m", DEC),
        T.StructField("latitude", DEC, False),
        T.StructField("longitude", DEC, False),
        T.StructField("is_active", T.BooleanType(), False),
    ]
)

HYDRO_HISTORY = T.StructType(
    list(HYDRO_STATIONS.fields) + [T.StructField("valid_from", T.TimestampType()), T.StructField("valid_to", T.TimestampType())]
)

METEO_STATION_COLS = [
    "station_code",
    "station_category",
    "station_name",
    "latitude",
    "longitude",
    "altitude_m",
    "is_active",
]
METEO_STATION_CHECK = [c for c in METEO_STATION_COLS if c != "station_code"]
METEO_STATIONS = T.StructType(
    [
        T.StructField("station_code", T.StringType(), False),
        T.StructField("station_category", T.StringType(), False),
        T.StructField("station_name", T.StringType(), False),
        T.StructField("latitude", DEC, False),
        T.StructField("longitude", DEC, False),
        T.StructField("altitude_m", DEC),
        T.StructField("is_active", T.BooleanType(), False),
    ]
)

PROXIMITY_KEY = ["hydro_station_code", "proximity_rank"]
PROXIMITY = T.StructType(
    [
        T.StructField("hydro_station_code", T.IntegerType(), False),
        T.StructField("meteo_station_code", T.StringType(), False),
        T.StructField("distance_km", DIST, False),
        T.StructField("proximity_rank", T.IntegerType(), False),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("event_time", T.TimestampType(), False),
        T.StructField("dag_id", T.StringType()),
        T.StructField("task_id", T.StringType()),
        T.StructField("target_date", T.DateType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("rows_deduplicated", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)

SILVER_HYDRO_DESCRIPTORS = [
    "jaam_kood",
    "jaam_nimi",
    "jaam_taisnimi",
    "valgala_nimi",
    "valgala_suurus_km2",
    "kaugus_suudmest_km",
    "latitude",
    "longitude",
    "veekogu_nimi",
    "timeline_ts_utc",
    "timeline_ts_local",
]
SILVER_METEO_KEYS = ["jaam_kood", "jaam_nimi", "aasta", "kuu", "paev", "tund", "observation_ts"]
