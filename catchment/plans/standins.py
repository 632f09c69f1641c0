"""Domain-shaped inputs derived from the driver's TPC-H-like tables.

The reference has no test data; these deterministic derivations let every
operator run on the given tables at any scale factor (their work grows with
the tables):

* ``events``   -> long hydro readings (station = user, series = event type,
                 hour = ts truncated) and long meteo readings (station =
                 user mod 25, element = event type, wall-clock parts of ts)
* ``supplier`` -> gauges (ref hydrometric stations)
* ``nation``   -> weather stations
* ``events``   -> daily station extracts -> SCD2 station history
* ``orders``   -> dated raw landing file names
* ``lineitem`` -> wall-clock hours over several years (DST folds and gaps)

The DuckDB twin of every derivation lives in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.history import scd2_from_extracts
from ..operators.keyed import latest_revision
from ..schemas import HYDRO_KEY, METEO_KEY

# --- fixed values of the stand-in mapping --------------------------------
# event_type -> hydro series, by event id in turn ('view' deliberately stays outside the dictionary)
EVENT_HYDRO_SERIES = {
    "click": ["WL avg", "WL min", "WL max"],
    "error": ["WT avg", "WT min", "WT max"],
    "purchase": ["Äravool avg", "Äravool min", "Äravool max"],
    "signup": ["WL avg"],
}
# event_type -> meteo element code, by event id in turn
EVENT_METEO_ELEMENTS = {
    "click": ["PR1H", "TA"],
    "error": ["TAN1H", "TAX1H"],
    "purchase": ["RH", "PA0"],
    "signup": ["WS10M", "WSX1H"],
    "view": ["WD10M", "SDUR1H"],
}
# event_type -> run-log status ('view' maps to a status outside the allowed set)
EVENT_RUN_STATUS = {"click": "running", "purchase": "success", "error": "error", "signup": "triggered", "view": "retried"}
N_WEATHER_STATIONS = 25
# --------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_table(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """The ``events`` table, or a frame derived from it (e.g. scaled copies)."""
    return events if events is not None else table(spark, sf_dir, "events")


def scaled_events(spark: SparkSession, sf_dir: str, copies: int) -> DataFrame:
    """``events`` repeated ``copies`` times, copy m shifted by m months (new
    event ids), so one month of readings becomes ``copies`` months. The
    copies are spread over the session's default parallelism, as many input
    files would be (the source table is a single row group)."""
    e = table(spark, sf_dir, "events")
    spread = spark.sparkContext.defaultParallelism
    m = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_m")
    return e.repartition(spread).select("*", m).select(
        (F.col("event_id") * copies + F.col("_m")).alias("event_id"),
        (F.col("ts") + F.make_ym_interval(F.lit(0), F.col("_m").cast("int"))).alias("ts"),
        "user_id",
        "event_type",
        "value",
        "props",
    )


def case_map(col: str, mapping: dict[str, str], default: Column | None = None) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(F.col(col) == F.lit(k), F.lit(v))) if out is None else out.when(F.col(col) == F.lit(k), F.lit(v))
    return out.otherwise(default) if default is not None else out


def in_turn(col: str, turn: str, mapping: dict[str, list[str]], default: Column) -> Column:
    """The value of ``mapping`` for ``col``; its choices alternate by ``turn``."""
    out = default
    for k, v in mapping.items():
        choice = F.element_at(F.array(*map(F.lit, v)), (F.col(turn) % len(v)).cast("int") + 1)
        out = F.when(F.col(col) == F.lit(k), choice).otherwise(out)
    return out


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _lat(key: str, mult: int, modulo: int, base: float) -> Column:
    return F.lit(base) + ((F.col(key) * mult) % modulo).cast("double") / F.lit(100.0)


def to_ntz(df: DataFrame) -> DataFrame:
    """Render instants as UTC wall clock (TIMESTAMP_NTZ) for comparison."""
    cols = [
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ref.hydrometric_stations stand-in (one gauge per supplier)."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").cast("int").alias("station_code"),
        F.when(F.col("s_nationkey") % 3 == 0, F.lit("monitoring"))
        .when(F.col("s_nationkey") % 3 == 1, F.lit("water_level"))
        .otherwise(F.lit("coastal"))
        .alias("station_category"),
        F.col("s_name").alias("station_name"),
        F.when(F.col("s_suppkey") % 5 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("s_name"), F.lit(" gauge")))
        .alias("station_fullname"),
        F.concat(F.lit("River "), _s(F.col("s_nationkey") % 11)).alias("water_body"),
        F.when(F.col("s_nationkey") % 4 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Basin "), _s(F.col("s_nationkey") % 9)))
        .alias("catchment_name"),
        (F.col("s_nationkey") * 100 + 50).cast("double").alias("catchment_size_km2"),
        ((F.col("s_suppkey") % 13).cast("double") * F.lit(1.5)).alias("distance_from_mouth_km"),
        F.when(F.col("s_suppkey") % 6 == 0, F.lit(None).cast("double"))
        .otherwise((F.col("s_suppkey") % 17).cast("double") * F.lit(0.5) - F.lit(2.0))
        .alias("station_altitude_msl_m"),
        _lat("s_suppkey", 37, 220, 57.5).alias("latitude"),
        _lat("s_suppkey", 53, 600, 22.0).alias("longitude"),
        (F.col("s_acctbal") >= 0).alias("is_active"),
    )


def weather_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ref.meteorological_stations stand-in (one station per nation)."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.concat(F.lit("M"), _s("n_nationkey")).alias("station_code"),
        F.concat(F.lit("R"), _s("n_regionkey")).alias("station_category"),
        F.col("n_name").alias("station_name"),
        _lat("n_nationkey", 29, 200, 57.6).alias("latitude"),
        _lat("n_nationkey", 71, 580, 22.1).alias("longitude"),
        F.when(F.col("n_regionkey") == 4, F.lit(None).cast("double"))
        .otherwise((F.col("n_regionkey") * 10).cast("double"))
        .alias("altitude_m"),
        (F.col("n_nationkey") % 6 != 5).alias("is_active"),
    )


def hydro_readings(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Raw hydro records (bronze.hydro shape + ``event_id``, ``published_ts``)."""
    e = events_table(spark, sf_dir, events)
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp")
    return e.select(
        "event_id",
        F.col("user_id").cast("int").alias("jaam_kood"),
        F.concat(F.lit("Gauge "), _s("user_id")).alias("jaam_nimi"),
        F.concat(F.lit("Gauge "), _s("user_id"), F.lit(" full")).alias("jaam_taisnimi"),
        F.when(F.col("user_id") % 4 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Basin "), _s(F.col("user_id") % 9)))
        .alias("valgala_nimi"),
        ((F.col("user_id") % 9) * 100 + 50).cast("double").alias("valgala_suurus_km2"),
        ((F.col("user_id") % 13).cast("double") * F.lit(1.5)).alias("kaugus_suudmest_km"),
        _lat("user_id", 37, 220, 57.5).alias("jaam_laiuskraad"),
        _lat("user_id", 53, 600, 22.0).alias("jaam_pikkuskraad"),
        F.concat(F.lit("River "), _s(F.col("user_id") % 11)).alias("veekogu_nimi"),
        hour.alias("timeline_ts_utc"),
        (hour + F.expr("INTERVAL 2 HOURS")).alias("timeline_ts_local"),
        in_turn("event_type", "event_id", EVENT_HYDRO_SERIES, F.col("event_type")).alias("aegrida_nimi"),
        F.col("value").alias("vaartus"),
        F.col("ts").cast("timestamp").alias("published_ts"),
    )


def bronze_hydro(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """bronze.hydro state: one row per key, the latest published reading."""
    return latest_revision(hydro_readings(spark, sf_dir, events), HYDRO_KEY, "published_ts", "event_id")


def meteo_readings(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Raw meteo records (bronze.meteo shape + ``event_id``).

    Publication time is the event minute, so equal versions occur and the
    first record (lowest event id) must win. Station M7 is published under
    a second name for users >= 100 (the two-name fan-out case).
    """
    e = events_table(spark, sf_dir, events)
    st = F.col("user_id") % N_WEATHER_STATIONS
    return e.select(
        "event_id",
        F.concat(F.lit("M"), _s(st)).alias("jaam_kood"),
        F.when((st == 7) & (F.col("user_id") >= 100), F.lit("NATION_7 (old name)"))
        .otherwise(F.concat(F.lit("NATION_"), _s(st)))
        .alias("jaam_nimi"),
        F.year("ts").alias("aasta"),
        F.month("ts").alias("kuu"),
        F.dayofmonth("ts").alias("paev"),
        F.hour("ts").alias("tund"),
        F.col("value").alias("vaartus"),
        in_turn("event_type", "event_id", EVENT_METEO_ELEMENTS, F.lit(None).cast("string")).alias("element_kood"),
        F.col("event_type").alias("element_nimi_eng"),
        F.lit("unit").alias("element_yhik_eng"),
        F.date_trunc("minute", F.col("ts")).cast("timestamp").alias("avaandmed_ts"),
    )


def bronze_meteo(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """bronze.meteo state after AGG-4 de-duplication."""
    return latest_revision(meteo_readings(spark, sf_dir, events), METEO_KEY, "avaandmed_ts", "event_id")


def station_extracts(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Daily extracts of gauge parameters (noon of each active day)."""
    e = events_table(spark, sf_dir, events)
    day = F.date_trunc("day", F.col("ts")).cast("timestamp")
    daily = e.groupBy(F.col("user_id"), day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return daily.select(
        F.col("user_id").cast("int").alias("station_code"),
        (F.col("day") + F.expr("INTERVAL 12 HOURS")).alias("extract_ts"),
        F.when(F.col("n") >= 4, F.lit("coastal")).otherwise(F.lit("monitoring")).alias("station_category"),
        F.when(F.col("n") % 5 == 0, F.lit(None).cast("double"))
        .otherwise((F.col("n") % 3).cast("double") - F.lit(1.0))
        .alias("station_altitude_msl_m"),
    )


HISTORY_CHECK = ["station_category", "station_altitude_msl_m"]


def station_history(
    spark: SparkSession, sf_dir: str, bucket: str | None = None, events: DataFrame | None = None
) -> DataFrame:
    """snapshots.snap_hydro_stations stand-in built with SCD-3."""
    return scd2_from_extracts(
        station_extracts(spark, sf_dir, events), ["station_code"], HISTORY_CHECK, "extract_ts", bucket
    )
