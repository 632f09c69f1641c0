"""Silver models: wide hourly tables (SIL-1, SIL-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import corrected_level
from ..functions.timeconv import wall_to_instant
from ..operators.history import VALID_FROM, VALID_TO, as_of_join, point_in_time_join
from ..operators.reshape import pivot_long
from ..schemas import HYDRO_SERIES, LOCAL_TZ, METEO_ELEMENTS, SILVER_HYDRO_DESCRIPTORS, SILVER_METEO_KEYS

HYDRO_MEASURES = list(HYDRO_SERIES.values())
METEO_MEASURES = list(METEO_ELEMENTS.values())


def hydro_source(bronze_hydro: DataFrame) -> DataFrame:
    """PRJ-1: the 13 bronze columns silver reads, coordinates renamed."""
    return bronze_hydro.select(
        "jaam_kood",
        "jaam_nimi",
        "jaam_taisnimi",
        "valgala_nimi",
        "valgala_suurus_km2",
        "kaugus_suudmest_km",
        F.col("jaam_laiuskraad").alias("latitude"),
        F.col("jaam_pikkuskraad").alias("longitude"),
        "veekogu_nimi",
        "timeline_ts_utc",
        "timeline_ts_local",
        "aegrida_nimi",
        "vaartus",
    )


def silver_hydro(
    bronze_hydro: DataFrame,
    station_history: DataFrame,
    stations: DataFrame,
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
    long_history: bool = False,
) -> DataFrame:
    """SIL-1: pivot the 9 hydro series, attach the station version valid at
    the reading time, fall back to the current station row, and add the
    gauge-zero corrected level.

    The fallback is ``COALESCE(version, current)`` per column, so it also
    fires when the matched version's altitude is NULL (kept for parity).
    ``long_history`` joins as of the reading time by sorting (stations with
    many versions) instead of an equi-join with the interval as residual.
    """
    pivoted = pivot_long(hydro_source(bronze_hydro), SILVER_HYDRO_DESCRIPTORS, "aegrida_nimi", "vaartus", HYDRO_SERIES)
    snap = station_history.select(
        F.col("station_code").alias("_s_code"),
        F.col("station_category").alias("_s_category"),
        F.col("station_altitude_msl_m").alias("_s_altitude"),
        F.col(valid_from).cast("timestamp").alias("_s_from"),
        F.col(valid_to).cast("timestamp").alias("_s_to"),
    )
    current = stations.select(
        F.col("station_code").alias("_r_code"),
        F.col("station_category").alias("_r_category"),
        F.col("station_altitude_msl_m").alias("_r_altitude"),
    )
    versions = as_of_join if long_history else point_in_time_join
    joined = versions(
        pivoted, snap, "jaam_kood", "_s_code", "timeline_ts_utc", "_s_from", "_s_to"
    )
    joined = joined.join(current, joined["jaam_kood"] == current["_r_code"], "left")
    altitude = F.coalesce(F.col("_s_altitude"), F.col("_r_altitude"))
    return joined.select(
        *SILVER_HYDRO_DESCRIPTORS,
        *HYDRO_MEASURES,
        F.coalesce(F.col("_s_category"), F.col("_r_category")).alias("station_category"),
        altitude.alias("station_altitude_msl_m"),
        corrected_level(F.col("wl_avg"), altitude).alias("wl_avg_corrected"),
    )


def meteo_source(bronze_meteo: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """PRJ-2 + TIM-1: bronze meteo columns plus the observation instant."""
    return bronze_meteo.select(
        "jaam_kood",
        "jaam_nimi",
        "aasta",
        "kuu",
        "paev",
        "tund",
        "element_kood",
        "vaartus",
        wall_to_instant("aasta", "kuu", "paev", "tund", tz).alias("observation_ts"),
    )


def silver_meteo(bronze_meteo: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """SIL-2: pivot the 10 meteo elements per station and local hour."""
    return pivot_long(meteo_source(bronze_meteo, tz), SILVER_METEO_KEYS, "element_kood", "vaartus", METEO_ELEMENTS)
