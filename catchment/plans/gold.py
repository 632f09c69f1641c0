"""Gold model: gauges joined to their nearest weather station (GLD-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeconv import instant_to_wall
from ..schemas import LOCAL_TZ

GOLD_COLUMNS = [
    "hydro_station_code",
    "hydro_station_name",
    "hydro_station_fullname",
    "catchment_name",
    "catchment_size_km2",
    "distance_from_mouth_km",
    "hydro_latitude",
    "hydro_longitude",
    "water_body",
    "station_category",
    "station_altitude_msl_m",
    "timeline_ts_utc",
    "observation_ts_local",
    "wl_avg",
    "wl_min",
    "wl_max",
    "wl_avg_corrected",
    "wt_avg",
    "wt_min",
    "wt_max",
    "discharge_avg",
    "discharge_min",
    "discharge_max",
    "meteo_station_code",
    "meteo_station_name",
    "meteo_distance_km",
    "meteo_latitude",
    "meteo_longitude",
    "precipitation_mm",
    "air_temp_avg",
    "air_temp_min",
    "air_temp_max",
    "humidity_pct",
    "pressure_hpa",
    "wind_speed_ms",
    "wind_gust_ms",
    "wind_direction_deg",
    "sunshine_duration_min",
]


def gold_hydro_meteo(
    silver_hydro: DataFrame,
    silver_meteo: DataFrame,
    proximity: DataFrame,
    meteo_stations: DataFrame,
    tz: str = LOCAL_TZ,
    meteo_names_from: DataFrame | None = None,
) -> DataFrame:
    """GLD-1: PRJ-3, TIM-2, FLT-1 -> JN-3 -> JN-4 -> JN-5 -> JN-6 -> PRJ-5.

    One lazy plan: no side is counted or run first. Spark broadcasts the
    small dimensions (rank-1 proximity, station coordinates, names) when
    their measured bytes allow. The gauge-hour x weather-hour join (JN-4) is
    the only big-big join; it shuffles on (station, hour) and AQE splits a
    weather station shared by many gauges. The DISTINCT (code, name) side
    is partially aggregated. ``meteo_names_from`` (default ``silver_meteo``) is
    the full weather table for the name lookup when ``silver_meteo`` is
    pruned to the days being built.
    """
    h = silver_hydro.select(
        F.col("jaam_kood").alias("hydro_station_code"),
        F.col("jaam_nimi").alias("hydro_station_name"),
        F.col("jaam_taisnimi").alias("hydro_station_fullname"),
        F.col("valgala_nimi").alias("catchment_name"),
        F.col("valgala_suurus_km2").alias("catchment_size_km2"),
        F.col("kaugus_suudmest_km").alias("distance_from_mouth_km"),
        F.col("latitude").alias("hydro_latitude"),
        F.col("longitude").alias("hydro_longitude"),
        F.col("veekogu_nimi").alias("water_body"),
        "station_category",
        "station_altitude_msl_m",
        "timeline_ts_utc",
        instant_to_wall("timeline_ts_utc", tz).alias("observation_ts_local"),
        "wl_avg",
        "wl_min",
        "wl_max",
        "wl_avg_corrected",
        "wt_avg",
        "wt_min",
        "wt_max",
        "discharge_avg",
        "discharge_min",
        "discharge_max",
    )
    p = proximity.filter(F.col("proximity_rank") == 1).select(
        F.col("hydro_station_code").alias("_p_code"),
        "meteo_station_code",
        F.col("distance_km").alias("meteo_distance_km"),
    )
    me = silver_meteo.select(
        F.col("jaam_kood").alias("_me_code"),
        F.col("observation_ts").alias("_me_ts"),
        "precipitation_mm",
        F.col("temp_avg").alias("air_temp_avg"),
        F.col("temp_min").alias("air_temp_min"),
        F.col("temp_max").alias("air_temp_max"),
        "humidity_pct",
        "pressure_hpa",
        "wind_speed_ms",
        "wind_gust_ms",
        "wind_direction_deg",
        "sunshine_duration_min",
    )
    ms = meteo_stations.select(
        F.col("station_code").alias("_ms_code"),
        F.col("latitude").alias("meteo_latitude"),
        F.col("longitude").alias("meteo_longitude"),
    )
    names = (
        (meteo_names_from if meteo_names_from is not None else silver_meteo)
        .select(F.col("jaam_kood").alias("_m_code"), F.col("jaam_nimi").alias("meteo_station_name"))
        .distinct()
    )

    j = h.join(p, h["hydro_station_code"] == p["_p_code"], "left")
    j = j.join(me, (j["meteo_station_code"] == me["_me_code"]) & (j["timeline_ts_utc"] == me["_me_ts"]), "left")
    j = j.join(ms, j["meteo_station_code"] == ms["_ms_code"], "left")
    j = j.join(names, j["meteo_station_code"] == names["_m_code"], "left")
    return j.select(*GOLD_COLUMNS)
