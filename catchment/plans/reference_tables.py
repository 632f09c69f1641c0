"""Reference-table plans: the station proximity matrix (PRX-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.proximity import nearest_k
from ..schemas import PROXIMITY_K


def proximity_matrix(
    hydro_stations: DataFrame,
    meteo_stations: DataFrame,
    k: int = PROXIMITY_K,
    active_only: bool = True,
    start_cell_km: float | None = None,
) -> DataFrame:
    """PRX-1: FLT-2 -> nearest k (exact, no all-pairs join) -> MTH-2.

    Ranks follow the unrounded distance (ties by weather-station code); the
    stored distance is rounded to 3 decimals (metres).
    """
    h = hydro_stations
    m = meteo_stations
    if active_only:
        h = h.filter(F.col("is_active"))
        m = m.filter(F.col("is_active"))
    h = h.select(F.col("station_code").alias("hydro_station_code"), "latitude", "longitude")
    m = m.select(F.col("station_code").alias("meteo_station_code"), "latitude", "longitude")
    near = nearest_k(h, m, k, "hydro_station_code", "meteo_station_code", start_cell_km=start_cell_km)
    return near.select(
        "hydro_station_code",
        "meteo_station_code",
        F.round("distance_km", 3).alias("distance_km"),
        F.col("rank").alias("proximity_rank"),
    )
