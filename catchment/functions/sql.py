"""The library's scalar functions as session SQL functions (UDF-1, UDF-2,
TIM-1, TIM-2).

Spark SQL functions with a SQL body are inlined into the calling plan, so
they run inside whole-stage codegen like the Column versions (no Python).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..schemas import LOCAL_TZ
from .geo import EARTH_RADIUS_KM


def _haversine_body() -> str:
    s_phi = "sin(radians(lat2 - lat1) / 2)"
    s_lam = "sin(radians(lon2 - lon1) / 2)"
    a = f"least(greatest({s_phi} * {s_phi} + cos(radians(lat1)) * cos(radians(lat2)) * {s_lam} * {s_lam}, 0.0D), 1.0D)"
    return f"{EARTH_RADIUS_KM}D * 2 * atan2(sqrt({a}), sqrt(1 - {a}))"


def register_sql_functions(spark: SparkSession, tz: str = LOCAL_TZ) -> list[str]:
    """Create (or replace) temporary SQL functions in ``spark``:

    * ``haversine_km(lat1, lon1, lat2, lon2)`` great-circle km
    * ``raw_file_date(name)`` date of ``<source>_<YYYY-MM-DD>.json``, else NULL
    * ``local_hour_to_instant(y, m, d, h)`` wall-clock hour in the local zone
      to an instant (autumn fold -> standard time, hour 24 -> next day)
    * ``instant_to_local(ts)`` instant to local wall clock (TIMESTAMP_NTZ)
    """
    rest = r"regexp_extract(regexp_replace(name, '\\.json$', ''), '^[^_]*_(.*)$', 1)"
    day0 = "make_date(y, m, d)"
    date = f"CASE WHEN h = 24 THEN date_add({day0}, 1) ELSE {day0} END"
    first = (
        f"make_timestamp_ltz(year({date}), month({date}), day({date}), "
        f"CASE WHEN h = 24 THEN 0 ELSE h END, 0, 0, '{tz}')"
    )
    later = f"({first} + INTERVAL 1 HOUR)"
    fold = f"from_utc_timestamp({later}, '{tz}') = from_utc_timestamp({first}, '{tz}')"
    bodies = {
        "haversine_km(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE": _haversine_body(),
        "raw_file_date(name STRING) RETURNS DATE": (
            f"CASE WHEN {rest} RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' "
            f"THEN CAST(try_to_timestamp({rest}, 'yyyy-MM-dd') AS DATE) END"
        ),
        "local_hour_to_instant(y INT, m INT, d INT, h INT) RETURNS TIMESTAMP": (
            f"CASE WHEN {fold} THEN {later} ELSE {first} END"
        ),
        "instant_to_local(ts TIMESTAMP) RETURNS TIMESTAMP_NTZ": (
            f"convert_timezone('UTC', '{tz}', CAST(ts AS TIMESTAMP_NTZ))"
        ),
    }
    names = []
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
        names.append(signature.split("(", 1)[0])
    return names
