"""DuckDB twins of the registered queries (brute-force SQL on the same
parquet views). Used only as the correctness oracle: it may use plain
all-pairs joins, since it runs on small fixtures."""

from __future__ import annotations

from .registry import (
    REPORT_RANGE,
    RESPONSE_GROUPS,
    COVERAGE_FROM,
    COVERAGE_TO,
    RETENTION_AS_OF,
    SNAPSHOT_AS_OF,
    UPSERT_CORRECTION,
    UPSERT_NEW_FROM,
    UPSERT_OLD_BEFORE,
    WINDOW_DAY,
)

TZ = "Europe/Tallinn"

HYDRO_READINGS = """
hydro_readings AS (
  SELECT event_id,
    CAST(user_id AS INTEGER) AS jaam_kood,
    'Gauge ' || CAST(user_id AS VARCHAR) AS jaam_nimi,
    'Gauge ' || CAST(user_id AS VARCHAR) || ' full' AS jaam_taisnimi,
    CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'Basin ' || CAST(user_id % 9 AS VARCHAR) END AS valgala_nimi,
    CAST((user_id % 9) * 100 + 50 AS DOUBLE) AS valgala_suurus_km2,
    CAST(user_id % 13 AS DOUBLE) * CAST(1.5 AS DOUBLE) AS kaugus_suudmest_km,
    CAST(57.5 AS DOUBLE) + CAST((user_id * 37) % 220 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS jaam_laiuskraad,
    CAST(22.0 AS DOUBLE) + CAST((user_id * 53) % 600 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS jaam_pikkuskraad,
    'River ' || CAST(user_id % 11 AS VARCHAR) AS veekogu_nimi,
    date_trunc('hour', ts) AS timeline_ts_utc,
    date_trunc('hour', ts) + INTERVAL 2 HOUR AS timeline_ts_local,
    CASE event_type WHEN 'click' THEN ['WL avg', 'WL min', 'WL max'][event_id % 3 + 1]
      WHEN 'error' THEN ['WT avg', 'WT min', 'WT max'][event_id % 3 + 1]
      WHEN 'purchase' THEN ['Äravool avg', 'Äravool min', 'Äravool max'][event_id % 3 + 1]
      WHEN 'signup' THEN 'WL avg' ELSE event_type END AS aegrida_nimi,
    value AS vaartus,
    ts AS published_ts
  FROM events)"""

BRONZE_HYDRO = """
bronze_hydro AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY jaam_kood, timeline_ts_utc, aegrida_nimi
                                 ORDER BY published_ts DESC NULLS LAST, event_id ASC) AS rn
    FROM hydro_readings) WHERE rn = 1)"""

METEO_READINGS = """
meteo_readings AS (
  SELECT event_id,
    'M' || CAST(user_id % 25 AS VARCHAR) AS jaam_kood,
    CASE WHEN user_id % 25 = 7 AND user_id >= 100 THEN 'NATION_7 (old name)'
         ELSE 'NATION_' || CAST(user_id % 25 AS VARCHAR) END AS jaam_nimi,
    CAST(year(ts) AS INTEGER) AS aasta, CAST(month(ts) AS INTEGER) AS kuu,
    CAST(day(ts) AS INTEGER) AS paev, CAST(hour(ts) AS INTEGER) AS tund,
    value AS vaartus,
    CASE event_type WHEN 'click' THEN ['PR1H', 'TA'][event_id % 2 + 1]
      WHEN 'error' THEN ['TAN1H', 'TAX1H'][event_id % 2 + 1]
      WHEN 'purchase' THEN ['RH', 'PA0'][event_id % 2 + 1]
      WHEN 'signup' THEN ['WS10M', 'WSX1H'][event_id % 2 + 1]
      WHEN 'view' THEN ['WD10M', 'SDUR1H'][event_id % 2 + 1] END AS element_kood,
    event_type AS element_nimi_eng,
    'unit' AS element_yhik_eng,
    date_trunc('minute', ts) AS avaandmed_ts
  FROM events)"""

METEO_KEY = "jaam_kood, aasta, kuu, paev, tund, element_kood"


def _latest(src: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {METEO_KEY}
                                 ORDER BY avaandmed_ts DESC NULLS LAST, event_id ASC) AS rn
    FROM {src}) WHERE rn = 1"""


BRONZE_METEO = f"""
bronze_meteo AS ({_latest('meteo_readings')})"""

GAUGES = """
gauges AS (
  SELECT CAST(s_suppkey AS INTEGER) AS station_code,
    CASE s_nationkey % 3 WHEN 0 THEN 'monitoring' WHEN 1 THEN 'water_level' ELSE 'coastal' END AS station_category,
    s_name AS station_name,
    CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_name || ' gauge' END AS station_fullname,
    'River ' || CAST(s_nationkey % 11 AS VARCHAR) AS water_body,
    CASE WHEN s_nationkey % 4 = 0 THEN NULL ELSE 'Basin ' || CAST(s_nationkey % 9 AS VARCHAR) END AS catchment_name,
    CAST(s_nationkey * 100 + 50 AS DOUBLE) AS catchment_size_km2,
    CAST(s_suppkey % 13 AS DOUBLE) * CAST(1.5 AS DOUBLE) AS distance_from_mouth_km,
    CASE WHEN s_suppkey % 6 = 0 THEN NULL
         ELSE CAST(s_suppkey % 17 AS DOUBLE) * CAST(0.5 AS DOUBLE) - CAST(2.0 AS DOUBLE) END AS station_altitude_msl_m,
    CAST(57.5 AS DOUBLE) + CAST((s_suppkey * 37) % 220 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS latitude,
    CAST(22.0 AS DOUBLE) + CAST((s_suppkey * 53) % 600 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS longitude,
    s_acctbal >= 0 AS is_active
  FROM supplier)"""

WEATHER = """
weather AS (
  SELECT 'M' || CAST(n_nationkey AS VARCHAR) AS station_code,
    'R' || CAST(n_regionkey AS VARCHAR) AS station_category,
    n_name AS station_name,
    CAST(57.6 AS DOUBLE) + CAST((n_nationkey * 29) % 200 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS latitude,
    CAST(22.1 AS DOUBLE) + CAST((n_nationkey * 71) % 580 AS DOUBLE) / CAST(100.0 AS DOUBLE) AS longitude,
    CASE WHEN n_regionkey = 4 THEN NULL ELSE CAST(n_regionkey * 10 AS DOUBLE) END AS altitude_m,
    n_nationkey % 6 <> 5 AS is_active
  FROM nation)"""

HISTORY = """
daily AS (
  SELECT user_id, date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY user_id, date_trunc('day', ts)),
extracts AS (
  SELECT CAST(user_id AS INTEGER) AS station_code, day + INTERVAL 12 HOUR AS extract_ts,
    CASE WHEN n >= 4 THEN 'coastal' ELSE 'monitoring' END AS station_category,
    CASE WHEN n % 5 = 0 THEN NULL ELSE CAST(n % 3 AS DOUBLE) - CAST(1.0 AS DOUBLE) END AS station_altitude_msl_m
  FROM daily),
marked AS (
  SELECT *, (lag(1) OVER w IS NULL
             OR station_category IS DISTINCT FROM lag(station_category) OVER w
             OR station_altitude_msl_m IS DISTINCT FROM lag(station_altitude_msl_m) OVER w) AS is_new
  FROM extracts WINDOW w AS (PARTITION BY station_code ORDER BY extract_ts)),
history AS (
  SELECT station_code, station_category, station_altitude_msl_m, extract_ts AS valid_from,
    coalesce(lead(extract_ts) OVER (PARTITION BY station_code ORDER BY extract_ts),
             TIMESTAMP '9999-12-31 00:00:00') AS valid_to
  FROM marked WHERE is_new)"""


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    s_phi = f"sin(radians({lat2} - {lat1}) / 2)"
    s_lam = f"sin(radians({lon2} - {lon1}) / 2)"
    a = f"({s_phi} * {s_phi} + cos(radians({lat1})) * cos(radians({lat2})) * {s_lam} * {s_lam})"
    a = f"least(greatest({a}, 0.0), 1.0)"
    return f"(6371.0 * 2 * atan2(sqrt({a}), sqrt(1 - {a})))"


def _proximity(name: str, k: int, active_only: bool) -> str:
    where_g = "WHERE is_active" if active_only else ""
    where_w = "WHERE is_active" if active_only else ""
    return f"""
{name} AS (
  SELECT hydro_station_code, meteo_station_code, round(d, 3) AS distance_km, CAST(rk AS INTEGER) AS proximity_rank
  FROM (
    SELECT g.station_code AS hydro_station_code, w.station_code AS meteo_station_code, d,
      row_number() OVER (PARTITION BY g.station_code ORDER BY d, w.station_code) AS rk
    FROM (SELECT * FROM gauges {where_g}) g
    CROSS JOIN (SELECT * FROM weather {where_w}) w
    CROSS JOIN LATERAL (SELECT {_haversine('g.latitude', 'g.longitude', 'w.latitude', 'w.longitude')} AS d)
  ) WHERE rk <= {k})"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# The expected columns, spelled out here on purpose: a wrong code in the
# library's own dictionary must not match itself.
_HYDRO_MEASURES = """
    max(vaartus) FILTER (aegrida_nimi = 'WL avg') AS wl_avg,
    max(vaartus) FILTER (aegrida_nimi = 'WL min') AS wl_min,
    max(vaartus) FILTER (aegrida_nimi = 'WL max') AS wl_max,
    max(vaartus) FILTER (aegrida_nimi = 'WT avg') AS wt_avg,
    max(vaartus) FILTER (aegrida_nimi = 'WT min') AS wt_min,
    max(vaartus) FILTER (aegrida_nimi = 'WT max') AS wt_max,
    max(vaartus) FILTER (aegrida_nimi = 'Äravool avg') AS discharge_avg,
    max(vaartus) FILTER (aegrida_nimi = 'Äravool min') AS discharge_min,
    max(vaartus) FILTER (aegrida_nimi = 'Äravool max') AS discharge_max"""
_METEO_MEASURES = """
    max(vaartus) FILTER (element_kood = 'PR1H') AS precipitation_mm,
    max(vaartus) FILTER (element_kood = 'TA') AS temp_avg,
    max(vaartus) FILTER (element_kood = 'TAN1H') AS temp_min,
    max(vaartus) FILTER (element_kood = 'TAX1H') AS temp_max,
    max(vaartus) FILTER (element_kood = 'RH') AS humidity_pct,
    max(vaartus) FILTER (element_kood = 'PA0') AS pressure_hpa,
    max(vaartus) FILTER (element_kood = 'WS10M') AS wind_speed_ms,
    max(vaartus) FILTER (element_kood = 'WSX1H') AS wind_gust_ms,
    max(vaartus) FILTER (element_kood = 'WD10M') AS wind_direction_deg,
    max(vaartus) FILTER (element_kood = 'SDUR1H') AS sunshine_duration_min"""


def _silver_hydro(history: str = "history") -> str:
    """From the specification: the version in force is the one that started
    last at or before the reading and has not ended; what it does not know is
    taken from the station's current row, looked up per reading."""
    return f"""
hours AS (
  SELECT jaam_kood, jaam_nimi, jaam_taisnimi, valgala_nimi, valgala_suurus_km2, kaugus_suudmest_km,
    jaam_laiuskraad AS latitude, jaam_pikkuskraad AS longitude, veekogu_nimi, timeline_ts_utc, timeline_ts_local,{_HYDRO_MEASURES}
  FROM bronze_hydro GROUP BY ALL),
started AS (
  SELECT hours.*, {history}.valid_to AS until,
    {history}.station_category AS then_category, {history}.station_altitude_msl_m AS then_altitude
  FROM hours ASOF LEFT JOIN {history} ON jaam_kood = {history}.station_code AND timeline_ts_utc >= {history}.valid_from),
placed AS (
  SELECT * EXCLUDE (until, then_category, then_altitude),
    ifnull(if(timeline_ts_utc < until, then_category, NULL),
           (SELECT min(station_category) FROM gauges WHERE station_code = started.jaam_kood)) AS station_category,
    ifnull(if(timeline_ts_utc < until, then_altitude, NULL),
           (SELECT min(station_altitude_msl_m) FROM gauges WHERE station_code = started.jaam_kood)) AS station_altitude_msl_m
  FROM started),
silver_hydro AS (SELECT *, ifnull(wl_avg + station_altitude_msl_m, wl_avg) AS wl_avg_corrected FROM placed)"""


SILVER_HYDRO = _silver_hydro()

SILVER_METEO = f"""
silver_meteo AS (
  SELECT jaam_kood, jaam_nimi, aasta, kuu, paev, tund,
    timezone('UTC', make_timestamptz(aasta, kuu, paev, tund, 0, 0.0, '{TZ}')) AS observation_ts,{_METEO_MEASURES}
  FROM bronze_meteo GROUP BY ALL)"""

# From the specification: one row per gauge hour and per weather row of that
# hour at the nearest station, once for every name the station ever had.
GOLD = f"""
nearest AS (
  SELECT hydro_station_code, min(meteo_station_code) AS meteo_station_code, min(distance_km) AS meteo_distance_km
  FROM proximity GROUP BY hydro_station_code, proximity_rank HAVING proximity_rank = 1),
called AS (SELECT jaam_kood AS meteo_station_code, list(DISTINCT jaam_nimi) AS all_names FROM silver_meteo GROUP BY ALL),
sited AS (SELECT station_code AS meteo_station_code, latitude AS meteo_latitude, longitude AS meteo_longitude FROM weather),
weather_hours AS (
  SELECT jaam_kood AS meteo_station_code, observation_ts AS timeline_ts_utc, precipitation_mm, temp_avg AS air_temp_avg,
    temp_min AS air_temp_min, temp_max AS air_temp_max, humidity_pct, pressure_hpa, wind_speed_ms, wind_gust_ms,
    wind_direction_deg, sunshine_duration_min
  FROM silver_meteo),
gauge_hours AS (
  SELECT jaam_kood AS hydro_station_code, jaam_nimi AS hydro_station_name, jaam_taisnimi AS hydro_station_fullname,
    valgala_nimi AS catchment_name, valgala_suurus_km2 AS catchment_size_km2,
    kaugus_suudmest_km AS distance_from_mouth_km, latitude AS hydro_latitude, longitude AS hydro_longitude,
    veekogu_nimi AS water_body,
    timezone('{TZ}', timezone('UTC', timeline_ts_utc)) AS observation_ts_local,
    * EXCLUDE (jaam_kood, jaam_nimi, jaam_taisnimi, valgala_nimi, valgala_suurus_km2, kaugus_suudmest_km, latitude,
               longitude, veekogu_nimi, timeline_ts_local)
  FROM silver_hydro),
gold AS (
  SELECT * EXCLUDE (all_names), unnest(ifnull(all_names, [NULL])) AS meteo_station_name
  FROM gauge_hours LEFT JOIN nearest USING (hydro_station_code) LEFT JOIN sited USING (meteo_station_code)
  LEFT JOIN called USING (meteo_station_code) LEFT JOIN weather_hours USING (meteo_station_code, timeline_ts_utc))"""

GOLD_CTES = (
    HYDRO_READINGS,
    BRONZE_HYDRO,
    METEO_READINGS,
    BRONZE_METEO,
    GAUGES,
    WEATHER,
    HISTORY,
    _proximity("proximity", 3, True),
    SILVER_HYDRO,
    SILVER_METEO,
    GOLD,
)

RUN_EVENTS = """
run_events AS (
  SELECT 'run-' || CAST(user_id AS VARCHAR) AS run_id, date_trunc('day', ts) AS event_time, event_id, status,
    CAST(event_id AS INTEGER) AS seq,
    CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'daily_load' END AS dag_id,
    CASE WHEN user_id % 2 = 0 THEN 'ingest_hydro' ELSE 'ingest_meteo' END AS task_id,
    DATE '2024-01-01' + CAST(user_id % 40 AS INTEGER) AS target_date,
    CASE WHEN event_id % 5 = 0 THEN 'file-' || CAST(event_id AS VARCHAR) END AS source_file,
    CASE WHEN status = 'success' THEN CAST(floor(value * 9) AS BIGINT) END AS rows_deduplicated,
    CASE WHEN status = 'success' THEN CAST(floor(value * 10) AS BIGINT) END AS rows_processed,
    CASE WHEN status = 'success' THEN CAST(floor(value) AS BIGINT) END AS rows_loaded,
    CASE WHEN status = 'error' THEN 'failed: ' || CAST(event_id AS VARCHAR) END AS error_message
  FROM (SELECT *, CASE event_type WHEN 'click' THEN 'running' WHEN 'purchase' THEN 'success'
                   WHEN 'error' THEN 'error' WHEN 'signup' THEN 'triggered' WHEN 'view' THEN 'retried' END AS status
        FROM events))"""

RUN_STATE = """
run_state AS (
  SELECT run_id,
    first(dag_id ORDER BY event_time, seq, status) FILTER (dag_id IS NOT NULL) AS dag_id,
    first(task_id ORDER BY event_time, seq, status) FILTER (task_id IS NOT NULL) AS task_id,
    first(target_date ORDER BY event_time, seq, status) FILTER (target_date IS NOT NULL) AS target_date,
    first(source_file ORDER BY event_time, seq, status) FILTER (source_file IS NOT NULL) AS source_file,
    min(event_time) AS started_at,
    CASE WHEN last(status ORDER BY event_time, seq, status) IN ('success', 'error', 'skipped')
         THEN max(event_time) END AS finished_at,
    last(status ORDER BY event_time, seq, status) AS status,
    last(rows_processed ORDER BY event_time, seq, status) FILTER (rows_processed IS NOT NULL) AS rows_processed,
    last(rows_loaded ORDER BY event_time, seq, status) FILTER (rows_loaded IS NOT NULL) AS rows_loaded,
    last(rows_deduplicated ORDER BY event_time, seq, status) FILTER (rows_deduplicated IS NOT NULL) AS rows_deduplicated,
    last(error_message ORDER BY event_time, seq, status) FILTER (error_message IS NOT NULL) AS error_message,
    count(*) AS n_events
  FROM run_events GROUP BY run_id)"""

LANDED_FILES = """
landed_files AS (
  SELECT DISTINCT
    CASE WHEN o_orderstatus = 'F' THEN 'hydro' ELSE 'meteo' END AS source,
    CASE WHEN o_orderstatus = 'P'
         THEN 'meteo_' || o_orderpriority || CASE WHEN o_orderpriority = '5-LOW' THEN '.txt' ELSE '.json' END
         ELSE CASE WHEN o_orderstatus = 'F' THEN 'hydro' ELSE 'meteo' END || '_' || strftime(o_orderdate, '%Y-%m-%d')
              || CASE WHEN o_orderpriority = '5-LOW' THEN '.txt' ELSE '.json' END
    END AS file_name
  FROM orders)"""

RETENTION_PLAN = f"""
parsed AS (
  SELECT source, file_name,
    CASE WHEN regexp_full_match(regexp_extract(regexp_replace(file_name, '\\.json$', ''), '^[^_]*_(.*)$', 1),
                                '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
         THEN CAST(try_strptime(regexp_extract(regexp_replace(file_name, '\\.json$', ''), '^[^_]*_(.*)$', 1), '%Y-%m-%d') AS DATE)
    END AS file_date
  FROM landed_files WHERE file_name LIKE '%.json'),
retention_plan AS (
  SELECT source, file_name, file_date,
    CASE WHEN file_date IS NULL THEN 'unrecognised'
         WHEN file_date >= DATE '{RETENTION_AS_OF}' - INTERVAL 7 DAY THEN 'skipped'
         ELSE 'archived' END AS outcome
  FROM parsed)"""


def _q_upsert_if_changed() -> str:
    inc = """
incoming AS (
  SELECT g.station_code, g.station_category,
    CASE WHEN g.station_code % 11 = 0 THEN g.station_name || ' (renamed)' ELSE g.station_name END AS station_name,
    g.station_fullname, g.water_body, g.catchment_name, g.catchment_size_km2, g.distance_from_mouth_km,
    CASE WHEN s.s_nationkey % 5 = 0 THEN coalesce(g.station_altitude_msl_m, CAST(0.0 AS DOUBLE)) + CAST(0.25 AS DOUBLE)
         ELSE g.station_altitude_msl_m END AS station_altitude_msl_m,
    g.latitude, g.longitude, g.is_active
  FROM gauges g JOIN supplier s ON g.station_code = CAST(s.s_suppkey AS INTEGER)
  WHERE s.s_acctbal >= 0
  UNION ALL
  SELECT CAST(n.n_nationkey + 100000 AS INTEGER), 'monitoring', n.n_name, NULL, NULL, NULL,
    CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), w.latitude, w.longitude, TRUE
  FROM nation n JOIN weather w ON 'M' || CAST(n.n_nationkey AS VARCHAR) = w.station_code)"""
    cols = [
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
    distinct = " OR ".join(f"c.{x} IS DISTINCT FROM i.{x}" for x in cols)
    action = f"""CASE WHEN c.station_code IS NULL THEN 'insert' WHEN i.station_code IS NULL THEN 'keep'
      WHEN {distinct} THEN 'update' ELSE 'noop' END"""
    picked = ", ".join(
        f"CASE WHEN act IN ('insert', 'update') THEN i_{x} ELSE c_{x} END AS {x}" for x in cols
    )
    inner_cols = ", ".join(f"c.{x} AS c_{x}, i.{x} AS i_{x}" for x in cols)
    return (
        _with(GAUGES, WEATHER, inc)
        + f"""
SELECT station_code, {picked}, act AS _action FROM (
  SELECT coalesce(c.station_code, i.station_code) AS station_code, {inner_cols}, {action} AS act
  FROM gauges c FULL OUTER JOIN incoming i ON c.station_code = i.station_code)"""
    )


def _stepped(cols: list[str], history: str = "history", current: str = "gauges", name: str = "stepped") -> str:
    """One snapshot run: open versions of changed stations end, new ones start."""
    open_end, as_of = "TIMESTAMP '9999-12-31 00:00:00'", f"TIMESTAMP '{SNAPSHOT_AS_OF}'"
    names = ", ".join(cols)
    differs = " OR ".join(f"o.{c} IS DISTINCT FROM c.{c}" for c in cols)
    return f"""
moved AS (
  SELECT c.station_code FROM {current} c JOIN {history} o ON o.station_code = c.station_code AND o.valid_to = {open_end}
  WHERE {differs}),
{name} AS (
  SELECT station_code, {names}, valid_from,
    CASE WHEN valid_to = {open_end} AND station_code IN (FROM moved) THEN {as_of} ELSE valid_to END AS valid_to
  FROM {history}
  UNION ALL
  SELECT station_code, {names}, {as_of}, {open_end} FROM {current}
  WHERE station_code IN (FROM moved) OR station_code NOT IN (SELECT station_code FROM {history} WHERE valid_to = {open_end}))"""


_CATEGORY_ALTITUDE = ["station_category", "station_altitude_msl_m"]


def _q_seed_cleaning() -> str:
    return (
        _with(GAUGES)
        + """,
seed_text AS (
  SELECT CAST(g.station_code AS VARCHAR) AS station_code, g.station_category, g.station_name,
    coalesce(g.station_fullname, '') AS station_fullname, coalesce(g.water_body, '') AS water_body,
    coalesce(g.catchment_name, '') AS catchment_name,
    CASE WHEN s.s_nationkey % 3 = 0 THEN '' WHEN g.catchment_size_km2 IS NULL THEN '' ELSE printf('%.1f', g.catchment_size_km2) END AS catchment_size_km2,
    CASE WHEN g.distance_from_mouth_km IS NULL THEN '' ELSE printf('%.2f', g.distance_from_mouth_km) END AS distance_from_mouth_km,
    CASE WHEN g.station_altitude_msl_m IS NULL THEN '' ELSE printf('%.2f', g.station_altitude_msl_m) END AS station_altitude_msl_m,
    printf('%.2f', g.latitude) AS latitude, printf('%.2f', g.longitude) AS longitude,
    CASE s.s_nationkey % 4 WHEN 0 THEN ' TRUE ' WHEN 1 THEN 'true' WHEN 2 THEN 'False' ELSE 'yes' END AS is_active
  FROM gauges g JOIN supplier s ON g.station_code = CAST(s.s_suppkey AS INTEGER))
SELECT CAST(station_code AS INTEGER) AS station_code, station_category, station_name,
  nullif(station_fullname, '') AS station_fullname, nullif(water_body, '') AS water_body,
  nullif(catchment_name, '') AS catchment_name,
  CAST(CAST(nullif(catchment_size_km2, '') AS DECIMAL(18,6)) AS DOUBLE) AS catchment_size_km2,
  CAST(CAST(nullif(distance_from_mouth_km, '') AS DECIMAL(18,6)) AS DOUBLE) AS distance_from_mouth_km,
  CAST(CAST(nullif(station_altitude_msl_m, '') AS DECIMAL(18,6)) AS DOUBLE) AS station_altitude_msl_m,
  CAST(CAST(latitude AS DECIMAL(18,6)) AS DOUBLE) AS latitude,
  CAST(CAST(longitude AS DECIMAL(18,6)) AS DOUBLE) AS longitude,
  coalesce(lower(trim(is_active)) = 'true', FALSE) AS is_active
FROM seed_text"""
    )


SHIFTED = """
shifted AS (
  SELECT l_orderkey, l_linenumber,
    l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) + to_minutes(CAST((l_linenumber * 7) % 60 AS INTEGER)) AS instant_utc
  FROM lineitem)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["gold_hydro_meteo"] = _with(*GOLD_CTES) + "\nSELECT * FROM gold"
    q["silver_hydro"] = _with(HYDRO_READINGS, BRONZE_HYDRO, GAUGES, HISTORY, SILVER_HYDRO) + "\nSELECT * FROM silver_hydro"
    q["silver_meteo"] = _with(METEO_READINGS, BRONZE_METEO, SILVER_METEO) + "\nSELECT * FROM silver_meteo"
    q["pivot_hourly_wide"] = """
SELECT user_id, date_trunc('hour', ts) AS hour,
  max(CASE WHEN event_type = 'click' THEN value END) AS max_click,
  max(CASE WHEN event_type = 'error' THEN value END) AS max_error,
  max(CASE WHEN event_type = 'purchase' THEN value END) AS max_purchase,
  max(CASE WHEN event_type = 'signup' THEN value END) AS max_signup
FROM events GROUP BY user_id, date_trunc('hour', ts)"""
    q["latest_revision"] = _with(METEO_READINGS, BRONZE_METEO) + "\nSELECT * FROM bronze_meteo"
    q["keyed_upsert"] = (
        _with(METEO_READINGS)
        + f""",
old AS ({_latest(f"(SELECT * FROM meteo_readings WHERE make_date(aasta, kuu, paev) < DATE '{UPSERT_OLD_BEFORE}')")}),
new AS ({_latest(f"(SELECT * REPLACE (vaartus + CAST({UPSERT_CORRECTION} AS DOUBLE) AS vaartus) FROM meteo_readings WHERE make_date(aasta, kuu, paev) >= DATE '{UPSERT_NEW_FROM}')")})
SELECT * FROM old WHERE NOT EXISTS (
  SELECT 1 FROM new WHERE new.jaam_kood = old.jaam_kood AND new.aasta = old.aasta AND new.kuu = old.kuu
    AND new.paev = old.paev AND new.tund = old.tund AND new.element_kood = old.element_kood)
UNION ALL SELECT * FROM new"""
    )
    q["upsert_if_changed"] = _q_upsert_if_changed()
    q["scd2_history"] = _with(HISTORY) + "\nSELECT * FROM history"
    q["scd2_history_split"] = q["scd2_history"]
    q["scd2_apply_step"] = _with(GAUGES, HISTORY, _stepped(_CATEGORY_ALTITUDE)) + "\nSELECT * FROM stepped"
    q["gold_after_reference_change"] = (
        _with(
            HYDRO_READINGS, BRONZE_HYDRO, METEO_READINGS, BRONZE_METEO, GAUGES, WEATHER, HISTORY,
            _stepped(_CATEGORY_ALTITUDE), _proximity("proximity", 3, True), _silver_hydro("stepped"), SILVER_METEO, GOLD,
        )
        + "\nSELECT * FROM gold"
    )
    q["ingest_hydro_multipart"] = (
        _with(HYDRO_READINGS)
        + """
SELECT * EXCLUDE (published_ts) FROM hydro_readings
QUALIFY row_number() OVER (PARTITION BY jaam_kood, timeline_ts_utc, aegrida_nimi
  ORDER BY CAST(published_ts AS DATE) + CAST(event_id % 2 AS INTEGER) DESC, event_id % 3 DESC, event_id DESC) = 1"""
    )
    q["ingest_meteo_multipart"] = (
        _with(METEO_READINGS)
        + f"""
SELECT * FROM meteo_readings
QUALIFY row_number() OVER (PARTITION BY {METEO_KEY}
  ORDER BY make_date(aasta, kuu, paev) + CAST(event_id % 2 AS INTEGER) DESC, avaandmed_ts DESC, event_id % 3, event_id) = 1"""
    )
    q["keyed_upsert_hydro"] = (
        _with(HYDRO_READINGS, BRONZE_HYDRO)
        + f"""
SELECT * REPLACE (CASE WHEN timeline_ts_utc >= TIMESTAMP '{UPSERT_NEW_FROM}' THEN vaartus + {UPSERT_CORRECTION} ELSE vaartus END AS vaartus)
FROM bronze_hydro
WHERE timeline_ts_utc >= TIMESTAMP '{UPSERT_NEW_FROM}' OR timeline_ts_utc < TIMESTAMP '{UPSERT_OLD_BEFORE}'"""
    )
    q["weather_station_changes"] = (
        _with(WEATHER)
        + """
SELECT station_code, station_category,
  CASE WHEN k % 4 = 1 THEN station_name || ' (renamed)' ELSE station_name END AS station_name,
  latitude, longitude, CASE WHEN k % 4 = 2 THEN ifnull(altitude_m, 0) + 1 ELSE altitude_m END AS altitude_m, is_active,
  CASE WHEN k % 4 = 3 THEN 'keep' WHEN k % 4 IN (1, 2) THEN 'update' ELSE 'noop' END AS _action
FROM (SELECT *, CAST(station_code[2:] AS INTEGER) AS k FROM weather)
UNION ALL
SELECT 'N' || station_code, station_category, station_name, latitude, longitude, altitude_m, is_active, 'insert' FROM weather"""
    )
    q["scd2_weather_snapshots"] = (
        _with(WEATHER)
        + f"""
SELECT station_code, station_category, station_name, latitude, longitude, altitude_m, is_active,
  TIMESTAMP '2023-12-01 00:00:00' AS valid_from,
  CASE WHEN CAST(station_code[2:] AS INTEGER) % 4 IN (1, 2) THEN TIMESTAMP '{SNAPSHOT_AS_OF}' ELSE TIMESTAMP '9999-12-31 00:00:00' END AS valid_to
FROM weather
UNION ALL
SELECT station_code, station_category, CASE WHEN CAST(station_code[2:] AS INTEGER) % 4 = 1 THEN station_name || ' (renamed)' ELSE station_name END,
  latitude, longitude, CASE WHEN CAST(station_code[2:] AS INTEGER) % 4 = 2 THEN ifnull(altitude_m, 0) + 1 ELSE altitude_m END, is_active,
  TIMESTAMP '{SNAPSHOT_AS_OF}', TIMESTAMP '9999-12-31 00:00:00'
FROM weather WHERE CAST(station_code[2:] AS INTEGER) % 4 IN (1, 2)
UNION ALL
SELECT 'N' || station_code, station_category, station_name, latitude, longitude, altitude_m, is_active,
  TIMESTAMP '{SNAPSHOT_AS_OF}', TIMESTAMP '9999-12-31 00:00:00' FROM weather"""
    )
    q["scd2_gauge_snapshots"] = (
        _with(GAUGES)
        + f"""
SELECT *, TIMESTAMP '2023-12-01 00:00:00' AS valid_from,
  CASE WHEN station_code % 3 <> 0 THEN TIMESTAMP '{SNAPSHOT_AS_OF}' ELSE TIMESTAMP '9999-12-31 00:00:00' END AS valid_to
FROM gauges
UNION ALL
SELECT * REPLACE (CASE WHEN station_code % 3 = 1 THEN water_body || ' (new)' ELSE water_body END AS water_body,
    CASE WHEN station_code % 3 = 2 THEN NOT is_active ELSE is_active END AS is_active),
  TIMESTAMP '{SNAPSHOT_AS_OF}', TIMESTAMP '9999-12-31 00:00:00'
FROM gauges WHERE station_code % 3 <> 0"""
    )
    q["seed_cleaning_weather"] = (
        _with(WEATHER)
        + """
SELECT station_code, station_category, station_name, latitude, longitude, altitude_m,
  CAST(station_code[2:] AS INTEGER) % 3 < 2 AS is_active FROM weather"""
    )
    q["column_defaults"] = (
        _with(GAUGES)
        + f"""
SELECT station_code, CASE WHEN station_code % 4 = 0 THEN TRUE ELSE is_active END AS is_active,
  TIMESTAMP '{SNAPSHOT_AS_OF}' AS loaded_at FROM gauges"""
    )
    q["point_in_time"] = (
        _with(HYDRO_READINGS, GAUGES, HISTORY)
        + """
SELECT f.event_id, f.jaam_kood, f.timeline_ts_utc, f.vaartus, h.valid_from AS version_from,
  coalesce(h.station_category, g.station_category) AS station_category,
  coalesce(h.station_altitude_msl_m, g.station_altitude_msl_m) AS station_altitude_msl_m,
  CASE WHEN coalesce(h.station_altitude_msl_m, g.station_altitude_msl_m) IS NOT NULL
       THEN f.vaartus + coalesce(h.station_altitude_msl_m, g.station_altitude_msl_m) ELSE f.vaartus END AS value_corrected
FROM hydro_readings f
LEFT JOIN history h ON f.jaam_kood = h.station_code AND f.timeline_ts_utc >= h.valid_from AND f.timeline_ts_utc < h.valid_to
LEFT JOIN gauges g ON f.jaam_kood = g.station_code"""
    )
    q["point_in_time_sorted"] = q["point_in_time"]
    q["stream_bronze_meteo"] = (
        _with(METEO_READINGS)
        + f"""
SELECT * EXCLUDE (event_id) FROM (
  SELECT * REPLACE (avaandmed_ts + to_milliseconds(CAST(event_id % 60000 AS BIGINT)) AS avaandmed_ts) FROM meteo_readings)
QUALIFY row_number() OVER (PARTITION BY {METEO_KEY} ORDER BY avaandmed_ts DESC) = 1"""
    )
    q["constraint_report"] = (
        _with(METEO_READINGS)
        + f"""
, per_key AS (
  SELECT concat_ws('|', {", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in METEO_KEY.split(", "))}) AS key, count(*) AS n,
    count(*) FILTER (WHERE jaam_kood IS NULL) AS r1, count(*) FILTER (WHERE element_kood IS NULL) AS r2, count(*) FILTER (WHERE avaandmed_ts IS NULL) AS r3,
    count(*) FILTER (WHERE vaartus NOT BETWEEN {REPORT_RANGE[0]} AND {REPORT_RANGE[1]}) AS g,
    count(*) FILTER (WHERE element_nimi_eng NOT IN ('click', 'purchase', 'signup')) AS a
  FROM meteo_readings GROUP BY {METEO_KEY})
SELECT 'unique' AS rule, '{METEO_KEY.replace(", ", ",")}' AS "column", key, n AS n_rows FROM per_key WHERE n > 1
UNION ALL SELECT 'required', 'jaam_kood', key, r1 FROM per_key WHERE r1 > 0
UNION ALL SELECT 'required', 'element_kood', key, r2 FROM per_key WHERE r2 > 0
UNION ALL SELECT 'required', 'avaandmed_ts', key, r3 FROM per_key WHERE r3 > 0
UNION ALL SELECT 'range', 'vaartus', key, g FROM per_key WHERE g > 0
UNION ALL SELECT 'allowed', 'element_nimi_eng', key, a FROM per_key WHERE a > 0"""
    )
    q["nearest_three"] = _with(GAUGES, WEATHER, _proximity("proximity", 3, True)) + "\nSELECT * FROM proximity"
    q["proximity_upsert"] = (
        _with(GAUGES, WEATHER, _proximity("old", 3, False), _proximity("new", 3, True))
        + """
SELECT * FROM old WHERE NOT EXISTS (
  SELECT 1 FROM new WHERE new.hydro_station_code = old.hydro_station_code AND new.proximity_rank = old.proximity_rank)
UNION ALL SELECT * FROM new"""
    )
    q["local_wall_clock"] = (
        _with(SHIFTED) + f"\nSELECT *, timezone('{TZ}', timezone('UTC', instant_utc)) AS local_ts FROM shifted"
    )
    q["wall_to_instant"] = f"""
SELECT *, timezone('UTC', make_timestamptz(aasta, kuu, paev, tund, 0, 0.0, '{TZ}')) AS observation_ts
FROM (SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS aasta,
        CAST(month(l_shipdate) AS INTEGER) AS kuu, CAST(day(l_shipdate) AS INTEGER) AS paev,
        CAST((l_orderkey + l_linenumber) % 25 AS INTEGER) AS tund FROM lineitem)"""
    q["day_window_hydro"] = (
        _with(HYDRO_READINGS)
        + f"""
SELECT * FROM hydro_readings
WHERE timeline_ts_local >= TIMESTAMP '{WINDOW_DAY} 00:00:00'
  AND timeline_ts_local < TIMESTAMP '{WINDOW_DAY} 00:00:00' + INTERVAL 1 DAY"""
    )
    y, m, d = (int(x) for x in WINDOW_DAY.split("-"))
    q["day_window_meteo"] = _with(METEO_READINGS) + f"\nSELECT * FROM meteo_readings WHERE aasta = {y} AND kuu = {m} AND paev = {d}"
    q["seed_cleaning"] = _q_seed_cleaning()
    q["required_fields"] = (
        _with(HYDRO_READINGS)
        + """,
raw AS (
  SELECT r.event_id,
    CASE WHEN CAST(e.props->>'k' AS INTEGER) >= 97 THEN NULL ELSE r.jaam_kood END AS jaam_kood,
    CASE WHEN CAST(e.props->>'k' AS INTEGER) = 50 THEN NULL ELSE r.timeline_ts_utc END AS timeline_ts_utc,
    CASE WHEN CAST(e.props->>'k' AS INTEGER) <= 2 THEN NULL ELSE r.aegrida_nimi END AS aegrida_nimi
  FROM hydro_readings r JOIN events e ON r.event_id = e.event_id)
SELECT event_id, 'jaam_kood' AS column_name FROM raw WHERE jaam_kood IS NULL
UNION ALL SELECT event_id, 'timeline_ts_utc' FROM raw WHERE timeline_ts_utc IS NULL
UNION ALL SELECT event_id, 'aegrida_nimi' FROM raw WHERE aegrida_nimi IS NULL"""
    )
    q["unique_violations"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
    q["hourly_duplicates"] = (
        _with(*GOLD_CTES)
        + """
SELECT hydro_station_code, timeline_ts_utc, count(*) AS n_rows FROM gold
GROUP BY hydro_station_code, timeline_ts_utc HAVING count(*) > 1"""
    )
    q["domain_violations"] = (
        _with(RUN_EVENTS, GAUGES, WEATHER, _proximity("proximity4", 4, True))
        + """
SELECT 'status' AS rule, CAST(event_id AS VARCHAR) AS subject, status AS value FROM run_events
WHERE status NOT IN ('running', 'success', 'error', 'triggered', 'skipped')
UNION ALL
SELECT 'proximity_rank', CAST(hydro_station_code AS VARCHAR), CAST(proximity_rank AS VARCHAR) FROM proximity4
WHERE proximity_rank NOT BETWEEN 1 AND 3"""
    )
    q["audit_state"] = _with(RUN_EVENTS, RUN_STATE) + "\nSELECT * FROM run_state"
    q["day_coverage"] = (
        _with(RUN_EVENTS, RUN_STATE)
        + f"""
SELECT source, CAST(day AS DATE) AS target_date
FROM (SELECT unnest(['hydro', 'meteo']) AS source) s,
  (SELECT unnest(generate_series(DATE '{COVERAGE_FROM}', DATE '{COVERAGE_TO}', INTERVAL 1 DAY)) AS day) d
WHERE NOT EXISTS (SELECT 1 FROM run_state r
  WHERE r.status = 'success' AND r.task_id = 'ingest_' || source AND r.target_date = CAST(day AS DATE))"""
    )
    q["retention_split"] = (
        _with(LANDED_FILES, RETENTION_PLAN)
        + """
SELECT source, file_name, file_date, outcome,
  CASE WHEN outcome = 'archived' THEN strftime(file_date, '%Y') END AS archive_year,
  CASE WHEN outcome = 'archived' THEN strftime(file_date, '%m') END AS archive_month
FROM retention_plan"""
    )
    q["retention_counts"] = (
        _with(LANDED_FILES, RETENTION_PLAN) + "\nSELECT outcome, count(*) AS n_files FROM retention_plan GROUP BY outcome"
    )
    hours = """
per_hour AS (
  SELECT hydro_station_code, timeline_ts_utc, max(catchment_name) AS catchment_name,
    CAST(max(observation_ts_local) AS DATE) AS day, max(precipitation_mm) AS rain, max(wl_avg) AS level,
    max(discharge_avg) AS discharge, max(air_temp_avg) AS temp
  FROM gold GROUP BY hydro_station_code, timeline_ts_utc)"""
    q["rain_response"] = (
        _with(*GOLD_CTES, hours)
        + """,
pairs AS (
  SELECT r.hydro_station_code, date_diff('hour', r.timeline_ts_utc, l.timeline_ts_utc) AS lag, r.rain AS x, l.level AS y
  FROM per_hour r JOIN per_hour l ON r.hydro_station_code = l.hydro_station_code AND r.rain IS NOT NULL AND l.level IS NOT NULL
    AND l.timeline_ts_utc BETWEEN r.timeline_ts_utc AND r.timeline_ts_utc + INTERVAL 72 HOUR),
sums AS (
  SELECT hydro_station_code, lag, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(y * y) AS syy, sum(x * y) AS sxy
  FROM pairs GROUP BY 1, 2),
scored AS (
  SELECT hydro_station_code, lag, n,
    round((n * sxy - sx * sy) / sqrt((n * sxx - sx * sx) * (n * syy - sy * sy)), 4) AS correlation
  FROM sums WHERE n >= 3 AND (n * sxx - sx * sx) * (n * syy - sy * sy) > 1e-6)
SELECT hydro_station_code, CAST(lag AS INTEGER) AS best_lag_hours, correlation, n AS n_pairs
FROM scored QUALIFY row_number() OVER (PARTITION BY hydro_station_code ORDER BY correlation DESC, lag) = 1"""
    )
    grouped = hours.replace("FROM gold", f"FROM (SELECT * REPLACE (hydro_station_code % {RESPONSE_GROUPS} AS hydro_station_code) FROM gold)")
    q["rain_response_measures"] = (
        _with(*GOLD_CTES, grouped)
        + """,
measured AS (
  SELECT h.hydro_station_code, h.timeline_ts_utc, 'level_change' AS measure, h.level - b.level AS v
  FROM per_hour h JOIN per_hour b ON b.hydro_station_code = h.hydro_station_code AND b.timeline_ts_utc = h.timeline_ts_utc - INTERVAL 1 HOUR
  UNION ALL
  SELECT hydro_station_code, timeline_ts_utc, 'discharge', discharge FROM per_hour),
pairs AS (
  SELECT r.hydro_station_code, measure, date_diff('hour', r.timeline_ts_utc, l.timeline_ts_utc) AS lag, CAST(r.rain AS DOUBLE) AS x, CAST(l.v AS DOUBLE) AS y
  FROM per_hour r JOIN measured l ON r.hydro_station_code = l.hydro_station_code AND r.rain IS NOT NULL AND l.v IS NOT NULL
    AND l.timeline_ts_utc BETWEEN r.timeline_ts_utc AND r.timeline_ts_utc + INTERVAL 72 HOUR),
by_lag AS (
  SELECT hydro_station_code, measure, lag, count(*) AS n, round(corr(x, y), 4) AS correlation
  FROM pairs GROUP BY 1, 2, 3 HAVING count(*) >= 3 AND var_pop(x) > 0 AND var_pop(y) > 0)
SELECT hydro_station_code, measure, CAST(lag AS INTEGER) AS best_lag_hours, correlation, n AS n_pairs
FROM by_lag QUALIFY row_number() OVER (PARTITION BY hydro_station_code, measure ORDER BY correlation DESC, lag) = 1"""
    )
    q["rain_events"] = (
        _with(*GOLD_CTES, hours)
        + """,
wet AS (
  SELECT *, timeline_ts_utc - lag(timeline_ts_utc) OVER (PARTITION BY hydro_station_code ORDER BY timeline_ts_utc) AS dry
  FROM per_hour WHERE rain > 0),
islands AS (
  SELECT *, sum(CASE WHEN dry IS NULL OR dry > INTERVAL 6 HOUR THEN 1 ELSE 0 END)
    OVER (PARTITION BY hydro_station_code ORDER BY timeline_ts_utc) AS k FROM wet),
events AS (
  SELECT hydro_station_code, min(timeline_ts_utc) AS event_start, max(timeline_ts_utc) AS event_end, round(sum(rain), 4) AS rain_mm
  FROM islands GROUP BY hydro_station_code, k),
levels AS (
  SELECT e.*,
    (SELECT min(level) FROM per_hour h WHERE h.hydro_station_code = e.hydro_station_code
       AND h.timeline_ts_utc BETWEEN e.event_start - INTERVAL 6 HOUR AND e.event_start) AS base_level,
    (SELECT max(level) FROM per_hour h WHERE h.hydro_station_code = e.hydro_station_code
       AND h.timeline_ts_utc BETWEEN e.event_start AND e.event_end + INTERVAL 72 HOUR) AS peak_level
  FROM events e)
SELECT *, round(peak_level - base_level, 4) AS rise FROM levels"""
    )
    q["daily_summary"] = (
        _with(*GOLD_CTES, hours)
        + """
SELECT catchment_name, day, count(DISTINCT hydro_station_code) AS gauges,
  round((SELECT avg(s) FROM (SELECT sum(g.rain) AS s FROM per_hour g
     WHERE g.day = h.day AND g.catchment_name IS NOT DISTINCT FROM h.catchment_name GROUP BY g.hydro_station_code)), 9) AS rain_mm,
  min(level) AS level_min, round(avg(level), 9) AS level_avg, max(level) AS level_max,
  round(avg(discharge), 9) AS discharge_avg, round(avg(temp), 9) AS temp_avg
FROM per_hour h GROUP BY catchment_name, day"""
    )
    q["weather_station_names"] = (
        _with(METEO_READINGS, BRONZE_METEO, SILVER_METEO)
        + "\nSELECT DISTINCT jaam_kood AS meteo_station_code, jaam_nimi AS meteo_station_name FROM silver_meteo"
    )
    return q
