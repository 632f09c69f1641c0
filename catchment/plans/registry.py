"""Registered queries over the driver tables, one per operator group.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
match the DuckDB twin in ``oracle.py`` (instants are rendered as UTC wall
clock, decimals as doubles, for a type-stable comparison).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import corrected_level
from ..functions.timeconv import instant_to_wall, wall_to_instant
from ..operators.constraints import Constraints, violations
from ..operators.history import VALID_FROM, VALID_TO, as_of_join, point_in_time_join, scd2_apply
from ..operators.keyed import classify_changes, latest_revision, merge_rows
from ..operators.quality import key_violations, null_violations, range_violations, set_violations, with_defaults
from ..operators.reshape import pivot_long
from ..schemas import HYDRO_KEY, HYDRO_REQUIRED, HYDRO_STATION_CHECK, METEO_KEY, METEO_RAW, METEO_STATION_CHECK, PROXIMITY_KEY, RUN_STATUSES
from ..session import checkpoint_root, configure
from ..sources.landing import filter_calendar_day, filter_local_day
from ..sources.retention import plan_retention, retention_counts
from ..sources.seeds import clean_hydro_stations, clean_meteo_stations
from . import standins as S
from .audit import day_coverage, run_state
from .bronze import prepare_batch
from .gold import gold_hydro_meteo
from .reference_tables import proximity_matrix
from .reports import daily_summary, rain_events, rain_response, rain_response_by_measure
from .silver import silver_hydro, silver_meteo

# --- fixed values of the registered checks ------------------------------
UPSERT_OLD_BEFORE = "2024-01-21"   # stored state: days before this
UPSERT_NEW_FROM = "2024-01-11"     # incoming batch: days from this (overlap = updates)
UPSERT_CORRECTION = 1000.0         # corrected value offset in the batch
SNAPSHOT_AS_OF = "2024-02-01 00:00:00"
WINDOW_DAY = "2024-01-15"
RESPONSE_GROUPS = 10             # groups of gauges in the response report
REPORT_RANGE = (5.0, 300.0)        # values that the constraint report allows
REPORT_EVENTS = ["click", "purchase", "signup"]
RETENTION_AS_OF = "2001-01-01"
COVERAGE_FROM, COVERAGE_TO = "2023-12-25", "2024-02-15"
# --------------------------------------------------------------------------


def _events(spark, d):
    return S.table(spark, d, "events")


def q_pivot_hourly_wide(spark: SparkSession, d: str) -> DataFrame:
    """AGG-1/2 generic: events per user and hour, one max column per type."""
    e = _events(spark, d).select("user_id", F.date_trunc("hour", "ts").alias("hour"), "event_type", "value")
    mapping = {"click": "max_click", "error": "max_error", "purchase": "max_purchase", "signup": "max_signup"}
    return S.to_ntz(pivot_long(e, ["user_id", "hour"], "event_type", "value", mapping))


def q_latest_revision(spark, d):
    """AGG-4 / WIN-2: latest publication per meteo key, first record on ties."""
    return S.to_ntz(S.bronze_meteo(spark, d))


def _meteo_day():
    return F.make_date("aasta", "kuu", "paev")


def q_keyed_upsert(spark, d):
    """UPS-1/2, JN-8: stored bronze state merged with a corrected batch."""
    r = S.meteo_readings(spark, d)
    old = latest_revision(r.filter(_meteo_day() < F.lit(UPSERT_OLD_BEFORE).cast("date")), METEO_KEY, "avaandmed_ts", "event_id")
    new = latest_revision(
        r.filter(_meteo_day() >= F.lit(UPSERT_NEW_FROM).cast("date")).withColumn(
            "vaartus", F.col("vaartus") + F.lit(UPSERT_CORRECTION)
        ),
        METEO_KEY,
        "avaandmed_ts",
        "event_id",
    )
    return S.to_ntz(merge_rows(old, new, METEO_KEY))


def gauges_incoming(spark, d) -> DataFrame:
    """A newer station extract: renames, altitude corrections, gauges with a
    negative balance missing, and one new gauge per nation."""
    s = S.table(spark, d, "supplier").filter(F.col("s_acctbal") >= 0)
    base = S.gauges(spark, d).join(
        s.select(F.col("s_suppkey").cast("int").alias("station_code"), "s_nationkey"), "station_code"
    )
    changed = base.select(
        "station_code",
        "station_category",
        F.when(F.col("station_code") % 11 == 0, F.concat(F.col("station_name"), F.lit(" (renamed)")))
        .otherwise(F.col("station_name"))
        .alias("station_name"),
        "station_fullname",
        "water_body",
        "catchment_name",
        "catchment_size_km2",
        "distance_from_mouth_km",
        F.when(F.col("s_nationkey") % 5 == 0, F.coalesce(F.col("station_altitude_msl_m"), F.lit(0.0)) + F.lit(0.25))
        .otherwise(F.col("station_altitude_msl_m"))
        .alias("station_altitude_msl_m"),
        "latitude",
        "longitude",
        "is_active",
    )
    w = S.weather_stations(spark, d)
    n = S.table(spark, d, "nation")
    new = n.join(w, F.concat(F.lit("M"), F.col("n_nationkey").cast("string")) == w["station_code"]).select(
        (F.col("n_nationkey") + 100000).cast("int").alias("station_code"),
        F.lit("monitoring").alias("station_category"),
        F.col("n_name").alias("station_name"),
        F.lit(None).cast("string").alias("station_fullname"),
        F.lit(None).cast("string").alias("water_body"),
        F.lit(None).cast("string").alias("catchment_name"),
        F.lit(None).cast("double").alias("catchment_size_km2"),
        F.lit(None).cast("double").alias("distance_from_mouth_km"),
        F.lit(None).cast("double").alias("station_altitude_msl_m"),
        w["latitude"],
        w["longitude"],
        F.lit(True).alias("is_active"),
    )
    return changed.unionByName(new)


def q_upsert_if_changed(spark, d):
    """UPS-3/4, FLT-3, AGG-7: classify a newer station extract per key."""
    return classify_changes(
        S.gauges(spark, d), gauges_incoming(spark, d), ["station_code"], HYDRO_STATION_CHECK, loaded_col=None
    )


def q_scd2_history(spark, d):
    """SCD-3: validity intervals from daily station extracts."""
    return S.to_ntz(S.station_history(spark, d))


def q_scd2_history_split(spark, d):
    """SCD-3, skew-split form: windows per (station, day) instead of per
    station; each day bucket holds one extract, so every version boundary
    crosses a bucket edge. Same result as ``scd2_history``."""
    return S.to_ntz(S.station_history(spark, d, bucket="day"))


def q_scd2_apply_step(spark, d):
    """SCD-1/2: one snapshot run against the current station table."""
    current = S.gauges(spark, d).select("station_code", *S.HISTORY_CHECK)
    out = scd2_apply(
        S.station_history(spark, d), current, ["station_code"], S.HISTORY_CHECK, F.to_timestamp(F.lit(SNAPSHOT_AS_OF))
    )
    return S.to_ntz(out)


def q_point_in_time(spark, d, join=point_in_time_join):
    """JN-1, JN-2, CND-2, CND-3: readings with the station version valid at
    reading time, falling back to the current station row."""
    facts = S.hydro_readings(spark, d).select("event_id", "jaam_kood", "timeline_ts_utc", "vaartus")
    hist = S.station_history(spark, d).select(
        F.col("station_code").alias("_h_code"),
        F.col("station_category").alias("_h_category"),
        F.col("station_altitude_msl_m").alias("_h_altitude"),
        VALID_FROM,
        VALID_TO,
    )
    j = join(facts, hist, "jaam_kood", "_h_code", "timeline_ts_utc")
    cur = S.gauges(spark, d).select(
        F.col("station_code").alias("_g_code"),
        F.col("station_category").alias("_g_category"),
        F.col("station_altitude_msl_m").alias("_g_altitude"),
    )
    j = j.join(cur, j["jaam_kood"] == cur["_g_code"], "left")
    alt = F.coalesce(F.col("_h_altitude"), F.col("_g_altitude"))
    return S.to_ntz(
        j.select(
            "event_id",
            "jaam_kood",
            "timeline_ts_utc",
            "vaartus",
            F.col(VALID_FROM).alias("version_from"),
            F.coalesce(F.col("_h_category"), F.col("_g_category")).alias("station_category"),
            alt.alias("station_altitude_msl_m"),
            corrected_level(F.col("vaartus"), alt).alias("value_corrected"),
        )
    )


def _proximity(spark, d, **kw):
    return proximity_matrix(S.gauges(spark, d), S.weather_stations(spark, d), **kw)


def q_point_in_time_sorted(spark, d):
    """JN-1 for long histories: the same rows by one sort per station and month."""
    return q_point_in_time(spark, d, as_of_join)


def q_stream_bronze_meteo(spark, d):
    """STM-1: readings landed as three part files a day, streamed into
    bronze in three micro-batches; bronze holds what one batch gives."""
    from ..plans.jobs import Pipeline
    from ..streaming.incremental import run_ingest_stream

    root = f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}"
    r = S.meteo_readings(spark, d)
    # milliseconds tell equal publications apart: the names of written files don't order them
    published = F.timestamp_millis(F.unix_millis("avaandmed_ts") + F.col("event_id") % 60_000)
    raw = r.withColumn("avaandmed_ts", published).select(*METEO_RAW.names, _meteo_day().alias("dt"), (F.col("event_id") % 3).alias("part"))
    files = 0
    for part in range(3):
        own = raw.filter(F.col("part") == part).drop("part").coalesce(1).sortWithinPartitions("dt")
        # one part file of each day; a micro-batch takes one part of all days
        own.write.mode("append").partitionBy("dt").option("ignoreNullFields", "false").json(f"{root}/landing/source=meteo")
        files = max(files, own.select("dt").distinct().count())
    pipeline = Pipeline(spark, f"{root}/lake", f"{root}/landing")
    run_ingest_stream(pipeline, "meteo", max_files_per_trigger=files)
    stored = pipeline.lake.read("bronze.meteo").withColumn("vaartus", F.col("vaartus").cast("double"))
    return S.to_ntz(stored.select(*METEO_RAW.names))


def q_nearest_three(spark, d):
    """PRX-1, MTH-1, WIN-1, TOP-1: three nearest active weather stations."""
    return _proximity(spark, d)


def q_proximity_upsert(spark, d):
    """UPS-5, FLT-2: active-only matrix upserted over an all-stations one;
    rows of now-inactive gauges stay."""
    old = _proximity(spark, d, active_only=False)
    new = _proximity(spark, d, active_only=True)
    return merge_rows(old, new, PROXIMITY_KEY)


def _shifted_ship_instants(spark, d) -> DataFrame:
    l_ = S.table(spark, d, "lineitem")
    return l_.select(
        "l_orderkey",
        "l_linenumber",
        (
            F.col("l_shipdate").cast("timestamp")
            + F.make_dt_interval(
                hours=(F.col("l_orderkey") % 24).cast("int"), mins=((F.col("l_linenumber") * 7) % 60).cast("int")
            )
        ).alias("instant_utc"),
    )


def q_local_wall_clock(spark, d):
    """TIM-2: instants over several years to Tallinn wall clock."""
    t = _shifted_ship_instants(spark, d)
    return S.to_ntz(t.select("*", instant_to_wall("instant_utc").alias("local_ts")))


def q_wall_to_instant(spark, d):
    """TIM-1: wall-clock hours (0..24) over several years to instants, with
    the autumn fold resolved to standard time and hour 24 rolled over."""
    l_ = S.table(spark, d, "lineitem")
    parts = l_.select(
        "l_orderkey",
        "l_linenumber",
        F.year("l_shipdate").alias("aasta"),
        F.month("l_shipdate").alias("kuu"),
        F.dayofmonth("l_shipdate").alias("paev"),
        ((F.col("l_orderkey") + F.col("l_linenumber")) % 25).cast("int").alias("tund"),
    )
    return S.to_ntz(parts.withColumn("observation_ts", wall_to_instant("aasta", "kuu", "paev", "tund")))


def q_silver_hydro(spark, d):
    """SIL-1: pivot + point-in-time station version + fallback + correction."""
    out = silver_hydro(S.bronze_hydro(spark, d), S.station_history(spark, d), S.gauges(spark, d))
    return S.to_ntz(out)


def q_silver_meteo(spark, d):
    """SIL-2: local hour -> instant, pivot of 10 elements."""
    return S.to_ntz(silver_meteo(S.bronze_meteo(spark, d)))


def gold_frame(spark, d) -> DataFrame:
    sh = silver_hydro(S.bronze_hydro(spark, d), S.station_history(spark, d), S.gauges(spark, d))
    sm = silver_meteo(S.bronze_meteo(spark, d))
    return gold_hydro_meteo(sh, sm, _proximity(spark, d), S.weather_stations(spark, d))


def q_gold_hydro_meteo(spark, d):
    """GLD-1 (flagship): gauges + nearest weather station, hour by hour."""
    return S.to_ntz(gold_frame(spark, d))


def q_rain_response(spark, d):
    """RPT-1: the lag at which a gauge's level follows rain best."""
    return rain_response(gold_frame(spark, d))


def q_rain_response_measures(spark, d):
    """RPT-1: the lag at which level change and discharge follow rain best, for
    ten groups of gauges: one stand-in gauge rarely has two hours in a row."""
    grouped = gold_frame(spark, d).withColumn("hydro_station_code", F.col("hydro_station_code") % RESPONSE_GROUPS)
    return rain_response_by_measure(grouped)


def q_rain_events(spark, d):
    """RPT-2: rain events and the level's rise after them."""
    return S.to_ntz(rain_events(gold_frame(spark, d)))


def q_daily_summary(spark, d):
    """RPT-3: rain, level, discharge and temperature per catchment and day."""
    return daily_summary(gold_frame(spark, d))


def q_day_window_hydro(spark, d):
    """SRC-4: one local day of hydro readings (half-open window)."""
    return S.to_ntz(filter_local_day(S.hydro_readings(spark, d), WINDOW_DAY))


def q_day_window_meteo(spark, d):
    """SRC-5: one calendar day of meteo readings."""
    return S.to_ntz(filter_calendar_day(S.meteo_readings(spark, d), WINDOW_DAY))


def seed_text(spark, d) -> DataFrame:
    """Station seed cells as text (empty cells, padded and mixed-case flags)."""
    g = S.gauges(spark, d)
    s = S.table(spark, d, "supplier").select(F.col("s_suppkey").cast("int").alias("station_code"), "s_nationkey")
    g = g.join(s, "station_code")
    txt = lambda c, fmt: F.when(F.col(c).isNull(), F.lit("")).otherwise(F.format_string(fmt, F.col(c)))
    flag = (
        F.when(F.col("s_nationkey") % 4 == 0, F.lit(" TRUE "))
        .when(F.col("s_nationkey") % 4 == 1, F.lit("true"))
        .when(F.col("s_nationkey") % 4 == 2, F.lit("False"))
        .otherwise(F.lit("yes"))
    )
    return g.select(
        F.col("station_code").cast("string").alias("station_code"),
        "station_category",
        "station_name",
        F.coalesce(F.col("station_fullname"), F.lit("")).alias("station_fullname"),
        F.coalesce(F.col("water_body"), F.lit("")).alias("water_body"),
        F.coalesce(F.col("catchment_name"), F.lit("")).alias("catchment_name"),
        F.when(F.col("s_nationkey") % 3 == 0, F.lit("")).otherwise(txt("catchment_size_km2", "%.1f")).alias(
            "catchment_size_km2"
        ),
        txt("distance_from_mouth_km", "%.2f").alias("distance_from_mouth_km"),
        txt("station_altitude_msl_m", "%.2f").alias("station_altitude_msl_m"),
        txt("latitude", "%.2f").alias("latitude"),
        txt("longitude", "%.2f").alias("longitude"),
        flag.alias("is_active"),
    )


def q_seed_cleaning(spark, d):
    """SRC-8/9, STR-1..3: typing of text seed cells."""
    out = clean_hydro_stations(seed_text(spark, d))
    return out.select(
        *[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name) for f in out.schema.fields]
    )


def raw_hydro_records(spark, d) -> DataFrame:
    """Raw hydro records where the payload key ``k`` marks missing fields."""
    e = _events(spark, d)
    k = F.get_json_object("props", "$.k").cast("int")
    r = S.hydro_readings(spark, d).join(e.select("event_id", k.alias("_k")), "event_id")
    return r.select(
        "event_id",
        F.when(F.col("_k") >= 97, F.lit(None).cast("int")).otherwise(F.col("jaam_kood")).alias("jaam_kood"),
        F.when(F.col("_k") == 50, F.lit(None).cast("timestamp")).otherwise(F.col("timeline_ts_utc")).alias("timeline_ts_utc"),
        F.when(F.col("_k") <= 2, F.lit(None).cast("string")).otherwise(F.col("aegrida_nimi")).alias("aegrida_nimi"),
        "vaartus",
    )


def q_required_fields(spark, d):
    """SRC-3, DQ-2: one row per record and missing required field."""
    return null_violations(raw_hydro_records(spark, d), HYDRO_REQUIRED, ["event_id"])


def q_unique_violations(spark, d):
    """DQ-1: keys held by more than one row (lineitem order/line)."""
    return key_violations(S.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_hourly_duplicates(spark, d):
    """DQ-6: gold rows breaking 'one row per gauge and hour'."""
    return S.to_ntz(key_violations(gold_frame(spark, d), ["hydro_station_code", "timeline_ts_utc"]))


def run_events(spark, d) -> DataFrame:
    """Run-log events: run = user, status from event type."""
    e = _events(spark, d)
    status = S.case_map("event_type", S.EVENT_RUN_STATUS)
    return e.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        # whole days: many events of equal time, ordered by seq
        F.date_trunc("day", F.col("ts")).cast("timestamp").alias("event_time"),
        "event_id",
        status.alias("status"),
        F.col("event_id").cast("int").alias("seq"),
        F.when(F.col("user_id") % 3 != 0, F.lit("daily_load")).alias("dag_id"),
        F.when(F.col("user_id") % 2 == 0, F.lit("ingest_hydro")).otherwise(F.lit("ingest_meteo")).alias("task_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("user_id") % 40).cast("int")).alias("target_date"),
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("file-"), F.col("event_id").cast("string"))).alias("source_file"),
        F.when(status == "success", F.floor(F.col("value") * 9).cast("bigint")).alias("rows_deduplicated"),
        F.when(status == "success", F.floor(F.col("value") * 10).cast("bigint")).alias("rows_processed"),
        F.when(status == "success", F.floor(F.col("value")).cast("bigint")).alias("rows_loaded"),
        F.when(status == "error", F.concat(F.lit("failed: "), F.col("event_id").cast("string"))).alias("error_message"),
    )


def q_domain_violations(spark, d):
    """DQ-3/4: status outside the allowed set; proximity rank outside 1..3."""
    bad_status = set_violations(run_events(spark, d), "status", RUN_STATUSES).select(
        F.lit("status").alias("rule"), F.col("event_id").cast("string").alias("subject"), F.col("status").alias("value")
    )
    bad_rank = range_violations(_proximity(spark, d, k=4), "proximity_rank", 1, 3).select(
        F.lit("proximity_rank").alias("rule"),
        F.col("hydro_station_code").cast("string").alias("subject"),
        F.col("proximity_rank").cast("string").alias("value"),
    )
    return bad_status.unionByName(bad_rank)


def q_constraint_report(spark, d):
    """DQ-1..4, DQ-6: every broken rule of the raw weather readings in one scan."""
    rules = Constraints(
        METEO_KEY, required=["jaam_kood", "element_kood", "avaandmed_ts"], ranges={"vaartus": REPORT_RANGE}, allowed={"element_nimi_eng": REPORT_EVENTS}
    )
    return violations(S.meteo_readings(spark, d), rules)


def q_audit_state(spark, d):
    """AUD-3, AGG-5: current state per run from appended run events."""
    return S.to_ntz(run_state(run_events(spark, d)))


def q_day_coverage(spark, d):
    """AUD-4: days of a range without a successful load, per source."""
    return day_coverage(run_events(spark, d), COVERAGE_FROM, COVERAGE_TO, {"hydro": "ingest_hydro", "meteo": "ingest_meteo"})


def _in_parts(readings: DataFrame, day: Column) -> DataFrame:
    """Readings as a landing area holds them: every day in three part files
    and some records landed again a day later."""
    part = F.col("event_id") % 3
    return readings.select(
        "*",
        F.concat(F.lit("part-"), part.cast("string"), F.lit(".json")).alias("source_file"),
        F.lit(0).cast("bigint").alias("file_offset"),
        F.col("event_id").alias("record_pos"),
        F.date_add(day, (F.col("event_id") % 2).cast("int")).alias("file_date"),
        F.lit("dt").alias("landing_unit"),
        F.lit(None).cast("timestamp").alias("relanded_at"),
    )


def q_ingest_hydro_multipart(spark, d):
    """SRC-1, UPS-1, UPS-6: days landed in several part files, collapsed to
    one row per key (the later record of the later day stays)."""
    r = S.hydro_readings(spark, d)
    out = prepare_batch("hydro", _in_parts(r, F.to_date("published_ts")), "last")
    return S.to_ntz(out.select(*r.columns).drop("published_ts"))


def q_ingest_meteo_multipart(spark, d):
    """SRC-2, AGG-4, UPS-2: days landed in several part files; the latest
    publication wins in whichever part it stands."""
    r = S.meteo_readings(spark, d)
    return S.to_ntz(prepare_batch("meteo", _in_parts(r, _meteo_day())).select(*r.columns))


def q_keyed_upsert_hydro(spark, d):
    """UPS-1: stored gauge readings merged with a corrected batch."""
    rows = S.bronze_hydro(spark, d)
    at = F.col("timeline_ts_utc")
    old = rows.filter(at < F.lit(UPSERT_OLD_BEFORE).cast("timestamp"))
    new = rows.filter(at >= F.lit(UPSERT_NEW_FROM).cast("timestamp"))
    return S.to_ntz(merge_rows(old, new.withColumn("vaartus", F.col("vaartus") + F.lit(UPSERT_CORRECTION)), HYDRO_KEY))


def weather_incoming(spark, d) -> DataFrame:
    """A newer weather station extract: names and altitudes changed, some
    stations missing, and one new station for each."""
    w = S.weather_stations(spark, d)
    k = F.substring("station_code", 2, 9).cast("int") % 4
    changed = w.filter(k != 3).select(
        "station_code",
        "station_category",
        F.when(k == 1, F.concat("station_name", F.lit(" (renamed)"))).otherwise(F.col("station_name")).alias("station_name"),
        "latitude",
        "longitude",
        F.when(k == 2, F.coalesce("altitude_m", F.lit(0.0)) + 1).otherwise(F.col("altitude_m")).alias("altitude_m"),
        "is_active",
    )
    return changed.unionByName(w.withColumn("station_code", F.concat(F.lit("N"), "station_code")))


def q_weather_station_changes(spark, d):
    """UPS-4: classify a newer weather station extract per key."""
    return classify_changes(
        S.weather_stations(spark, d), weather_incoming(spark, d), ["station_code"], METEO_STATION_CHECK, loaded_col=None
    )


def _two_snapshots(first: DataFrame, second: DataFrame, check: list[str]) -> DataFrame:
    start = F.lit("2023-12-01").cast("timestamp")
    return scd2_apply(scd2_apply(None, first, ["station_code"], check, start), second, ["station_code"], check, F.to_timestamp(F.lit(SNAPSHOT_AS_OF)))


def q_scd2_weather_snapshots(spark, d):
    """SCD-2: two snapshot runs over the weather stations, all check columns."""
    return S.to_ntz(_two_snapshots(S.weather_stations(spark, d), weather_incoming(spark, d), METEO_STATION_CHECK))


def q_scd2_gauge_snapshots(spark, d):
    """SCD-1: two snapshot runs over the gauges, all 11 check columns."""
    g = S.gauges(spark, d)
    k = F.col("station_code") % 3
    newer = g.withColumn("water_body", F.when(k == 1, F.concat("water_body", F.lit(" (new)"))).otherwise(F.col("water_body"))).withColumn(
        "is_active", F.when(k == 2, ~F.col("is_active")).otherwise(F.col("is_active"))
    )
    return S.to_ntz(_two_snapshots(g, newer, HYDRO_STATION_CHECK).select(*g.columns, VALID_FROM, VALID_TO))


def q_seed_cleaning_weather(spark, d):
    """SRC-9, STR-1..3: typing of weather station seed cells."""
    w = S.weather_stations(spark, d)
    k = F.substring("station_code", 2, 9).cast("int") % 3
    text = w.select(
        "station_code",
        "station_category",
        "station_name",
        F.format_string("%.2f", "latitude").alias("latitude"),
        F.format_string("%.2f", "longitude").alias("longitude"),
        F.when(F.col("altitude_m").isNull(), F.lit("")).otherwise(F.format_string("%.1f", "altitude_m")).alias("altitude_m"),
        F.when(k == 0, F.lit(" True")).when(k == 1, F.lit("true ")).otherwise(F.lit("no")).alias("is_active"),
    )
    out = clean_meteo_stations(text)
    return out.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name) for f in out.schema.fields])


def q_column_defaults(spark, d):
    """DQ-5: column defaults where a value is absent."""
    g = S.gauges(spark, d).select("station_code", F.when(F.col("station_code") % 4 != 0, F.col("is_active")).alias("is_active"))
    return S.to_ntz(with_defaults(g, {"is_active": F.lit(True), "loaded_at": F.to_timestamp(F.lit(SNAPSHOT_AS_OF))}))


def q_gold_after_reference_change(spark, d):
    """SNP -> SIL-1 -> GLD-1: gold once a snapshot run has versioned changed
    station parameters: readings before it keep the old version."""
    current = S.gauges(spark, d).select("station_code", *S.HISTORY_CHECK)
    hist = scd2_apply(
        S.station_history(spark, d), current, ["station_code"], S.HISTORY_CHECK, F.to_timestamp(F.lit(SNAPSHOT_AS_OF))
    )
    sh = silver_hydro(S.bronze_hydro(spark, d), hist, S.gauges(spark, d))
    sm = silver_meteo(S.bronze_meteo(spark, d))
    return S.to_ntz(gold_hydro_meteo(sh, sm, _proximity(spark, d), S.weather_stations(spark, d)))


def landed_files(spark, d) -> DataFrame:
    """Raw file names as a landing area would list them (one per order date
    and status; pending orders give unparsable names, low-priority ones a
    non-JSON suffix)."""
    o = S.table(spark, d, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    source = F.when(F.col("o_orderstatus") == "F", F.lit("hydro")).otherwise(F.lit("meteo"))
    suffix = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(".txt")).otherwise(F.lit(".json"))
    name = (
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("meteo_"), F.col("o_orderpriority"), suffix))
        .otherwise(F.concat(source, F.lit("_"), day, suffix))
    )
    return o.select(source.alias("source"), name.alias("file_name")).distinct()


def q_retention_split(spark, d):
    """RET-1, FLT-5, TIM-7/8: archived / skipped / unrecognised per file."""
    return plan_retention(landed_files(spark, d), RETENTION_AS_OF)


def q_retention_counts(spark, d):
    """RET-1 counters."""
    return retention_counts(plan_retention(landed_files(spark, d), RETENTION_AS_OF))


def q_weather_station_names(spark, d):
    """AGG-3: DISTINCT (code, name) of the weather side."""
    sm = silver_meteo(S.bronze_meteo(spark, d))
    return sm.select(F.col("jaam_kood").alias("meteo_station_code"), F.col("jaam_nimi").alias("meteo_station_name")).distinct()


def _wrap(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir.rstrip("/"))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: _wrap(fn)
    for name, fn in {
        "gold_hydro_meteo": q_gold_hydro_meteo,
        "silver_hydro": q_silver_hydro,
        "silver_meteo": q_silver_meteo,
        "pivot_hourly_wide": q_pivot_hourly_wide,
        "latest_revision": q_latest_revision,
        "keyed_upsert": q_keyed_upsert,
        "upsert_if_changed": q_upsert_if_changed,
        "scd2_history": q_scd2_history,
        "scd2_history_split": q_scd2_history_split,
        "scd2_apply_step": q_scd2_apply_step,
        "point_in_time": q_point_in_time,
        "point_in_time_sorted": q_point_in_time_sorted,
        "stream_bronze_meteo": q_stream_bronze_meteo,
        "nearest_three": q_nearest_three,
        "proximity_upsert": q_proximity_upsert,
        "local_wall_clock": q_local_wall_clock,
        "wall_to_instant": q_wall_to_instant,
        "day_window_hydro": q_day_window_hydro,
        "day_window_meteo": q_day_window_meteo,
        "seed_cleaning": q_seed_cleaning,
        "required_fields": q_required_fields,
        "unique_violations": q_unique_violations,
        "hourly_duplicates": q_hourly_duplicates,
        "domain_violations": q_domain_violations,
        "constraint_report": q_constraint_report,
        "audit_state": q_audit_state,
        "day_coverage": q_day_coverage,
        "ingest_hydro_multipart": q_ingest_hydro_multipart,
        "ingest_meteo_multipart": q_ingest_meteo_multipart,
        "keyed_upsert_hydro": q_keyed_upsert_hydro,
        "weather_station_changes": q_weather_station_changes,
        "scd2_weather_snapshots": q_scd2_weather_snapshots,
        "scd2_gauge_snapshots": q_scd2_gauge_snapshots,
        "seed_cleaning_weather": q_seed_cleaning_weather,
        "column_defaults": q_column_defaults,
        "gold_after_reference_change": q_gold_after_reference_change,
        "retention_split": q_retention_split,
        "retention_counts": q_retention_counts,
        "weather_station_names": q_weather_station_names,
        "rain_response": q_rain_response,
        "rain_response_measures": q_rain_response_measures,
        "rain_events": q_rain_events,
        "daily_summary": q_daily_summary,
    }.items()
}
