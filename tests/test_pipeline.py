"""End-to-end jobs on synthetic landing files and seed CSVs."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from catchment.operators import EmptyBatchError
from catchment.plans.bronze import PROVENANCE
from catchment.plans.jobs import Pipeline, target_date
from catchment.sources.retention import archive_landing_files
from catchment.streaming.incremental import run_ingest_stream
from tests.conftest import rows

HYDRO_HEADER = (
    "station_code,station_category,station_name,station_fullname,water_body,catchment_name,"
    "catchment_size_km2,distance_from_mouth_km,station_altitude_msl_m,latitude,longitude,is_active"
)
METEO_HEADER = "station_code,station_category,station_name,latitude,longitude,altitude_m,is_active"
GAUGES = [(101, 59.0, 24.0, "5.56"), (102, 58.0, 26.0, "-0.90"), (103, 58.5, 22.5, "")]
AS_OF = dt.datetime(2024, 10, 1)


def write_seeds(folder, altitude_101="5.56"):
    os.makedirs(folder, exist_ok=True)
    hydro = os.path.join(folder, "hydrometric_stations.csv")
    with open(hydro, "w", encoding="utf-8-sig") as f:  # with BOM
        f.write(HYDRO_HEADER + "\n")
        for code, lat, lon, alt in GAUGES:
            alt = altitude_101 if code == 101 else alt
            f.write(f"{code},monitoring,G{code},Gauge {code},,Basin,120.5,,{alt},{lat},{lon},TRUE\n")
    meteo = os.path.join(folder, "meteorological_stations.csv")
    with open(meteo, "w", encoding="utf-8") as f:
        f.write(METEO_HEADER + "\n")
        f.write("MA,synop,Alpha,59.05,24.05,10,true\n")
        f.write("MB,synop,Beta,58.1,26.1,,true\n")
        f.write("MC,synop,Gamma,58.4,22.6,3.5,true\n")
        f.write("MD,synop,Delta,59.0,24.0,1,false\n")
    return hydro, meteo


def hydro_records(day: dt.date, level_offset=0.0):
    """Hourly WL avg + WT avg of every gauge for one local day (Tallinn)."""
    out = []
    start = dt.datetime(day.year, day.month, day.day) - dt.timedelta(hours=3)  # local midnight (EEST) in UTC
    end = dt.datetime(day.year, day.month, day.day) + dt.timedelta(hours=22)  # next local midnight (EET)
    t = start
    while t < end:
        for code, lat, lon, _ in GAUGES:
            for series, v in (("WL avg", 100.0 + t.hour + level_offset), ("WT avg", 5.5)):
                out.append(
                    {
                        "jaam_kood": code,
                        "jaam_nimi": f"G{code}",
                        "jaam_taisnimi": f"Gauge {code}",
                        "valgala_nimi": "Basin",
                        "valgala_suurus_km2": 120.5,
                        "kaugus_suudmest_km": None,
                        "jaam_laiuskraad": lat,
                        "jaam_pikkuskraad": lon,
                        "veekogu_nimi": "Jõgi",
                        "timeline_ts_utc": t.strftime("%Y-%m-%dT%H:%M:%S+00:00"),
                        "timeline_ts_local": t.strftime("%Y-%m-%dT%H:%M:%S+00:00"),
                        "aegrida_nimi": series,
                        "vaartus": v,
                    }
                )
        t += dt.timedelta(hours=1)
    return out


def meteo_records(day: dt.date):
    out = []
    for code in ("MA", "MB", "MC"):
        for hour in range(24):
            base = {"jaam_kood": code, "jaam_nimi": f"Name {code}", "aasta": day.year, "kuu": day.month, "paev": day.day, "tund": hour}
            out.append({**base, "vaartus": float(hour), "element_kood": "TA", "avaandmed_ts": "2024-10-28T10:00:00+00:00"})
            out.append({**base, "vaartus": 0.1, "element_kood": "PR1H", "avaandmed_ts": "2024-10-28T10:00:00+00:00"})
    # a correction of one key, published later in the same file
    out.append({**out[0], "vaartus": -99.0, "avaandmed_ts": "2024-10-28T12:00:00+00:00"})
    return out


def land(folder, source, day, records):
    d = os.path.join(folder, f"source={source}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"{source}_{day}.json"), "w", encoding="utf-8") as f:
        json.dump(records, f, ensure_ascii=False)


@pytest.fixture(scope="module")
def world(spark, scratch):
    root = tempfile.mkdtemp(prefix="e2e-", dir=scratch)
    landing = os.path.join(root, "landing")
    day1, day2 = dt.date(2024, 10, 26), dt.date(2024, 10, 27)
    for d in (day1, day2):
        land(landing, "hydro", d, hydro_records(d))
        land(landing, "meteo", d, meteo_records(d))
    hydro_csv, meteo_csv = write_seeds(os.path.join(root, "seeds"))
    p = Pipeline(spark, os.path.join(root, "lake"), landing)
    seed = p.run_seed(hydro_csv, meteo_csv, AS_OF)
    r1 = p.run_day(day1, as_of=dt.datetime(2024, 10, 29, 6))
    r2 = p.run_day(day2, as_of=dt.datetime(2024, 10, 30, 6))
    return dict(p=p, root=root, landing=landing, seed=seed, r1=r1, r2=r2, day1=day1, day2=day2)


def test_seed_counts_and_proximity(world):
    assert world["seed"] == {"hydro_changed": 3, "meteo_changed": 4, "proximity_rows": 9}
    prox = world["p"].lake.read("ref.station_proximity")
    rank1 = {r.hydro_station_code: r.meteo_station_code for r in prox.filter("proximity_rank = 1").collect()}
    assert rank1 == {101: "MA", 102: "MB", 103: "MC"}  # inactive MD is skipped
    st = {r.station_code: r for r in world["p"].lake.read("ref.hydro_stations").collect()}
    assert st[103].station_altitude_msl_m is None and st[101].water_body is None and st[101].is_active


def test_reseed_unchanged_skips_proximity(world, spark):
    p = world["p"]
    hydro_csv, meteo_csv = write_seeds(os.path.join(world["root"], "seeds"))
    out = p.run_seed(hydro_csv, meteo_csv, AS_OF + dt.timedelta(days=1))
    assert out == {"hydro_changed": 0, "meteo_changed": 0, "proximity_rows": 0}


def test_bronze_is_unique_and_day_spans_two_utc_partitions(world):
    bh = world["p"].lake.read("bronze.hydro")
    assert bh.groupBy("jaam_kood", "timeline_ts_utc", "aegrida_nimi").count().filter("count > 1").isEmpty()
    # local day 2024-10-27 (25 hours, autumn fold) spans UTC 10-26 and 10-27
    assert bh.count() == (24 + 25) * 3 * 2
    days = sorted(r[0] for r in bh.select("dt").distinct().collect())
    assert days == [dt.date(2024, 10, 25), dt.date(2024, 10, 26), dt.date(2024, 10, 27)]


def test_meteo_correction_wins(world):
    bm = world["p"].lake.read("bronze.meteo")
    r = bm.filter("jaam_kood = 'MA' AND paev = 26 AND tund = 0 AND element_kood = 'TA'").collect()
    assert [x.vaartus for x in r] == [-99]
    assert bm.count() == 2 * 3 * 24 * 2


def test_gold_rows_levels_and_weather(world):
    gold = world["p"].lake.read("gold.hydro_meteo")
    assert gold.count() == (24 + 25) * 3  # one row per gauge and hour
    g = {(r.hydro_station_code, r.timeline_ts_utc.replace(tzinfo=None)): r for r in gold.collect()}
    r = g[(101, dt.datetime(2024, 10, 26, 9))]
    assert float(r.wl_avg) == 109.0 and float(r.wl_avg_corrected) == pytest.approx(114.56)
    assert r.meteo_station_code == "MA" and r.meteo_station_name == "Name MA"
    assert float(r.air_temp_avg) == 12.0  # 09:00Z = 12:00 local (EEST)
    assert r.observation_ts_local == dt.datetime(2024, 10, 26, 12)
    # autumn fold: local 03:00 maps to the standard-time instant 01:00Z only
    assert float(g[(101, dt.datetime(2024, 10, 27, 1))].air_temp_avg) == 3.0
    assert g[(101, dt.datetime(2024, 10, 27, 0))].air_temp_avg is None
    # gauge without altitude: corrected == raw
    r3 = g[(103, dt.datetime(2024, 10, 26, 9))]
    assert r3.station_altitude_msl_m is None and r3.wl_avg_corrected == r3.wl_avg


def test_replay_is_idempotent(world):
    p = world["p"]
    cols = [c for c in p.lake.read("bronze.hydro").columns if c not in ("loaded_at", *PROVENANCE)]
    before = sorted(map(tuple, p.lake.read("bronze.hydro").select(*cols).collect()))
    gold_before = p.lake.read("gold.hydro_meteo").count()
    p.run_day(world["day1"], as_of=dt.datetime(2024, 11, 1, 6))
    after = sorted(map(tuple, p.lake.read("bronze.hydro").select(*cols).collect()))
    assert before == after
    assert p.lake.read("gold.hydro_meteo").count() == gold_before


def test_empty_batch_fails_and_is_logged(world):
    p = world["p"]
    with pytest.raises(EmptyBatchError):
        p.run_day(dt.date(2024, 10, 28))
    state = p.log.state()
    errors = state.filter("status = 'error'").collect()
    assert any("empty batch" in (r.error_message or "") for r in errors)
    ok = state.filter("status = 'success' AND rows_loaded IS NOT NULL").count()
    assert ok >= 4


def test_station_change_is_point_in_time(world, spark):
    """Altitude of 101 changes at T; readings before T keep the old value."""
    p = world["p"]
    hydro_csv, meteo_csv = write_seeds(os.path.join(world["root"], "seeds2"), altitude_101="6.00")
    T = dt.datetime(2024, 10, 27, 12)
    assert p.load_stations("hydro", hydro_csv, T) == 1
    p.snapshot(T)
    p.build_silver()
    p.build_gold()
    gold = {(r.hydro_station_code, r.timeline_ts_utc): r for r in p.lake.read("gold.hydro_meteo").filter("hydro_station_code = 101").collect()}
    before = gold[(101, dt.datetime(2024, 10, 27, 11))]
    after = gold[(101, dt.datetime(2024, 10, 27, 12))]
    assert float(before.station_altitude_msl_m) == pytest.approx(5.56)
    assert float(after.station_altitude_msl_m) == pytest.approx(6.0)
    hist = p.lake.read("snapshots.snap_hydro_stations").filter("station_code = 101")
    assert hist.count() == 2


def test_stream_equals_batch(world, spark, scratch):
    root = tempfile.mkdtemp(prefix="stream-", dir=scratch)
    p = Pipeline(spark, os.path.join(root, "lake"), world["landing"])
    run_ingest_stream(p, "hydro", checkpoint=os.path.join(root, "ckpt_h"), max_files_per_trigger=1)
    run_ingest_stream(p, "meteo", checkpoint=os.path.join(root, "ckpt_m"))
    for name in ("bronze.hydro", "bronze.meteo"):
        a = p.lake.read(name)
        b = world["p"].lake.read(name)
        cols = [c for c in a.columns if c not in ("loaded_at", *PROVENANCE)]
        assert sorted(map(tuple, a.select(*cols).collect())) == sorted(map(tuple, b.select(*cols).collect()))
    # a second trigger finds no new files and changes nothing
    n = p.lake.read("bronze.hydro").count()
    run_ingest_stream(p, "hydro", checkpoint=os.path.join(root, "ckpt_h"))
    assert p.lake.read("bronze.hydro").count() == n


def test_backfill_range_equals_day_by_day(world, spark, scratch):
    root = tempfile.mkdtemp(prefix="range-", dir=scratch)
    p = Pipeline(spark, os.path.join(root, "lake"), world["landing"])
    p.run_seed(*write_seeds(os.path.join(root, "seeds")), AS_OF)
    p.run_range(world["day1"], world["day2"], as_of=dt.datetime(2024, 10, 30, 6))
    cols = [c for c in p.lake.read("bronze.meteo").columns if c not in ("loaded_at", *PROVENANCE)]
    a = sorted(map(tuple, p.lake.read("bronze.meteo").select(*cols).collect()))
    b = sorted(map(tuple, world["p"].lake.read("bronze.meteo").select(*cols).collect()))
    assert a == b
    assert p.lake.read("gold.hydro_meteo").count() == (24 + 25) * 3


def test_retention_archives_old_files(spark, scratch):
    root = tempfile.mkdtemp(prefix="ret-", dir=scratch)
    raw = os.path.join(root, "raw_hydro")
    os.makedirs(raw)
    today = dt.date(2026, 5, 20)
    names = {
        f"hydro_{today - dt.timedelta(days=7)}.json": "skipped",
        f"hydro_{today - dt.timedelta(days=8)}.json": "archived",
        "hydro_2026-04-30.json": "archived",
        "x.json": "unrecognised",
        "a_b.json": "unrecognised",
        "notes.txt": None,
    }
    for n in names:
        with open(os.path.join(raw, n), "w") as f:
            f.write('[{"jaam_kood": 1}, {"jaam_kood": 2, "vaartus": 1.25}]')
    archive = os.path.join(root, "archive")
    counts = archive_landing_files(spark, {"hydro": raw}, archive, as_of=today)
    assert counts == {"archived": 2, "skipped": 1, "unrecognised": 2}
    left = sorted(os.listdir(raw))
    assert f"hydro_{today - dt.timedelta(days=8)}.json" not in left and "notes.txt" in left and "x.json" in left
    from catchment.sources.landing import read_landing

    got = read_landing(spark, "hydro", archive).select("file_date", "jaam_kood", "vaartus").collect()
    days = [dt.date(2026, 4, 30), today - dt.timedelta(days=8)]
    assert sorted((r.file_date, r.jaam_kood, float(r.vaartus or 0)) for r in got) == sorted((d, k, v) for d in days for k, v in ((1, 0.0), (2, 1.25)))


def test_archived_day_ingests_to_the_same_bronze(spark, scratch):
    root = tempfile.mkdtemp(prefix="ret3-", dir=scratch)
    landing, day = os.path.join(root, "landing"), dt.date(2024, 5, 2)
    land(landing, "hydro", day, hydro_records(day))
    p = Pipeline(spark, os.path.join(root, "lake"), landing)
    p.ingest("hydro", [day])
    archive_landing_files(spark, {"hydro": os.path.join(landing, "source=hydro")}, os.path.join(root, "archive"), as_of=dt.date(2024, 6, 1))
    assert os.listdir(os.path.join(landing, "source=hydro")) in ([], [f".hydro_{day}.json.crc"])
    again = Pipeline(spark, os.path.join(root, "lake2"), os.path.join(root, "archive"))
    again.ingest("hydro", None)
    cols = [c for c in p.lake.read("bronze.hydro").columns if c not in ("loaded_at", *PROVENANCE)]
    assert rows(p.lake.read("bronze.hydro"), *cols) == rows(again.lake.read("bronze.hydro"), *cols)


def test_target_date():
    assert target_date(dt.date(2025, 1, 4)) == dt.date(2025, 1, 1)


def test_weather_station_with_two_names_fans_out(spark, scratch):
    from catchment.operators import key_violations

    root = tempfile.mkdtemp(prefix="names-", dir=scratch)
    landing = os.path.join(root, "landing")
    day = dt.date(2024, 3, 5)
    land(landing, "hydro", day, hydro_records(day))
    recs = meteo_records(day)
    for r in recs:
        if r["jaam_kood"] == "MA" and r["tund"] >= 12:
            r["jaam_nimi"] = "Name MA (renamed)"
    land(landing, "meteo", day, recs)
    p = Pipeline(spark, os.path.join(root, "lake"), landing)
    p.run_seed(*write_seeds(os.path.join(root, "seeds")), AS_OF)
    p.run_day(day, as_of=dt.datetime(2024, 3, 8, 6))
    gold = p.lake.read("gold.hydro_meteo")
    per_gauge = {r[0]: r[1] for r in gold.groupBy("hydro_station_code").count().collect()}
    hours = len(hydro_records(day)) // (len(GAUGES) * 2)
    assert per_gauge == {101: 2 * hours, 102: hours, 103: hours}
    names = sorted(r[0] for r in gold.filter("hydro_station_code = 101").select("meteo_station_name").distinct().collect())
    assert names == ["Name MA", "Name MA (renamed)"]
    dup = key_violations(gold, ["hydro_station_code", "timeline_ts_utc"])
    assert dup.count() == hours


def test_stream_with_build_produces_gold(world, spark, scratch):
    root = tempfile.mkdtemp(prefix="stream-build-", dir=scratch)
    p = Pipeline(spark, os.path.join(root, "lake"), world["landing"])
    p.run_seed(*write_seeds(os.path.join(root, "seeds")), AS_OF)
    p.snapshot(AS_OF)
    run_ingest_stream(p, "meteo", checkpoint=os.path.join(root, "ckpt_m"), build=True)
    run_ingest_stream(p, "hydro", checkpoint=os.path.join(root, "ckpt_h"), build=True)
    gold = p.lake.read("gold.hydro_meteo")
    assert gold.count() == (24 + 25) * 3
    assert gold.filter(F.col("air_temp_avg").isNotNull()).count() > 0


def test_sql_views_over_lake(world, spark):
    views = world["p"].register_views()
    assert "bronze_etl_log" in views
    assert spark.sql("SELECT count(*) AS n FROM bronze_etl_log WHERE status = 'success'").first().n >= 4
    assert {"bronze_hydro", "silver_meteo", "gold_hydro_meteo", "ref_station_proximity"} <= set(views)
    n = spark.sql("SELECT count(*) AS n FROM gold_hydro_meteo WHERE meteo_station_code IS NOT NULL").first().n
    assert n == world["p"].lake.read("gold.hydro_meteo").filter("meteo_station_code IS NOT NULL").count() > 0


def test_missing_required_field_and_duplicate_policies(spark, scratch):
    from catchment.operators import DuplicateKeyError, RequiredFieldError

    root = tempfile.mkdtemp(prefix="bad-", dir=scratch)
    landing = os.path.join(root, "landing")
    p = Pipeline(spark, os.path.join(root, "lake"), landing)
    day = dt.date(2024, 5, 2)
    recs = hydro_records(day)[:6]
    broken = [dict(r) for r in recs]
    del broken[2]["aegrida_nimi"]  # required key missing
    land(landing, "hydro", day, broken)
    with pytest.raises(RequiredFieldError):
        p.ingest("hydro", [day])
    assert p.lake.read("bronze.hydro") is None  # nothing written
    assert p.log.state().filter("status = 'error'").count() == 1
    # same key twice in one file: fails by default, later record wins with "last"
    dup = recs + [dict(recs[0], vaartus=-1.0)]
    land(landing, "hydro", day, dup)
    with pytest.raises(DuplicateKeyError):
        p.ingest("hydro", [day])
    res = p.ingest("hydro", [day], on_duplicate="last")
    assert res.rows_loaded == 6 and res.rows_processed == 7
    key = recs[0]
    got = (
        p.lake.read("bronze.hydro")
        .filter((F.col("jaam_kood") == key["jaam_kood"]) & (F.col("aegrida_nimi") == key["aegrida_nimi"]))
        .filter(F.col("timeline_ts_utc") == F.lit(key["timeline_ts_utc"][:19].replace("T", " ")).cast("timestamp"))
        .collect()
    )
    assert [float(r.vaartus) for r in got] == [-1.0]


def test_retention_handles_day_folders(spark, scratch):
    from catchment.sources.landing import write_landing

    root = tempfile.mkdtemp(prefix="ret2-", dir=scratch)
    landing = os.path.join(root, "landing")
    src = spark.createDataFrame([("MA", 1.0)], "jaam_kood string, vaartus double")
    for day in ("2026-04-01", "2026-05-19"):
        write_landing(src, landing, "meteo", day)
    raw_dir = os.path.join(landing, "source=meteo")
    with open(os.path.join(raw_dir, "meteo_2026-04-02.json"), "w") as f:
        f.write("[]")
    counts = archive_landing_files(spark, {"meteo": raw_dir}, os.path.join(root, "archive"), as_of=dt.date(2026, 5, 20))
    assert counts == {"archived": 2, "skipped": 1, "unrecognised": 0}
    left = [os.path.join(dp, f) for dp, _, fs in os.walk(raw_dir) for f in fs if f.endswith(".json")]
    assert len(left) == 1 and "dt=2026-05-19" in left[0]


def test_gold_keeps_gauge_hours_without_weather(spark, scratch):
    root = tempfile.mkdtemp(prefix="noweather-", dir=scratch)
    landing = os.path.join(root, "landing")
    day = dt.date(2024, 6, 3)
    land(landing, "hydro", day, hydro_records(day))
    p = Pipeline(spark, os.path.join(root, "lake"), landing)
    p.run_seed(*write_seeds(os.path.join(root, "seeds")), AS_OF)
    h = p.ingest("hydro", [day])
    p.build(h.days, as_of=dt.datetime(2024, 6, 6))
    gold = p.lake.read("gold.hydro_meteo")
    assert gold.count() == len(hydro_records(day)) // 2
    assert gold.filter("air_temp_avg IS NOT NULL OR meteo_station_name IS NOT NULL").count() == 0
    assert gold.filter("meteo_station_code = 'MA'").count() > 0  # proximity still attached


def test_incremental_build_equals_full_rebuild(world):
    p = world["p"]
    for name, frame in (("silver.hydro", p.silver_hydro_frame), ("silver.meteo", p.silver_meteo_frame), ("gold.hydro_meteo", p.gold_frame)):
        stored = p.lake.read(name)
        full = frame(None)
        cols = sorted(c for c in stored.columns)
        a = sorted(map(tuple, stored.select(*cols).collect()), key=repr)
        b = sorted(map(tuple, full.select(*cols).collect()), key=repr)
        assert a == b, name


def land_parts(folder, source, day, *parts):
    """One landed day as several JSON-lines part files, written in order."""
    d = os.path.join(folder, f"source={source}", f"dt={day}")
    os.makedirs(d, exist_ok=True)
    for i, records in enumerate(parts):
        path = os.path.join(d, f"part-{i:05d}.json")
        with open(path, "w", encoding="utf-8") as f:
            f.writelines(json.dumps(r, ensure_ascii=False) + "\n" for r in records)
        os.utime(path, (1_700_000_000 + 60 * i,) * 2)


@pytest.mark.parametrize("how", ["batch", "stream"])
def test_publication_order_holds_across_part_files(spark, scratch, how):
    root = tempfile.mkdtemp(prefix="parts-", dir=scratch)
    day = dt.date(2024, 5, 2)
    first = {**meteo_records(day)[0], "vaartus": 12.0, "avaandmed_ts": "2024-05-03T12:00:00+00:00"}
    second = {**first, "vaartus": 10.0, "avaandmed_ts": "2024-05-03T10:00:00+00:00"}
    land_parts(os.path.join(root, "landing"), "meteo", day, [first], [second])
    p = Pipeline(spark, os.path.join(root, "lake"), os.path.join(root, "landing"))
    if how == "batch":
        p.ingest("meteo", [day])
    else:
        run_ingest_stream(p, "meteo")
    assert [float(r.vaartus) for r in p.lake.read("bronze.meteo").collect()] == [12.0]


def test_duplicate_across_part_files_of_a_day_fails(spark, scratch):
    from catchment.operators import DuplicateKeyError

    root = tempfile.mkdtemp(prefix="parts2-", dir=scratch)
    day = dt.date(2024, 5, 2)
    record = hydro_records(day)[0]
    land_parts(os.path.join(root, "landing"), "hydro", day, [record], [dict(record, vaartus=-1.0)])
    p = Pipeline(spark, os.path.join(root, "lake"), os.path.join(root, "landing"))
    with pytest.raises(DuplicateKeyError):
        p.ingest("hydro", [day])
    p.ingest("hydro", [day], on_duplicate="last")
    assert [float(r.vaartus) for r in p.lake.read("bronze.hydro").collect()] == [-1.0]


def test_daily_build_equals_full_build_after_reference_changes(spark, scratch):
    root = tempfile.mkdtemp(prefix="change-", dir=scratch)
    landing = os.path.join(root, "landing")
    days = [dt.date(2024, 6, 2), dt.date(2024, 6, 10)]
    for i, d in enumerate(days):
        land(landing, "hydro", d, hydro_records(d))
        recs = meteo_records(d)
        if i:
            for r in recs:
                if r["jaam_kood"] == "MA":
                    r["jaam_nimi"] = "Name MA (second)"
        land(landing, "meteo", d, recs)
    p = Pipeline(spark, os.path.join(root, "lake"), landing)
    p.run_seed(*write_seeds(os.path.join(root, "seeds")), dt.datetime(2024, 7, 1))
    p.run_day(days[0], as_of=dt.datetime(2024, 7, 1, 1))
    old = {r.station_altitude_msl_m for r in p.lake.read("gold.hydro_meteo").filter("hydro_station_code = 101").collect()}
    assert {float(x) for x in old} == {5.56}
    hydro_csv, meteo_csv = write_seeds(os.path.join(root, "seeds2"), altitude_101="6.00")
    p.load_stations("hydro", hydro_csv, dt.datetime(2024, 7, 2))
    p.run_day(days[1], as_of=dt.datetime(2024, 7, 2, 1))
    gold = p.lake.read("gold.hydro_meteo")
    assert {float(r.station_altitude_msl_m) for r in gold.filter("hydro_station_code = 101").collect()} == {6.0}
    # the second name fans out the earlier day too
    early = gold.filter("hydro_station_code = 101 AND timeline_ts_utc < '2024-06-04'")
    assert {r[0] for r in early.select("meteo_station_name").distinct().collect()} == {"Name MA", "Name MA (second)"}
    cols = sorted(gold.columns)
    assert rows(gold, *cols) == rows(p.gold_frame(None), *cols)


def test_repeated_code_in_a_seed_keeps_its_last_row(spark, scratch):
    root = tempfile.mkdtemp(prefix="seed-", dir=scratch)
    hydro_csv, _ = write_seeds(os.path.join(root, "seeds"))
    with open(hydro_csv, "a", encoding="utf-8") as f:
        f.write("101,monitoring,G101 again,,,,,,7.25,59.0,24.0,TRUE\n")
    p = Pipeline(spark, os.path.join(root, "lake"), os.path.join(root, "landing"))
    assert p.load_stations("hydro", hydro_csv) == 3
    got = p.lake.read("ref.hydro_stations").filter("station_code = 101").collect()
    assert [(r.station_name, float(r.station_altitude_msl_m)) for r in got] == [("G101 again", 7.25)]


def test_range_with_a_missing_day(spark, scratch):
    root = tempfile.mkdtemp(prefix="gap-", dir=scratch)
    landing = os.path.join(root, "landing")
    for d in (dt.date(2024, 5, 2), dt.date(2024, 5, 4)):
        land(landing, "hydro", d, hydro_records(d))
        land(landing, "meteo", d, meteo_records(d))
    p = Pipeline(spark, os.path.join(root, "lake"), landing)
    with pytest.raises(EmptyBatchError, match="2024-05-03"):
        p.run_range(dt.date(2024, 5, 2), dt.date(2024, 5, 4))
    assert p.lake.read("bronze.hydro") is None
    out = p.run_range(dt.date(2024, 5, 2), dt.date(2024, 5, 4), on_missing="skip")
    assert out["missing"] == {"hydro": [dt.date(2024, 5, 3)], "meteo": [dt.date(2024, 5, 3)]}
    from catchment.plans.audit import day_coverage

    gaps = day_coverage(p.log.read(), "2024-05-01", "2024-05-04", {"hydro": "ingest_hydro", "meteo": "ingest_meteo"})
    assert rows(gaps) == [(s, dt.date(2024, 5, d)) for s in ("hydro", "meteo") for d in (1, 3)]


def test_daily_run_before_the_first_seed(spark, scratch):
    root = tempfile.mkdtemp(prefix="noseed-", dir=scratch)
    landing, day = os.path.join(root, "landing"), dt.date(2024, 5, 2)
    land(landing, "hydro", day, hydro_records(day))
    land(landing, "meteo", day, meteo_records(day))
    p = Pipeline(spark, os.path.join(root, "lake"), landing)
    p.run_day(day)
    gold = p.lake.read("gold.hydro_meteo")
    assert gold.count() == len(hydro_records(day)) // 2
    assert gold.filter("station_category IS NOT NULL OR meteo_station_code IS NOT NULL").isEmpty()


def test_lost_pointer_falls_back_to_the_newest_version(spark, scratch):
    from catchment.sources.store import Lakehouse

    lake = Lakehouse(spark, tempfile.mkdtemp(prefix="ptr-", dir=scratch))
    lake.write_version("ref.x", spark.range(2))
    newest = lake.write_version("ref.x", spark.range(5))
    os.remove(os.path.join(lake.path("ref.x"), "_CURRENT"))
    assert lake.current_version("ref.x") == newest and lake.read("ref.x").count() == 5
    assert lake.prune_versions("ref.x", dt.datetime(2999, 1, 1)) and lake.versions("ref.x") == [newest]
    os.remove(os.path.join(lake.path("ref.x"), newest, "_SUCCESS"))
    with pytest.raises(RuntimeError):
        lake.read("ref.x")


def test_run_log_keeps_the_whole_error_and_the_identity(spark, scratch):
    from catchment.plans.audit import RunLog, logged_run

    log = RunLog(spark, os.path.join(tempfile.mkdtemp(prefix="log-", dir=scratch), "log"))
    with pytest.raises(ValueError), logged_run(log, "daily", "t", dt.date(2024, 5, 2), "f.json"):
        raise ValueError("x" * 9000 + " the cause")
    r = log.state().first()
    assert r.error_message.endswith(" the cause") and len(r.error_message) > 9000
    assert (r.dag_id, r.task_id, r.target_date, r.source_file, r.status) == ("daily", "t", dt.date(2024, 5, 2), "f.json", "error")
    log.compact()
    assert log.read().count() == 2


def test_submit_settings_stay_in_force():
    import subprocess
    import sys

    code = "from catchment import get_spark; s = get_spark(); print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))"
    args = "--master local[2] --conf spark.sql.shuffle.partitions=77 --conf spark.ui.enabled=false pyspark-shell"
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], env={**os.environ, "PYSPARK_SUBMIT_ARGS": args}, cwd=here, capture_output=True, text=True, timeout=120)
    assert "GOT local[2] 77" in out.stdout


def same_as_full_build(p):
    """The stored tables equal those of a full build."""
    for name, frame in (("silver.hydro", p.silver_hydro_frame), ("silver.meteo", p.silver_meteo_frame), ("gold.hydro_meteo", p.gold_frame)):
        stored = p.lake.read(name)
        cols = sorted(stored.columns)
        assert rows(stored, *cols) == rows(frame(None), *cols), name


def gold_files(p):
    return {f.rsplit("/dt=")[1] for f in p.lake.read("gold.hydro_meteo").inputFiles()}


def test_day_left_without_a_build_reaches_gold_with_the_next_one(spark, scratch):
    root = tempfile.mkdtemp(prefix="ledger-", dir=scratch)
    landing = os.path.join(root, "landing")
    days = [dt.date(2024, 5, 1), dt.date(2024, 5, 10), dt.date(2024, 5, 20)]
    for d in days:
        land(landing, "hydro", d, hydro_records(d))
        if d != days[1]:
            land(landing, "meteo", d, meteo_records(d))
    p = Pipeline(spark, os.path.join(root, "lake"), landing)
    p.run_seed(*write_seeds(os.path.join(root, "seeds")), dt.datetime(2024, 4, 1))
    p.run_day(days[0], as_of=dt.datetime(2024, 5, 2))
    with pytest.raises(EmptyBatchError):
        p.run_day(days[1])  # its weather has not landed: hydro is in bronze, nothing is built
    assert [m.table for m in p.lake.ledger.marks()] == ["bronze.hydro"]
    before = gold_files(p)
    p.run_day(days[2], as_of=dt.datetime(2024, 5, 21))
    assert not p.lake.ledger.marks()
    built = {r.dt for r in p.lake.read("gold.hydro_meteo").select("dt").distinct().collect()}
    assert {d for d in days} <= built
    assert before < gold_files(p)  # 1 May keeps its files
    same_as_full_build(p)
    # a stream that does not build, then a day that does
    land(landing, "meteo", days[1], meteo_records(days[1]))
    run_ingest_stream(p, "meteo")
    run_ingest_stream(p, "hydro")
    assert {m.table for m in p.lake.ledger.marks()} == {"bronze.hydro", "bronze.meteo"}
    p.build([])
    assert not p.lake.ledger.marks()
    same_as_full_build(p)
    assert p.log.read().filter("task_id = 'ingest_meteo' AND target_date = '2024-05-10' AND status = 'success'").count() == 1


def test_marks_of_failed_and_running_writers(spark, scratch):
    root = tempfile.mkdtemp(prefix="marks-", dir=scratch)
    ledger = Pipeline(spark, root, root).lake.ledger
    day = dt.date(2024, 5, 1)
    with pytest.raises(ValueError), ledger.writing("bronze.hydro", [day]):
        raise ValueError("lost writer")
    [m] = ledger.marks()
    assert (m.table, m.days, m.done) == ("bronze.hydro", (day,), False)
    ledger.clear([m])
    assert ledger.marks() == [m]  # an open mark stays
    with ledger.writing("bronze.hydro", [day, dt.date(2024, 5, 2)]):
        seen = ledger.marks()
        assert sorted(x.done for x in seen) == [False, True]
    ledger.clear(seen)  # the write ended after the build had read its mark
    [m] = ledger.marks()
    assert m.done and len(m.days) == 2
    ledger.clear([m])
    assert ledger.marks() == []


def test_stream_of_split_parts_equals_one_batch(spark, scratch):
    """Parts of days in micro-batches of one file, in the worst order."""
    root = tempfile.mkdtemp(prefix="split-", dir=scratch)
    landing, d1, d2 = os.path.join(root, "landing"), dt.date(2024, 5, 2), dt.date(2024, 5, 3)
    one = {**meteo_records(d1)[0], "avaandmed_ts": "2024-05-03T12:00:00+00:00", "vaartus": 12.0}
    at = lambda t, v, **k: {**one, "avaandmed_ts": t, "vaartus": v, **k}
    tie = {"element_kood": "RH"}
    land_parts(landing, "meteo", d2, [at("2024-05-01T00:00:00+00:00", 20.0, tund=5)])  # a later landing with an early publication
    land_parts(landing, "meteo", d1, [one, at(one["avaandmed_ts"], 1.0, **tie)], [at("2024-05-03T10:00:00+00:00", 10.0), at(one["avaandmed_ts"], 2.0, **tie)],
               [at("2024-05-03T13:00:00+00:00", 13.0, tund=5), at("2024-05-03T11:00:00+00:00", 11.0)])
    h = hydro_records(d1)
    land_parts(landing, "hydro", d2, [dict(h[0], vaartus=7.0)])
    land_parts(landing, "hydro", d1, h[:3], h[3:5])
    for i, (source, d, part) in enumerate([("meteo", d2, 0), ("meteo", d1, 0), ("meteo", d1, 1), ("meteo", d1, 2), ("hydro", d2, 0), ("hydro", d1, 0), ("hydro", d1, 1)]):
        os.utime(os.path.join(landing, f"source={source}", f"dt={d}", f"part-{part:05d}.json"), (1_700_000_000 + 60 * i,) * 2)
    streamed, batch = (Pipeline(spark, os.path.join(root, x), landing) for x in ("stream", "batch"))
    for source in ("meteo", "hydro"):
        run_ingest_stream(streamed, source, max_files_per_trigger=1)
        batch.ingest(source, None)
        a, b = (p.lake.read(f"bronze.{source}").drop("loaded_at") for p in (streamed, batch))
        assert rows(a) == rows(b)
    got = {(r.tund, r.element_kood): float(r.vaartus) for r in streamed.lake.read("bronze.meteo").collect()}
    assert got == {(0, "TA"): 12.0, (5, "TA"): 20.0, (0, "RH"): 1.0}
    assert 7.0 in {float(r.vaartus) for r in streamed.lake.read("bronze.hydro").collect()}


def test_stream_catches_keys_repeated_across_micro_batches(spark, scratch):
    root = tempfile.mkdtemp(prefix="again-", dir=scratch)
    landing, d1, d2 = os.path.join(root, "landing"), dt.date(2024, 5, 2), dt.date(2024, 5, 3)
    h = hydro_records(d1)
    # the stored row is a later landing's when the repeat arrives
    land_parts(landing, "hydro", d1, h[:2])
    p = Pipeline(spark, os.path.join(root, "lake"), landing)
    run_ingest_stream(p, "hydro")
    land_parts(landing, "hydro", d2, [dict(h[0], vaartus=1.0)])
    run_ingest_stream(p, "hydro")
    land_parts(landing, "hydro", d1, h[:2], [dict(h[0], vaartus=2.0)])
    with pytest.raises(Exception, match="another file of their landing"):
        run_ingest_stream(p, "hydro")
    assert p.log.state().filter("status = 'error' AND task_id = 'ingest_hydro'").count() == 1
    m = {**meteo_records(d1)[0], "avaandmed_ts": None}
    land_parts(landing, "meteo", d1, [m], [dict(m, vaartus=3.0)])
    with pytest.raises(Exception, match="avaandmed_ts"):
        run_ingest_stream(p, "meteo", max_files_per_trigger=1)


def test_reference_change_rebuilds_only_the_days_it_reaches(spark, scratch):
    root = tempfile.mkdtemp(prefix="delta-", dir=scratch)
    landing = os.path.join(root, "landing")
    days = [dt.date(2024, 5, d) for d in (2, 10, 20)]
    for d in days:
        land(landing, "hydro", d, [r for r in hydro_records(d) if d == days[1] or r["jaam_kood"] != 103])
        land(landing, "meteo", d, meteo_records(d))
    p = Pipeline(spark, os.path.join(root, "lake"), landing)
    p.run_seed(*write_seeds(os.path.join(root, "seeds")), dt.datetime(2024, 4, 1))
    p.run_range(days[0], days[-1], as_of=dt.datetime(2024, 5, 21), on_missing="skip")
    files = gold_files(p)

    def changed():
        nonlocal files
        now = gold_files(p)
        days = {f[:10] for f in now - files}
        files = now
        same_as_full_build(p)
        return days

    # a new altitude from 10 May on: the version before it keeps its days
    hydro_csv, meteo_csv = write_seeds(os.path.join(root, "seeds2"), altitude_101="6.00")
    p.load_stations("hydro", hydro_csv, dt.datetime(2024, 5, 10, 12))
    p.build([], as_of=dt.datetime(2024, 5, 10, 12))
    assert changed() == {"2024-05-10", "2024-05-19", "2024-05-20"}
    p.build([], as_of=dt.datetime(2024, 5, 22))
    assert changed() == set()
    # gauge 103 has no altitude: its current row stands in, on the one day it has readings
    with open(hydro_csv, encoding="utf-8-sig") as f:
        text = f.read().replace("120.5,,,58.5", "120.5,,3.25,58.5")
    with open(hydro_csv, "w", encoding="utf-8-sig") as f:
        f.write(text)
    assert p.load_stations("hydro", hydro_csv, dt.datetime(2024, 6, 1)) == 1
    p.build([], as_of=dt.datetime(2024, 6, 1))
    assert changed() == {"2024-05-09", "2024-05-10"}
    # the weather station next to gauge 103 moves
    with open(meteo_csv, encoding="utf-8") as f:
        text = f.read().replace("58.4,22.6", "58.41,22.6")
    with open(meteo_csv, "w", encoding="utf-8") as f:
        f.write(text)
    p.run_seed(hydro_csv, meteo_csv, dt.datetime(2024, 6, 2))
    p.build([], as_of=dt.datetime(2024, 6, 2))
    assert changed() == {"2024-05-09", "2024-05-10"}


def test_nested_old_files_are_archived_and_removed(spark, scratch):
    root = tempfile.mkdtemp(prefix="nested-", dir=scratch)
    landing, d1, d2 = os.path.join(root, "landing"), dt.date(2024, 5, 2), dt.date(2024, 5, 3)
    deep = os.path.join(landing, "source=hydro", "2024", "05")
    land(deep, "hydro", d1, hydro_records(d1)[:4])
    land_parts(deep, "hydro", d2, hydro_records(d2)[4:6], hydro_records(d2)[6:7])
    raw = {"hydro": os.path.join(landing, "source=hydro")}
    assert archive_landing_files(spark, raw, os.path.join(root, "archive"), as_of=dt.date(2024, 6, 1))["archived"] == 3
    left = [f for _, _, names in os.walk(landing) for f in names if f.endswith(".json")]
    p = Pipeline(spark, os.path.join(root, "lake"), os.path.join(root, "archive"))
    assert left == [] and p.ingest("hydro", None).rows_loaded == 7


def test_jobs_stop_on_a_broken_constraint_and_report_repeated_hours(world, spark, scratch):
    from catchment.operators import ConstraintError

    root = tempfile.mkdtemp(prefix="check-", dir=scratch)
    day = dt.date(2024, 5, 2)
    land(os.path.join(root, "landing"), "meteo", day, [{**meteo_records(day)[0], "tund": 25}])
    p = Pipeline(spark, os.path.join(root, "lake"), os.path.join(root, "landing"))
    with pytest.raises(ConstraintError, match="range tund"):
        p.ingest("meteo", [day])
    with pytest.raises(ConstraintError, match="status"):
        p.log.append(run_id="r", status="unknown")
    assert p.lake.read("bronze.meteo") is None
    report = world["p"].lake.read("gold.repeated_hours")
    gold = world["p"].lake.read("gold.hydro_meteo")
    twice = gold.groupBy("hydro_station_code", "timeline_ts_utc").count().filter("count > 1")
    assert report.filter("n_rows > 0").count() == twice.count()
    assert report.select("dt").distinct().count() == gold.select("dt").distinct().count()
