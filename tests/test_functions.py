import datetime as dt
import math

from pyspark.sql import functions as F

from catchment.functions import file_date, haversine_km, instant_to_wall, wall_to_instant
from catchment.functions.predicates import any_distinct, corrected_level, empty_to_null, text_flag


def _utc(spark, y, m, d, h):
    df = spark.createDataFrame([(y, m, d, h)], "y int, m int, d int, h int")
    return df.select(wall_to_instant("y", "m", "d", "h").cast("timestamp_ntz").alias("t")).first()["t"]


def test_wall_to_instant_winter_and_summer(spark):
    assert _utc(spark, 2024, 1, 15, 10) == dt.datetime(2024, 1, 15, 8)
    assert _utc(spark, 2024, 7, 15, 10) == dt.datetime(2024, 7, 15, 7)


def test_wall_to_instant_autumn_fold_takes_standard_time(spark):
    # 03:00-03:59 local repeats on 2024-10-27; PostgreSQL resolves to EET (+2)
    assert _utc(spark, 2024, 10, 27, 3) == dt.datetime(2024, 10, 27, 1)
    assert _utc(spark, 2024, 10, 27, 2) == dt.datetime(2024, 10, 26, 23)
    assert _utc(spark, 2024, 10, 27, 4) == dt.datetime(2024, 10, 27, 2)


def test_wall_to_instant_spring_gap_and_hour_24(spark):
    # 03:00 does not exist on 2024-03-31; resolves forward like PostgreSQL
    assert _utc(spark, 2024, 3, 31, 3) == dt.datetime(2024, 3, 31, 1)
    assert _utc(spark, 2024, 3, 31, 2) == dt.datetime(2024, 3, 31, 0)
    # hour 24 rolls over to the next day's midnight
    assert _utc(spark, 2024, 12, 31, 24) == dt.datetime(2024, 12, 31, 22)


def test_instant_to_wall(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 10, 27, 0, 30),), (dt.datetime(2024, 10, 27, 1, 30),)], "t timestamp_ntz")
    out = [r[0] for r in df.select(instant_to_wall(F.col("t").cast("timestamp"))).collect()]
    assert out == [dt.datetime(2024, 10, 27, 3, 30), dt.datetime(2024, 10, 27, 3, 30)]


def test_file_date(spark):
    names = [
        "hydro_2026-05-01.json",
        "meteo_2024-02-29.json",
        "meteo_2023-02-29.json",
        "x.json",
        "a_b.json",
        "hydro_20260501.json",
        "prefix_more_2026-05-01.json",
    ]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = dict(df.select("n", file_date("n").alias("d")).collect())
    assert got["hydro_2026-05-01.json"] == dt.date(2026, 5, 1)
    assert got["meteo_2024-02-29.json"] == dt.date(2024, 2, 29)
    assert got["meteo_2023-02-29.json"] is None
    assert got["x.json"] is None and got["a_b.json"] is None
    assert got["hydro_20260501.json"] is None
    assert got["prefix_more_2026-05-01.json"] is None


def _py_haversine(lat1, lon1, lat2, lon2):
    r = 6371.0
    p1, p2 = math.radians(lat1), math.radians(lat2)
    dp, dl = math.radians(lat2 - lat1), math.radians(lon2 - lon1)
    a = math.sin(dp / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return r * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def test_haversine_matches_python_and_never_nan(spark):
    pts = [(59.437, 24.7536, 58.3776, 26.729), (0.0, 0.0, 0.0, 180.0), (10.0, 20.0, -10.0, -160.0), (1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    for (a, b, c, d), g in zip(pts, got):
        assert not math.isnan(g)
        assert abs(g - _py_haversine(a, b, c, d)) < 1e-6


def test_predicates(spark):
    df = spark.createDataFrame(
        [(1, None, None, " TRUE ", ""), (2, 1.0, None, "false", "x"), (3, 1.0, 1.0, None, None)],
        "k int, a double, b double, flag string, txt string",
    )
    out = df.select(
        "k",
        corrected_level(F.col("a"), F.col("b")).alias("c"),
        text_flag("flag").alias("f"),
        empty_to_null("txt").alias("t"),
    ).orderBy("k").collect()
    assert [(r.c, r.f, r.t) for r in out] == [(None, True, None), (1.0, False, "x"), (2.0, False, None)]
    l_ = spark.createDataFrame([(1, None), (2, 1.0), (3, 2.0)], "k int, v double").alias("l")
    r_ = spark.createDataFrame([(1, None), (2, 1.0), (3, None)], "k int, v double").alias("r")
    j = l_.join(r_, "k").select("k", any_distinct("l", "r", ["v"]).alias("d")).orderBy("k")
    assert [r.d for r in j.collect()] == [False, False, True]


def test_sql_functions_match_column_functions(spark):
    from catchment.functions.sql import register_sql_functions

    assert set(register_sql_functions(spark)) == {"haversine_km", "raw_file_date", "local_hour_to_instant", "instant_to_local"}
    r = spark.sql(
        "SELECT haversine_km(59.437, 24.7536, 58.3776, 26.729) AS d, raw_file_date('meteo_2024-02-29.json') AS f, "
        "raw_file_date('x.json') AS g, CAST(local_hour_to_instant(2024, 10, 27, 3) AS TIMESTAMP_NTZ) AS t, "
        "CAST(local_hour_to_instant(2024, 12, 31, 24) AS TIMESTAMP_NTZ) AS u, "
        "instant_to_local(TIMESTAMP '2024-07-01 09:00:00') AS l"
    ).first()
    assert abs(r.d - _py_haversine(59.437, 24.7536, 58.3776, 26.729)) < 1e-9
    assert r.f == dt.date(2024, 2, 29) and r.g is None
    assert r.t == dt.datetime(2024, 10, 27, 1) and r.u == dt.datetime(2024, 12, 31, 22)
    assert r.l == dt.datetime(2024, 7, 1, 12)
