"""Property tests: upsert idempotence and key uniqueness, SCD2 intervals
contiguous and faithful to the extracts, landing round trip."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catchment.operators import duplicate_keys, merge_rows, scd2_from_extracts
from catchment.sources.landing import read_landing, write_landing
from tests.conftest import rows

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
T0 = dt.datetime(2024, 1, 1)

keyed_rows = st.lists(
    st.tuples(st.integers(0, 6), st.one_of(st.none(), st.integers(-5, 5))), min_size=0, max_size=12
).map(lambda xs: list({k: (k, v) for k, v in xs}.values()))  # unique keys


@SETTINGS
@given(old=keyed_rows, new=keyed_rows)
def test_merge_is_idempotent_and_keeps_keys_unique(spark, old, new):
    schema = "k int, v int"
    o = spark.createDataFrame(old, schema)
    n = spark.createDataFrame(new, schema)
    once = merge_rows(o, n, ["k"])
    assert duplicate_keys(once, ["k"]).isEmpty()
    assert rows(merge_rows(once, n, ["k"])) == rows(once)
    # every new row is present as sent; old rows survive only where not replaced
    got = dict(rows(once))
    assert all(got[k] == v for k, v in new)
    new_keys = {k for k, _ in new}
    assert all(got[k] == v for k, v in old if k not in new_keys)


extract_series = st.lists(
    st.tuples(st.integers(0, 2), st.one_of(st.none(), st.sampled_from(["a", "b"]))), min_size=1, max_size=10
)


@SETTINGS
@given(series=st.lists(extract_series, min_size=1, max_size=3))
def test_scd2_history_is_contiguous_and_faithful(spark, series):
    data = []
    for key, values in enumerate(series):
        for i, (_, v) in enumerate(values):
            data.append((key, T0 + dt.timedelta(days=i), v))
    df = spark.createDataFrame(data, "key int, ts timestamp_ntz, v string").withColumn("ts", F.col("ts").cast("timestamp"))
    hist = scd2_from_extracts(df, ["key"], ["v"], "ts").select(
        "key", "v", F.col("valid_from").cast("timestamp_ntz").alias("f"), F.col("valid_to").cast("timestamp_ntz").alias("t")
    )
    by_key = {}
    for r in hist.collect():
        by_key.setdefault(r.key, []).append((r.f, r.t, r.v))
    end = dt.datetime(9999, 12, 31)
    for key, values in enumerate(series):
        versions = sorted(by_key[key])
        # contiguous: each version ends where the next starts, last is open
        assert all(a[1] == b[0] for a, b in zip(versions, versions[1:]))
        assert versions[-1][1] == end and versions[0][0] == T0
        # consecutive versions differ (NULL-safe), and each extract is covered
        assert all(a[2] != b[2] for a, b in zip(versions, versions[1:]))
        for i, (_, v) in enumerate(values):
            t = T0 + dt.timedelta(days=i)
            (match,) = [x for x in versions if x[0] <= t < x[1]]
            assert match[2] == v


def test_landing_round_trip(spark, scratch):
    import tempfile

    root = tempfile.mkdtemp(prefix="landing-", dir=scratch)
    src = spark.createDataFrame(
        [("MA", "Ä name", 2024, 1, 2, 24, 1.5, "TA", None, None, dt.datetime(2024, 1, 3, 8))],
        "jaam_kood string, jaam_nimi string, aasta int, kuu int, paev int, tund int, vaartus double, "
        "element_kood string, element_nimi_eng string, element_yhik_eng string, avaandmed_ts timestamp",
    )
    write_landing(src, root, "meteo", "2024-01-02")
    write_landing(src.withColumn("vaartus", F.lit(2.5)), root, "meteo", "2024-01-02")  # rerun replaces
    back = read_landing(spark, "meteo", f"{root}/source=meteo")
    got = back.collect()
    assert len(got) == 1
    r = got[0]
    assert (r.jaam_nimi, r.tund, float(r.vaartus), r.file_date) == ("Ä name", 24, 2.5, dt.date(2024, 1, 2))
    assert r.element_nimi_eng is None


@SETTINGS
@given(series=st.lists(extract_series, min_size=1, max_size=3), spacing=st.sampled_from([1, 9, 40]))
def test_scd2_bucketed_equals_simple(spark, series, spacing):
    data = []
    for key, values in enumerate(series):
        for i, (_, v) in enumerate(values):
            data.append((key, T0 + dt.timedelta(days=i * spacing), v))
    df = spark.createDataFrame(data, "key int, ts timestamp_ntz, v string").withColumn("ts", F.col("ts").cast("timestamp"))
    simple = scd2_from_extracts(df, ["key"], ["v"], "ts")
    bucketed = scd2_from_extracts(df, ["key"], ["v"], "ts", bucket="month")
    assert rows(bucketed) == rows(simple)


def test_landing_reads_raw_arrays_next_to_day_folders(spark, scratch):
    """A raw array file beside dt=<day> folders must not be skipped."""
    import json
    import os
    import tempfile

    root = tempfile.mkdtemp(prefix="mixed-", dir=scratch)
    rec = {"jaam_kood": "MA", "jaam_nimi": "A", "aasta": 2024, "kuu": 1, "paev": 2, "tund": 3, "vaartus": 1.0,
           "element_kood": "TA", "avaandmed_ts": "2024-01-03T00:00:00+00:00"}
    os.makedirs(f"{root}/source=meteo")
    with open(f"{root}/source=meteo/meteo_2024-01-02.json", "w") as f:
        json.dump([rec], f)
    src = spark.createDataFrame(
        [("MA", "B", 2024, 1, 3, 4, 2.0, "TA", None, None, dt.datetime(2024, 1, 4))],
        "jaam_kood string, jaam_nimi string, aasta int, kuu int, paev int, tund int, vaartus double, "
        "element_kood string, element_nimi_eng string, element_yhik_eng string, avaandmed_ts timestamp",
    )
    write_landing(src, root, "meteo", "2024-01-03")
    got = sorted((r.jaam_nimi, r.file_date) for r in read_landing(spark, "meteo", f"{root}/source=meteo").collect())
    assert got == [("A", dt.date(2024, 1, 2)), ("B", dt.date(2024, 1, 3))]


def test_many_day_write_is_one_file_per_day(spark, scratch):
    """Rebalance by day: a multi-day write does not produce tasks x days files."""
    import glob
    import tempfile

    from catchment.sources.landing import write_landing_days

    root = tempfile.mkdtemp(prefix="files-", dir=scratch)
    df = spark.range(0, 3000, numPartitions=6).select(
        (F.lit(dt.date(2024, 1, 1)) + (F.col("id") % 20).cast("int")).alias("day"), F.col("id").alias("v")
    )
    write_landing_days(df, root, "meteo", "day")
    per_day = [len(glob.glob(f"{d}/*.json")) for d in glob.glob(f"{root}/source=meteo/dt=*")]
    assert len(per_day) == 20 and set(per_day) == {1}
