import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from catchment.operators import (
    ConstraintError,
    Constraints,
    DuplicateKeyError,
    EmptyBatchError,
    RequiredFieldError,
    assert_unique,
    changed_count,
    classify_changes,
    key_violations,
    latest_revision,
    melt_wide,
    merge_rows,
    nearest_k,
    null_violations,
    pivot_long,
    as_of_join,
    enforce,
    violations,
    point_in_time_join,
    range_violations,
    require_fields,
    require_non_empty,
    scd2_apply,
    scd2_from_extracts,
    set_violations,
    with_defaults,
)
from catchment.schemas import HYDRO_SERIES, OPEN_END
from tests.conftest import rows, srt

T0 = dt.datetime(2024, 1, 1, 0, 0)


def h(n):
    return T0 + dt.timedelta(hours=n)


# ---------------------------------------------------------------- pivot
def test_pivot_missing_series_and_unknown_series(spark):
    data = [
        (1, h(0), "WL avg", 10.0),
        (1, h(0), "WT max", 3.0),
        (1, h(1), "Äravool min", 0.5),
        (2, h(0), "mystery", 99.0),  # outside the dictionary: row stays, all NULL
        (1, h(0), "WL avg", 12.0),  # duplicate -> max
    ]
    df = spark.createDataFrame(data, "st int, ts timestamp_ntz, series string, v double")
    out = pivot_long(df, ["st", "ts"], "series", "v", HYDRO_SERIES)
    got = {(r.st, r.ts): r for r in out.collect()}
    assert len(got) == 3
    assert got[(1, h(0))].wl_avg == 12.0 and got[(1, h(0))].wt_max == 3.0 and got[(1, h(0))].wl_min is None
    assert got[(1, h(1))].discharge_min == 0.5
    assert all(got[(2, h(0))][c] is None for c in HYDRO_SERIES.values())
    assert out.columns == ["st", "ts", *HYDRO_SERIES.values()]


def test_pivot_then_melt_is_identity(spark):
    random.seed(7)
    data = {(s, i, name): float(random.randint(0, 100)) for s in range(3) for i in range(5) for name in HYDRO_SERIES if random.random() < 0.6}
    df = spark.createDataFrame([(k[0], h(k[1]), k[2], v) for k, v in data.items()], "st int, ts timestamp_ntz, series string, v double")
    back = melt_wide(pivot_long(df, ["st", "ts"], "series", "v", HYDRO_SERIES), ["st", "ts"], HYDRO_SERIES, "series", "v")
    assert rows(back) == rows(df)


# ---------------------------------------------------------------- keyed
def test_latest_revision_later_wins_tie_keeps_first_null_loses(spark):
    data = [
        ("A", 1, T0, 1.0, 0),
        ("A", 1, h(1), 2.0, 1),  # later publication wins
        ("B", 1, h(1), 3.0, 0),  # tie: first record stays
        ("B", 1, h(1), 4.0, 1),
        ("C", 1, None, 5.0, 0),  # NULL version loses
        ("C", 1, T0, 6.0, 1),
        ("D", 1, h(2), 7.0, 0),  # earlier record with later time still wins
        ("D", 1, h(1), 8.0, 1),
    ]
    df = spark.createDataFrame(data, "k string, e int, pub timestamp_ntz, v double, pos int")
    out = latest_revision(df, ["k", "e"], "pub", "pos")
    assert rows(out, "k", "v") == [("A", 2.0), ("B", 3.0), ("C", 6.0), ("D", 7.0)]


def test_latest_revision_plan_prelimits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = latest_revision(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    # Partial group limit before the exchange keeps hot keys from one task.
    assert "WindowGroupLimit" in plan


def test_assert_unique_policies(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (2, "c", 2)], "k int, v string, pos int")
    with pytest.raises(DuplicateKeyError):
        assert_unique(df, ["k"])
    assert rows(assert_unique(df, ["k"], policy="last", position="pos"), "k", "v") == [(1, "b"), (2, "c")]
    ok = df.filter("k = 2")
    assert assert_unique(ok, ["k"]) is ok


def test_merge_rows_replaces_inserts_keeps_and_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)], "k int, n string, v double")
    new = spark.createDataFrame([(2, "B", None), (4, "d", 4.0)], "k int, n string, v double")
    once = merge_rows(old, new, ["k"])
    assert rows(once) == srt([(1, "a", 1.0), (2, "B", None), (3, "c", 3.0), (4, "d", 4.0)])
    assert rows(merge_rows(once, new, ["k"])) == rows(once)


def test_classify_changes_counts(spark):
    cols = "code int, name string, alt double, loaded_at timestamp_ntz"
    cur = spark.createDataFrame(
        [(1, "same", 1.0, T0), (2, "old", 1.0, T0), (3, "x", None, T0), (5, "missing", 1.0, T0)], cols
    )
    inc = spark.createDataFrame([(1, "same", 1.0), (2, "new", 1.0), (3, "x", 2.0), (4, "added", None)], "code int, name string, alt double")
    out = classify_changes(cur, inc, ["code"], ["name", "alt"], F.lit(h(5)).cast("timestamp_ntz"))
    acts = dict(rows(out, "code", "_action"))
    assert acts == {1: "noop", 2: "update", 3: "update", 4: "insert", 5: "keep"}
    assert changed_count(out) == 3
    got = {r.code: r for r in out.collect()}
    assert got[1].loaded_at == T0 and got[2].loaded_at == h(5) and got[5].name == "missing"
    assert got[3].alt == 2.0


# -------------------------------------------------------------- history
def test_scd2_from_extracts_intervals_are_gap_free(spark):
    ex = [
        (1, h(0), "a", 1.0),
        (1, h(1), "a", 1.0),  # unchanged -> no new version
        (1, h(2), "a", None),  # NULL is a change
        (1, h(3), "a", None),
        (1, h(4), "b", None),
        (2, h(1), "z", 5.0),
    ]
    df = spark.createDataFrame(ex, "code int, ts timestamp_ntz, cat string, alt double")
    hist = scd2_from_extracts(df.withColumn("ts", F.col("ts").cast("timestamp")), ["code"], ["cat", "alt"], "ts")
    got = rows(hist.select("code", "cat", "alt", F.col("valid_from").cast("timestamp_ntz"), F.col("valid_to").cast("timestamp_ntz")))
    end = dt.datetime(9999, 12, 31)
    assert got == srt([
        (1, "a", None, h(2), h(4)),
        (1, "a", 1.0, h(0), h(2)),
        (1, "b", None, h(4), end),
        (2, "z", 5.0, h(1), end),
    ])


def test_scd2_apply_step(spark):
    end = dt.datetime(9999, 12, 31)
    hist = spark.createDataFrame(
        [
            (1, 1.0, h(0), end),  # unchanged
            (2, 1.0, h(0), end),  # changes
            (3, 1.0, h(0), end),  # vanished from source: stays open
            (4, 0.0, T0 - dt.timedelta(days=1), h(0)),  # closed row passes through
            (4, 2.0, h(0), end),
        ],
        "station_code int, alt double, valid_from timestamp_ntz, valid_to timestamp_ntz",
    ).select("station_code", "alt", F.col("valid_from").cast("timestamp"), F.col("valid_to").cast("timestamp"))
    cur = spark.createDataFrame([(1, 1.0), (2, 9.0), (4, 2.0), (5, 3.0)], "station_code int, alt double")
    as_of = F.lit(h(10)).cast("timestamp_ntz").cast("timestamp")
    out = scd2_apply(hist, cur, ["station_code"], ["alt"], as_of)
    got = rows(out.select("station_code", "alt", F.col("valid_from").cast("timestamp_ntz"), F.col("valid_to").cast("timestamp_ntz")))
    assert got == [
        (1, 1.0, h(0), end),
        (2, 1.0, h(0), h(10)),
        (2, 9.0, h(10), end),
        (3, 1.0, h(0), end),
        (4, 0.0, T0 - dt.timedelta(days=1), h(0)),
        (4, 2.0, h(0), end),
        (5, 3.0, h(10), end),
    ]
    from catchment.operators import scd2_pending_changes

    assert rows(scd2_pending_changes(hist, cur, ["station_code"], ["alt"])) == [(2,), (5,)]
    assert scd2_pending_changes(out, cur, ["station_code"], ["alt"]).isEmpty()
    # one open row per key
    assert key_violations(out.filter(F.col("valid_to") == F.to_timestamp(F.lit(OPEN_END))), ["station_code"]).isEmpty()


def test_point_in_time_half_open_and_before_first_version(spark):
    T = h(10)
    sec = dt.timedelta(seconds=1)
    end = dt.datetime(9999, 12, 31)
    hist = spark.createDataFrame(
        [(1, 1.0, h(5), T), (1, 2.0, T, end)], "code int, alt double, valid_from timestamp_ntz, valid_to timestamp_ntz"
    )
    facts = spark.createDataFrame([(0, 1, T - sec), (1, 1, T), (2, 1, T + sec), (3, 1, h(1)), (4, 9, T)], "id int, st int, ts timestamp_ntz")
    out = point_in_time_join(facts, hist, "st", "code", "ts")
    assert rows(out, "id", "alt") == srt([(0, 1.0), (1, 2.0), (2, 2.0), (3, None), (4, None)])


# ------------------------------------------------------------ proximity
def _brute(points, sites, k):
    out = {}
    for pk, plat, plon in points:
        ds = []
        for sk, slat, slon in sites:
            p1, p2 = math.radians(plat), math.radians(slat)
            a = math.sin(math.radians(slat - plat) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(slon - plon) / 2) ** 2
            a = min(max(a, 0.0), 1.0)
            ds.append((6371.0 * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a)), sk))
        ds.sort()
        out[pk] = [s for _, s in ds[:k]]
    return out


@pytest.mark.parametrize("spread,n_sites", [("local", 40), ("global", 60), ("few", 2)])
def test_nearest_k_matches_brute_force(spark, spread, n_sites):
    rnd = random.Random(hash(spread) % 1000)
    if spread == "local":
        box = lambda: (57.5 + rnd.random() * 2.5, 21.5 + rnd.random() * 6.5)
    else:
        box = lambda: (rnd.uniform(-89, 89), rnd.uniform(-180, 180))
    points = [(i, *box()) for i in range(120)]
    sites = [(f"S{j:03d}", *box()) for j in range(n_sites)]
    pdf = spark.createDataFrame(points, "p int, latitude double, longitude double")
    sdf = spark.createDataFrame(sites, "s string, latitude double, longitude double")
    got = nearest_k(pdf, sdf, 3, "p", "s").collect()
    by_point = {}
    for r in sorted(got, key=lambda r: (r.p, r.rank)):
        by_point.setdefault(r.p, []).append(r.s)
    assert by_point == _brute(points, sites, 3)


# --------------------------------------------------------------- quality
def test_quality_operators(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 5, None), (3, 4, "ok")], "id int, rank int, status string")
    assert rows(null_violations(df, ["rank", "status"], ["id"])) == [(1, "rank"), (2, "status")]
    with pytest.raises(RequiredFieldError):
        require_fields(df, ["rank"])
    valid, bad = require_fields(df, ["rank", "status"], "quarantine")
    assert rows(valid, "id") == [(3,)] and rows(bad, "id") == [(1,), (2,)]
    assert rows(range_violations(df, "rank", 1, 3), "id") == [(2,), (3,)]
    assert rows(set_violations(df, "status", ["ok"]), "id") == [(1,)]
    filled = with_defaults(df, {"status": F.lit("running"), "flag": F.lit(True)})
    assert rows(filled, "id", "status", "flag") == [(1, "a", True), (2, "running", True), (3, "ok", True)]
    with pytest.raises(EmptyBatchError):
        require_non_empty(df.filter("id > 10"), "x")
    assert rows(key_violations(df.union(df.filter("id = 1")), ["id"])) == [(1, 2)]


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_point_in_time_on_overlapping_empty_and_backdated_intervals(spark, threshold):
    """Broadcast or shuffled, the join is the plain interval join: a row per
    matching version, none for an empty or inverted interval."""
    rnd = random.Random(5)
    hist = [(rnd.randint(0, 3), i, rnd.randint(0, 40), rnd.randint(0, 60)) for i in range(60)] + [(1, 99, 10, 10_000)]
    facts = [(i, rnd.randint(0, 4), rnd.randint(0, 50)) for i in range(200)]
    hdf = spark.createDataFrame([(k, v, h(a), h(b)) for k, v, a, b in hist], "code int, v int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    fdf = spark.createDataFrame([(i, k, h(t)) for i, k, t in facts], "id int, st int, ts timestamp_ntz")
    want = []
    for i, k, t in facts:
        hits = [(i, v) for c, v, a, b in hist if c == k and a <= t < b]
        want += hits or [(i, None)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = rows(point_in_time_join(fdf, hdf, "st", "code", "ts"), "id", "v")
        inner = rows(point_in_time_join(fdf, hdf, "st", "code", "ts", how="inner"), "id", "v")
        sorted_join = rows(as_of_join(fdf, hdf, "st", "code", "ts"), "id", "v")
        sorted_inner = rows(as_of_join(fdf, hdf, "st", "code", "ts", how="inner"), "id", "v")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == srt(want) and inner == srt(w for w in want if w[1] is not None)
    assert sorted_join == got and sorted_inner == inner


def test_as_of_join_over_months_with_overlaps_nulls_and_repeats(spark):
    """Histories over years, equal starts, repeated versions, gaps, open ends,
    null keys and times, facts on the edges of months and versions."""
    rnd = random.Random(11)
    day = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n)
    starts = [0, 31, 60, 90, 400, 800]
    hist = [(rnd.randint(0, 3), i, day(a := rnd.choice(starts)), day(a + rnd.choice([0, 1, 30, 59, 400]))) for i in range(40)]
    hist += [(1, 90, day(60), dt.datetime(9999, 12, 31)), (1, 90, day(60), dt.datetime(9999, 12, 31)), (None, 91, day(0), day(900)), (5, 92, day(31), None)]
    facts = [(i, rnd.choice([0, 1, 2, 3, 4, 5, None]), rnd.choice([day(rnd.choice(starts) + rnd.choice([-1, 0, 1, 30])), day(rnd.randint(-40, 2000)), None])) for i in range(300)]
    hdf = spark.createDataFrame(hist, "code int, v int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    fdf = spark.createDataFrame(facts, "id int, st int, ts timestamp_ntz").repartition(3)
    got, want = (rows(f(fdf, hdf, "st", "code", "ts")) for f in (as_of_join, point_in_time_join))
    assert got == want and len(want) >= 400


def test_as_of_join_of_a_station_with_many_versions(spark):
    """10,000 versions and as many facts: no operator makes more rows than both."""
    n = 10_000
    hdf = spark.range(n).selectExpr("1 AS code", "id AS v", "timestampadd(HOUR, id, timestamp_ntz'2020-01-01') AS valid_from", "timestampadd(HOUR, id + 1, timestamp_ntz'2020-01-01') AS valid_to")
    fdf = spark.range(n).selectExpr("id", "1 AS st", "timestampadd(MINUTE, id * 60 + 30, timestamp_ntz'2020-01-01') AS ts")
    joined = as_of_join(fdf, hdf, "st", "code", "ts")
    assert joined.filter("v = id").count() == n
    def joins(node):  # noqa: E306
        name = node.nodeName()
        own = [node.metrics().apply("numOutputRows").value()] if "Join" in name and node.metrics().contains("numOutputRows") else []
        kids = node.children()
        return own + [x for i in range(kids.size()) for x in joins(kids.apply(i))]
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    assert max(joins(plan), default=0) <= 2 * n


def test_scd2_refuses_a_run_before_the_open_version(spark):
    hist = spark.createDataFrame([(1, 1.0, h(5), dt.datetime(9999, 12, 31))], "k int, v double, valid_from timestamp, valid_to timestamp")
    cur = spark.createDataFrame([(1, 2.0)], "k int, v double")
    with pytest.raises(Exception, match="before the open version"):
        scd2_apply(hist, cur, ["k"], ["v"], F.lit(h(3)).cast("timestamp")).collect()


def test_nearest_k_ties_break_by_site_code(spark):
    # two sites mirrored around the point's meridian are equally far
    pts = spark.createDataFrame([(1, 58.0, 25.0)], "p int, latitude double, longitude double")
    sites = spark.createDataFrame(
        [("B", 58.0, 25.5), ("A", 58.0, 24.5), ("C", 58.0, 26.5)], "s string, latitude double, longitude double"
    )
    got = [(r.s, r.rank) for r in nearest_k(pts, sites, 2, "p", "s").orderBy("rank").collect()]
    assert got == [("A", 1), ("B", 2)]


def test_nearest_k_dense_cluster_matches_brute_force(spark):
    """A third-plus of all sites packed in one small area: leaves are split
    and pruned, results stay exact."""
    rnd = random.Random(11)
    cluster = [(f"C{j:04d}", 58.5 + rnd.random() * 0.01, 24.5 + rnd.random() * 0.01) for j in range(2000)]
    spread = [(f"S{j:03d}", 57.5 + rnd.random() * 2.5, 21.5 + rnd.random() * 6.5) for j in range(40)]
    points = [(i, 58.3 + rnd.random() * 0.4, 24.3 + rnd.random() * 0.4) for i in range(60)]
    points += [(100 + i, 58.5 + rnd.random() * 0.01, 24.5 + rnd.random() * 0.01) for i in range(10)]
    pdf = spark.createDataFrame(points, "p int, latitude double, longitude double")
    sdf = spark.createDataFrame(cluster + spread, "s string, latitude double, longitude double")
    got = nearest_k(pdf, sdf, 3, "p", "s").collect()
    by_point = {}
    for r in sorted(got, key=lambda r: (r.p, r.rank)):
        by_point.setdefault(r.p, []).append(r.s)
    assert by_point == _brute(points, cluster + spread, 3)


def test_queries_leave_nothing_cached(spark):
    from catchment.plans.registry import QUERIES

    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    for name in ("gold_hydro_meteo", "proximity_upsert", "domain_violations"):
        QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_constraints_report_every_broken_rule_in_one_scan(spark):
    df = spark.createDataFrame(
        [(1, "a", 5, "x"), (1, "a", 500, "y"), (2, None, 7, "z"), (3, "b", None, None), (None, "c", 1, "x"), (None, "c", 1, "x")], "k int, name string, v int, s string"
    )
    rules = Constraints(["k"], required=["k", "name"], ranges={"v": (0, 100)}, allowed={"s": ["x", "y"]})
    assert rows(violations(df, rules)) == srt(
        [("unique", "k", "1", 2), ("range", "v", "1", 1), ("required", "name", "2", 1), ("allowed", "s", "2", 1), ("unique", "k", "", 2), ("required", "k", "", 2)]
    )
    assert violations(df.filter("false"), rules).isEmpty()
    enforce("t", df.filter("k = 3"), rules)
    for bad in ("k = 1 AND v = 500", "k = 2", "k IS NULL", "k = 1"):
        with pytest.raises(ConstraintError, match="nothing written"):
            enforce("t", df.filter(bad), rules)
