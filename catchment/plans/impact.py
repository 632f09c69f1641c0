"""Which stored days a reference change reaches (SRC-10, JOB-1).

A change of stations, their history, proximity or names alters silver and gold
only for some stations over some time. These plans compare the reference
tables a build has used with the current ones and give the days of readings
that would come out differently, so that only those are built again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.history import VALID_FROM, VALID_TO

ALWAYS = ("0001-01-01 00:00:00", "9999-12-31 00:00:00")
# What silver takes from a gauge, and gold from a weather station.
GAUGE_VALUES = ["station_category", "station_altitude_msl_m"]
WEATHER_VALUES = ["latitude", "longitude"]


def _instant(at: int) -> Column:
    return F.lit(ALWAYS[at]).cast("timestamp")


def differing(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that only one of two frames holds (each once), with ``_new``."""
    cols = old.columns
    both = old.withColumn("_new", F.lit(False)).unionByName(new.select(*cols).withColumn("_new", F.lit(True)))
    sides = both.groupBy(*cols).agg(F.count(F.when(F.col("_new"), 1)).alias("n"), F.count(F.when(~F.col("_new"), 1)).alias("o"))
    return sides.filter("n <> o").select(*cols, (F.col("n") > F.col("o")).alias("_new"))


def history_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """station_code, begin, end: where the version valid for a gauge gives
    other values than before. A version that was closed and followed by
    another differs from its end only, not from its start."""
    cols = ["station_code", *GAUGE_VALUES, VALID_FROM, VALID_TO]
    rows = differing(old.select(*cols), new.select(*cols)).filter(F.col(VALID_FROM) < F.col(VALID_TO))
    edges = rows.select("station_code", F.explode(F.array(VALID_FROM, VALID_TO)).alias("begin")).distinct()
    spans = edges.withColumn("end", F.lead("begin").over(Window.partitionBy("station_code").orderBy("begin"))).filter("end IS NOT NULL")
    values = F.struct(*GAUGE_VALUES)
    held = spans.join(rows, "station_code").filter((F.col(VALID_FROM) <= F.col("begin")) & (F.col("begin") < F.col(VALID_TO)))
    side = lambda new: F.sort_array(F.collect_list(F.when(F.col("_new") == new, values)))
    return held.groupBy("station_code", "begin", "end").agg(side(True).alias("n"), side(False).alias("o")).filter("n <> o").select("station_code", "begin", "end")


def fallback_changes(old: DataFrame, new: DataFrame, history: DataFrame) -> DataFrame:
    """station_code, begin, end: where the current station row stands in for
    its version (none is valid, or one without a value), for gauges whose
    current row has changed."""
    changed = differing(old.select("station_code", *GAUGE_VALUES), new.select("station_code", *GAUGE_VALUES)).select("station_code").distinct()
    whole = F.lit(True)
    for c in GAUGE_VALUES:
        whole = whole & F.col(c).isNotNull()
    solid = history.filter(whole & (F.col(VALID_FROM) < F.col(VALID_TO))).select("station_code", F.col(VALID_FROM).alias("f"), F.col(VALID_TO).alias("t"))
    # a last, empty version closes the row of intervals
    marks = solid.join(changed, "station_code").unionByName(changed.select("station_code", _instant(1).alias("f"), _instant(1).alias("t")))
    before = Window.partitionBy("station_code").orderBy("f", "t").rowsBetween(Window.unboundedPreceding, -1)
    gaps = marks.select("station_code", F.coalesce(F.max("t").over(before), _instant(0)).alias("begin"), F.col("f").alias("end"))
    return gaps.filter("begin < end")


def weather_changes(old: dict[str, DataFrame], new: dict[str, DataFrame]) -> DataFrame:
    """hydro_station_code: gauges whose nearest weather station, its distance,
    place or names have changed (frames ``proximity``, ``stations``, ``names``)."""
    pair = ["hydro_station_code", "meteo_station_code", "distance_km"]
    first = [x["proximity"].filter("proximity_rank = 1").select(*pair) for x in (old, new)]
    gauges = differing(*first).select("hydro_station_code")
    place = ["station_code", *WEATHER_VALUES]
    moved = differing(old["stations"].select(*place), new["stations"].select(*place)).select("station_code")
    renamed = differing(old["names"], new["names"]).select(F.col("jaam_kood").alias("station_code"))
    codes = moved.union(renamed).distinct()
    near = first[0].unionByName(first[1]).join(codes, F.col("meteo_station_code") == F.col("station_code"), "left_semi")
    return gauges.union(near.select("hydro_station_code")).distinct()


def reading_days(readings: DataFrame, spans: DataFrame) -> list[dt.date]:
    """Days (``dt``) on which gauges of ``spans`` (station_code, begin, end)
    have readings inside theirs. Two columns of the days from the earliest
    change on are read."""
    first = spans.agg(F.date_format(F.min("begin"), "yyyy-MM-dd").alias("b")).first()["b"]
    if first is None:
        return []
    own = readings.select("jaam_kood", "timeline_ts_utc", "dt").filter(F.col("dt") >= F.lit(first).cast("date"))
    hit = own.join(spans, (F.col("jaam_kood") == F.col("station_code")) & (F.col("timeline_ts_utc") >= F.col("begin")) & (F.col("timeline_ts_utc") < F.col("end")), "left_semi")
    return sorted(r["dt"] for r in hit.select("dt").distinct().collect())


def always(codes: DataFrame) -> DataFrame:
    """Spans over all time of the gauges ``hydro_station_code``."""
    return codes.select(F.col("hydro_station_code").alias("station_code"), _instant(0).alias("begin"), _instant(1).alias("end"))
