"""Reports on gold (RPT-1..3): how rain drives water level.

Nothing here orders a station's whole history in one task: hours meet by
equi-joins on (station, day) or (station, hour), and ranks are dealt per
(station, month) with a small table of counts before each month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATION, TS = "hydro_station_code", "timeline_ts_utc"
MAX_LAG_HOURS = 72
EVENT_GAP_HOURS = 6


def gauge_hours(gold: DataFrame) -> DataFrame:
    """One row per gauge and hour: gold may hold an hour once per name of its
    weather station."""
    return gold.groupBy(STATION, TS).agg(
        F.max("catchment_name").alias("catchment_name"),
        F.max("observation_ts_local").alias("observation_ts_local"),
        F.max("precipitation_mm").cast("double").alias("rain"),
        F.max("wl_avg").cast("double").alias("level"),
        F.max("discharge_avg").cast("double").alias("discharge"),
        F.max("air_temp_avg").cast("double").alias("temp"),
    )


def rain_response(gold: DataFrame, max_lag: int = MAX_LAG_HOURS) -> DataFrame:
    """RPT-1: per gauge the lag (0 .. ``max_lag`` hours) at which the level
    correlates best with rain, that correlation, and the pairs behind it.

    Hours are packed per (station, day); a rain day meets the level days it
    can reach, and the pairs inside are summed up per (station, lag) before
    the shuffle.
    """
    hours = gauge_hours(gold)
    hour = F.floor(F.unix_timestamp(TS) / 3600).alias("hour")
    day = F.floor(F.col("hour") / 24).alias("day")

    def packed(value: str) -> DataFrame:
        h = hours.filter(F.col(value).isNotNull()).select(STATION, hour, F.col(value).alias("v")).select(STATION, day, "hour", "v")
        return h.groupBy(STATION, "day").agg(F.collect_list(F.struct("hour", "v")).alias(value))  # 24 hours at most

    reach = F.explode(F.sequence(F.lit(0), F.lit(max_lag // 24 + 1)))
    rain = packed("rain").select(STATION, F.col("day"), "rain", reach.alias("ahead")).withColumn("day", F.col("day") + F.col("ahead"))
    met = rain.join(packed("level"), [STATION, "day"])
    pairs = met.select(STATION, F.explode("rain").alias("r"), "level").select(STATION, "r", F.explode("level").alias("l"))
    pairs = pairs.select(STATION, (F.col("l.hour") - F.col("r.hour")).cast("int").alias("lag"), F.col("r.v").alias("x"), F.col("l.v").alias("y"))
    sums = pairs.filter(F.col("lag").between(0, max_lag)).groupBy(STATION, "lag").agg(
        F.count("*").alias("n"), F.sum("x").alias("x"), F.sum("y").alias("y"),
        F.sum(F.col("x") * F.col("x")).alias("xx"), F.sum(F.col("y") * F.col("y")).alias("yy"), F.sum(F.col("x") * F.col("y")).alias("xy"),
    )
    n = F.col("n").cast("double")
    spread = (n * F.col("xx") - F.col("x") * F.col("x")) * (n * F.col("yy") - F.col("y") * F.col("y"))
    corr = F.round((n * F.col("xy") - F.col("x") * F.col("y")) / F.sqrt(spread), 4)
    scored = sums.filter((n >= 3) & (spread > 1e-6)).select(STATION, "lag", "n", corr.alias("correlation"))
    best = F.max(F.struct("correlation", (-F.col("lag")).alias("soonest"), "n"))
    return scored.groupBy(STATION).agg(best.alias("b")).select(
        STATION, (-F.col("b.soonest")).alias("best_lag_hours"), F.col("b.correlation").alias("correlation"), F.col("b.n").alias("n_pairs")
    )


def rain_response_by_measure(gold: DataFrame, max_lag: int = MAX_LAG_HOURS) -> DataFrame:
    """RPT-1 on the named quantities: per gauge and measure (``level_change``
    over the hour before, ``discharge``) the lag (0 .. ``max_lag`` hours) at
    which it correlates best with rain, that correlation, and the pairs behind it.

    Pairs meet as in :func:`rain_response`. Their correlation comes from means
    and co-moments that are merged pair of partial results by pair, so neither
    large levels with a small spread nor the unit of a measure cost digits.
    A lag counts with three pairs and some spread on both sides.
    """
    hours = gauge_hours(gold).select(STATION, F.floor(F.unix_timestamp(TS) / 3600).alias("hour"), "rain", "level", "discharge")
    before = hours.select(STATION, (F.col("hour") + 1).alias("hour"), F.col("level").alias("before"))
    day = F.floor(F.col("hour") / 24).alias("day")
    rain = hours.filter("rain IS NOT NULL").groupBy(STATION, day).agg(F.collect_list(F.struct("hour", F.col("rain").alias("v"))).alias("rain"))
    ahead = F.explode(F.sequence(F.lit(0), F.lit(max_lag // 24 + 1))).alias("ahead")
    rain = rain.select(STATION, "day", "rain", ahead).withColumn("day", F.col("day") + F.col("ahead")).drop("ahead")
    values = {"level_change": F.col("level") - F.col("before"), "discharge": F.col("discharge")}
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), v.alias("v")) for m, v in values.items()])).alias("m")
    measured = hours.join(before, [STATION, "hour"], "left").select(STATION, "hour", each).filter("m.v IS NOT NULL")
    measured = measured.groupBy(STATION, "m.measure", day).agg(F.collect_list(F.struct("hour", "m.v")).alias("values"))
    met = rain.join(measured, [STATION, "day"]).select(STATION, "measure", F.explode("rain").alias("r"), "values")
    pairs = met.select(STATION, "measure", "r", F.explode("values").alias("l"))
    pairs = pairs.select(STATION, "measure", (F.col("l.hour") - F.col("r.hour")).cast("int").alias("lag"), F.col("r.v").alias("x"), F.col("l.v").alias("y"))
    by_lag = pairs.filter(F.col("lag").between(0, max_lag)).groupBy(STATION, "measure", "lag").agg(
        F.count("*").alias("n"), F.corr("x", "y").alias("c"), F.var_pop("x").alias("sx"), F.var_pop("y").alias("sy")
    )
    scored = by_lag.filter("n >= 3 AND sx > 0 AND sy > 0").withColumn("c", F.round("c", 4))
    best = F.max(F.struct("c", (-F.col("lag")).alias("soonest"), "n")).alias("b")
    return scored.groupBy(STATION, "measure").agg(best).select(
        STATION, "measure", (-F.col("b.soonest")).alias("best_lag_hours"), F.col("b.c").alias("correlation"), F.col("b.n").alias("n_pairs")
    )


def _hours_around(ts: str, first: int, last: int) -> Column:
    """The instants from ``first`` to ``last`` hours after ``ts``."""
    hours = lambda k: F.make_dt_interval(hours=F.lit(k))
    return F.sequence(F.col(ts) + hours(first), F.col(ts) + hours(last), F.expr("INTERVAL 1 HOUR"))


def _ranked(df: DataFrame) -> DataFrame:
    """Number the rows of each station in time order, a month at a time."""
    by_month = df.withColumn("month", F.date_trunc("month", TS))
    counts = by_month.groupBy(STATION, "month").agg(F.count("*").alias("n"))
    before = Window.partitionBy(STATION).orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(STATION, "month", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy(STATION, "month").orderBy(TS))
    return by_month.withColumn("inside", inside).join(counts, [STATION, "month"]).select(STATION, TS, (F.col("before") + F.col("inside")).alias("event"))


def rain_events(gold: DataFrame, gap: int = EVENT_GAP_HOURS, after: int = MAX_LAG_HOURS) -> DataFrame:
    """RPT-2: rain events (hours with rain, dry spells up to ``gap`` hours
    inside) with their rain, the lowest level of the ``gap`` hours up to the
    start, and the highest from the start to ``after`` hours past the end."""
    hours = gauge_hours(gold)
    wet = hours.filter("rain > 0").select(STATION, TS, "rain")
    at = wet.select(STATION, TS)
    first = at.join(at.select(STATION, F.explode(_hours_around(TS, 1, gap)).alias(TS)).distinct(), [STATION, TS], "left_anti")
    last = at.join(at.select(STATION, F.explode(_hours_around(TS, -gap, -1)).alias(TS)).distinct(), [STATION, TS], "left_anti")
    events = _ranked(first).withColumnRenamed(TS, "event_start").join(_ranked(last).withColumnRenamed(TS, "event_end"), [STATION, "event"])
    span = F.sequence(F.col("event_start") - F.make_dt_interval(hours=F.lit(gap)), F.col("event_end") + F.make_dt_interval(hours=F.lit(after)), F.expr("INTERVAL 1 HOUR"))
    spread = events.select(STATION, "event_start", "event_end", F.explode(span).alias(TS))
    met = spread.join(hours.select(STATION, TS, "rain", "level"), [STATION, TS])
    inside = (F.col(TS) >= F.col("event_start")) & (F.col(TS) <= F.col("event_end"))
    out = met.groupBy(STATION, "event_start", "event_end").agg(
        F.round(F.sum(F.when(inside, F.col("rain"))), 4).alias("rain_mm"),
        F.min(F.when(F.col(TS) <= F.col("event_start"), F.col("level"))).alias("base_level"),
        F.max(F.when(F.col(TS) >= F.col("event_start"), F.col("level"))).alias("peak_level"),
    )
    return out.withColumn("rise", F.round(F.col("peak_level") - F.col("base_level"), 4))


def daily_summary(gold: DataFrame) -> DataFrame:
    """RPT-3: per catchment and local day: rain (mean over the gauges of each
    gauge's sum), level, discharge and temperature."""
    per_gauge = gauge_hours(gold).groupBy("catchment_name", F.to_date("observation_ts_local").alias("day"), STATION).agg(
        F.sum("rain").alias("rain"), F.min("level").alias("lo"), F.max("level").alias("hi"),
        *(F.sum(c).alias(f"{c}_sum") for c in ("level", "discharge", "temp")), *(F.count(c).alias(f"{c}_n") for c in ("level", "discharge", "temp")),
    )
    mean = lambda c: F.round(F.try_divide(F.sum(f"{c}_sum"), F.sum(f"{c}_n")), 9)
    return per_gauge.groupBy("catchment_name", "day").agg(
        F.count("*").alias("gauges"),
        F.round(F.avg("rain"), 9).alias("rain_mm"),
        F.min("lo").alias("level_min"),
        mean("level").alias("level_avg"),
        F.max("hi").alias("level_max"),
        mean("discharge").alias("discharge_avg"),
        mean("temp").alias("temp_avg"),
    )
