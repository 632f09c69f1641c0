"""Wall-clock / instant conversions and date parsing as Column expressions.

All results are plain built-in expressions, so they stay inside whole-stage
codegen. The session time zone must be UTC (see ``session.configure``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import LOCAL_TZ


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def wall_to_instant(year, month, day, hour, tz: str = LOCAL_TZ) -> Column:
    """TIM-1: a local wall-clock hour in ``tz`` -> instant (TimestampType).

    * In the repeated autumn hour the later (standard-time) instant is
      chosen, as PostgreSQL does; ``make_timestamp`` alone picks the earlier.
    * A non-existent spring hour resolves forward, like PostgreSQL.
    * Hour 24 rolls over to 00:00 of the next day; other out-of-range hours
      raise under ANSI mode.
    """
    y, m, d, h = _c(year), _c(month), _c(day), _c(hour)
    day_start = F.make_date(y, m, d)
    rolls = h == F.lit(24)
    date = F.when(rolls, F.date_add(day_start, 1)).otherwise(day_start)
    hh = F.when(rolls, F.lit(0)).otherwise(h)
    first = F.make_timestamp_ltz(
        F.year(date), F.month(date), F.dayofmonth(date), hh, F.lit(0), F.lit(0), F.lit(tz)
    )
    later = first + F.expr("INTERVAL 1 HOUR")
    # In a fold the instant one hour later shows the same local wall clock.
    is_fold = F.from_utc_timestamp(later, tz) == F.from_utc_timestamp(first, tz)
    return F.when(is_fold, later).otherwise(first)


def instant_to_wall(ts, tz: str = LOCAL_TZ) -> Column:
    """TIM-2: instant -> local wall clock in ``tz`` as TIMESTAMP_NTZ."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts).cast("timestamp_ntz"))


def local_day_bounds(day, tz: str = LOCAL_TZ) -> tuple[Column, Column]:
    """Instants of local midnight of ``day`` and of the next day in ``tz``."""
    d = F.lit(day).cast("date") if not isinstance(day, Column) else day
    start = F.to_utc_timestamp(d.cast("timestamp"), tz)
    end = F.to_utc_timestamp(F.date_add(d, 1).cast("timestamp"), tz)
    return start, end


def file_date(name) -> Column:
    """TIM-7: date of a raw file name ``<source>_<YYYY-MM-DD>.json``.

    The ``.json`` suffix is stripped, the rest after the first ``_`` must be
    an ISO calendar date; anything else gives NULL.
    """
    stem = F.regexp_replace(_c(name), r"\.json$", "")
    rest = F.regexp_extract(stem, r"^[^_]*_(.*)$", 1)
    iso = rest.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    parsed = F.try_to_timestamp(rest, F.lit("yyyy-MM-dd")).cast("date")
    return F.when(iso, parsed)


def hour_floor(ts) -> Column:
    """Truncate an instant to the start of its hour."""
    return F.date_trunc("hour", _c(ts))
