"""Small predicate / conditional helpers used across operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_distinct(left: str, right: str, cols: list[str]) -> Column:
    """FLT-3: OR over ``left.c IS DISTINCT FROM right.c`` for every column."""
    preds = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols]
    return reduce(lambda a, b: a | b, preds, F.lit(False))


def corrected_level(level, altitude) -> Column:
    """CND-3: level plus gauge-zero altitude when the altitude is known."""
    lvl = F.col(level) if isinstance(level, str) else level
    alt = F.col(altitude) if isinstance(altitude, str) else altitude
    return F.when(alt.isNotNull(), lvl + alt).otherwise(lvl)


def text_flag(c) -> Column:
    """STR-1: ``strip().lower() == 'true'`` on a text cell (NULL -> false)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.lower(F.trim(col)) == F.lit("true"), F.lit(False))


def empty_to_null(c) -> Column:
    """STR-2: empty text cell -> NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.nullif(col, F.lit(""))
