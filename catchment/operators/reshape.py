"""Long -> wide reshaping (AGG-1, AGG-2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_long(
    df: DataFrame,
    keys: Sequence[str],
    series_col: str,
    value_col: str,
    mapping: Mapping[str, str],
) -> DataFrame:
    """One row per ``keys`` group, one column per mapped series.

    Each output column is ``MAX(CASE WHEN series = s THEN value END)``.
    Rows whose series is not in ``mapping`` still form a group (with NULL
    measures), as in the reference. ``max`` is algebraic, so Spark combines
    map-side before the shuffle: a hot group never reaches one task whole.
    Output columns follow ``keys`` then ``mapping`` order.
    """
    measures = [
        F.max(F.when(F.col(series_col) == F.lit(series), F.col(value_col))).alias(column)
        for series, column in mapping.items()
    ]
    return df.groupBy(*keys).agg(*measures)


def melt_wide(
    df: DataFrame,
    keys: Sequence[str],
    mapping: Mapping[str, str],
    series_col: str,
    value_col: str,
) -> DataFrame:
    """Inverse of :func:`pivot_long` for non-NULL measures (used in tests)."""
    pairs = ", ".join(f"'{series}', `{column}`" for series, column in mapping.items())
    stacked = df.selectExpr(*[f"`{k}`" for k in keys], f"stack({len(mapping)}, {pairs}) as (`{series_col}`, `{value_col}`)")
    return stacked.filter(F.col(value_col).isNotNull())
