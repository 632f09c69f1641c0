"""Data-quality operators (SRC-3, SRC-6, DQ-1..6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keyed import duplicate_keys


class EmptyBatchError(ValueError):
    """A source returned no records; nothing may be written."""


class ConstraintError(ValueError):
    """A table would break one of its constraints; nothing may be written."""


class RequiredFieldError(ValueError):
    """A record misses a required field."""


def require_non_empty(df: DataFrame, label: str) -> DataFrame:
    """SRC-6: raise when ``df`` has no rows (reads at most one row)."""
    if df.isEmpty():
        raise EmptyBatchError(f"{label}: empty batch, nothing written")
    return df


def null_violations(df: DataFrame, cols: Sequence[str], id_cols: Sequence[str]) -> DataFrame:
    """DQ-2: one row ``(id_cols..., column_name)`` per NULL in a required column."""
    flags = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return (
        df.select(*id_cols, F.explode(F.filter(flags, lambda x: x.isNotNull())).alias("column_name"))
    )


def require_fields(
    df: DataFrame,
    cols: Sequence[str],
    on_violation: str = "fail",
) -> tuple[DataFrame, DataFrame | None]:
    """SRC-3: records missing a required field.

    ``fail`` raises if any record misses one (nothing is written);
    ``quarantine`` returns ``(valid, rejected)`` where ``rejected`` carries a
    ``missing`` array of the absent column names.
    """
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]), lambda x: x.isNotNull())
    any_missing = F.lit(False)
    for c in cols:
        any_missing = any_missing | F.col(c).isNull()
    if on_violation == "fail":
        if not df.filter(any_missing).isEmpty():
            raise RequiredFieldError(f"records without required fields {list(cols)}")
        return df, None
    if on_violation == "quarantine":
        return df.filter(~any_missing), df.filter(any_missing).withColumn("missing", missing)
    raise ValueError(f"unknown on_violation {on_violation!r}")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-1 / DQ-6: keys held by more than one row, with ``n_rows``."""
    return duplicate_keys(df, keys)


def range_violations(df: DataFrame, col: str, low, high) -> DataFrame:
    """DQ-3: rows whose ``col`` is outside ``[low, high]`` (NULL passes, as a
    CHECK constraint does)."""
    c = F.col(col)
    return df.filter(c.isNotNull() & ~c.between(F.lit(low), F.lit(high)))


def set_violations(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """DQ-4: rows whose ``col`` is not one of ``allowed`` (NULL passes)."""
    c = F.col(col)
    return df.filter(c.isNotNull() & ~c.isin(*allowed))


def with_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """DQ-5: fill column defaults (``loaded_at = now``, ``is_active = true``)."""
    out = df
    for name, value in defaults.items():
        out = out.withColumn(name, F.coalesce(F.col(name), value) if name in df.columns else value)
    return out
