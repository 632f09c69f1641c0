"""All constraints of a table in one scan (DQ-1..4, DQ-6).

A table's rules - unique key, required columns, ranges, allowed values - are
one declaration. ``violations`` reads the table once: rows are pre-aggregated
per key before the shuffle, so a key that many rows share travels as one row
per task. ``enforce`` stops a write when a rule is broken.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import ConstraintError


@dataclass(frozen=True)
class Constraints:
    """``keys`` identify a row; NULL passes ``ranges`` (column -> low, high)
    and ``allowed`` (column -> values), as CHECK constraints do."""

    keys: Sequence[str]
    required: Sequence[str] = ()
    ranges: Mapping[str, tuple] = field(default_factory=dict)
    allowed: Mapping[str, Sequence] = field(default_factory=dict)


def violations(df: DataFrame, rules: Constraints) -> DataFrame:
    """rule, column, key, n_rows: one row per broken rule and key.

    ``rule`` is ``unique``, ``required``, ``range`` or ``allowed``; ``column``
    the constrained one (the key columns, joined by commas, for ``unique``);
    ``key`` the key's values joined by ``|`` (a NULL as an empty string);
    ``n_rows`` the rows that break it (all rows of a repeated key).
    """
    tests = [("required", c, F.col(c).isNull()) for c in rules.required]
    tests += [("range", c, F.col(c).isNotNull() & ~F.col(c).between(F.lit(a), F.lit(b))) for c, (a, b) in rules.ranges.items()]
    tests += [("allowed", c, F.col(c).isNotNull() & ~F.col(c).isin(*v)) for c, v in rules.allowed.items()]
    counts = [F.count(F.when(bad, 1)).alias(f"_v{i}") for i, (_, _, bad) in enumerate(tests)]
    per_key = df.groupBy(*rules.keys).agg(F.count(F.lit(1)).alias("_n"), *counts)
    row = lambda rule, column, n: F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column"), n.alias("n_rows"))
    found = [F.when(F.col("_n") > 1, row("unique", ",".join(rules.keys), F.col("_n")))]
    found += [F.when(F.col(f"_v{i}") > 0, row(rule, c, F.col(f"_v{i}"))) for i, (rule, c, _) in enumerate(tests)]
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rules.keys]).alias("key")
    broken = per_key.select(key, F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("b"))
    return broken.select("b.rule", "b.column", "key", "b.n_rows")


def enforce(name: str, df: DataFrame, rules: Constraints) -> None:
    """Raise :class:`ConstraintError` if ``df`` breaks a rule; the message names
    up to three cases."""
    bad = violations(df, rules).limit(3).collect()
    if bad:
        cases = "; ".join(f"{r['rule']} {r['column']} at {r['key']} ({r['n_rows']} rows)" for r in bad)
        raise ConstraintError(f"{name}: {cases}; nothing written")
