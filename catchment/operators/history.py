"""SCD2 validity-interval history and point-in-time joins (SCD-1..3, JN-1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import any_distinct
from ..schemas import OPEN_END

VALID_FROM = "valid_from"
VALID_TO = "valid_to"


def open_end_ts() -> Column:
    """TIM-4: the open-end sentinel 9999-12-31 as a timestamp."""
    return F.to_timestamp(F.lit(OPEN_END))


def _changed_vs_previous(keys: Sequence[str], ts: str, cols: Sequence[str]) -> Column:
    w = Window.partitionBy(*keys).orderBy(F.col(ts))
    first = F.lag(F.lit(1)).over(w).isNull()
    preds = [~F.col(c).eqNullSafe(F.lag(F.col(c)).over(w)) for c in cols]
    out = first
    for p in preds:
        out = out | p
    return out


def scd2_from_extracts(
    extracts: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    ts_col: str,
    bucket: str | None = None,
) -> DataFrame:
    """SCD-3: build a validity history from a series of full extracts.

    Each extract row is (keys, check columns, extract time). A new version
    starts whenever any check column IS DISTINCT FROM the previous extract
    of the same key; ``valid_to`` is the next version's start, or the open
    end. Keys missing from later extracts keep their open row (no hard
    deletes), as a check-strategy snapshot does.

    With ``bucket`` (e.g. ``"month"``) the windows run per (key, time
    bucket) instead of per key, so a key with a very long extract history is
    split over many tasks; the previous value and the next version start
    cross bucket edges through two small per-bucket tables. Same result.
    """
    if bucket is not None:
        return _scd2_from_extracts_bucketed(extracts, keys, check_cols, ts_col, bucket)
    cols = list(keys) + list(check_cols)
    marked = extracts.select(*cols, F.col(ts_col)).withColumn(
        "_new_version", _changed_vs_previous(keys, ts_col, check_cols)
    )
    versions = marked.filter("_new_version").drop("_new_version")
    w = Window.partitionBy(*keys).orderBy(F.col(ts_col))
    return versions.select(
        *cols,
        F.col(ts_col).alias(VALID_FROM),
        F.coalesce(F.lead(F.col(ts_col)).over(w), open_end_ts()).alias(VALID_TO),
    )


def _scd2_from_extracts_bucketed(
    extracts: DataFrame, keys: Sequence[str], check_cols: Sequence[str], ts_col: str, bucket: str
) -> DataFrame:
    keys, check_cols = list(keys), list(check_cols)
    cols = keys + check_cols
    x = extracts.select(*cols, F.col(ts_col).alias("_ts")).withColumn("_b", F.date_trunc(bucket, F.col("_ts")))
    kb = keys + ["_b"]
    # last extract of every (key, bucket): partial aggregate, no hot group
    vals = F.struct(*[F.col(c) for c in check_cols])
    last = x.groupBy(*kb).agg(F.max_by(vals, F.col("_ts")).alias("_last"))
    w_b = Window.partitionBy(*keys).orderBy("_b")
    prev = last.select(*kb, F.lag("_last").over(w_b).alias("_prev_last"))
    # change flags inside each (key, bucket); the first row of a bucket
    # compares with the last extract of the key's previous bucket
    w_in = Window.partitionBy(*kb).orderBy("_ts")
    first_in_bucket = F.lag(F.lit(1)).over(w_in).isNull()
    changed_in = F.lit(False)
    for c in check_cols:
        changed_in = changed_in | ~F.col(c).eqNullSafe(F.lag(F.col(c)).over(w_in))
    changed_edge = F.col("_prev_last").isNull()
    for c in check_cols:
        changed_edge = changed_edge | ~F.col(c).eqNullSafe(F.col(f"_prev_last.{c}"))
    flagged = x.join(prev, kb, "left").withColumn(
        "_new", F.when(first_in_bucket, changed_edge).otherwise(changed_in)
    )
    versions = flagged.filter("_new").select(*kb, *check_cols, "_ts")
    # next version start: inside the bucket by lead, across buckets from the
    # first version start of the key's next bucket that has one
    firsts = versions.groupBy(*kb).agg(F.min("_ts").alias("_first_ts"))
    w_after = w_b.rowsBetween(1, Window.unboundedFollowing)
    nxt = firsts.select(*kb, F.min("_first_ts").over(w_after).alias("_next_bucket_start"))
    w_v = Window.partitionBy(*kb).orderBy("_ts")
    out = versions.join(nxt, kb, "left").select(
        *cols,
        F.col("_ts").alias(VALID_FROM),
        F.coalesce(F.lead("_ts").over(w_v), F.col("_next_bucket_start"), open_end_ts()).alias(VALID_TO),
    )
    return out


def scd2_apply(
    history: DataFrame | None,
    current: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    as_of: Column,
) -> DataFrame:
    """SCD-1/2: one check-strategy snapshot run at time ``as_of``.

    * open row unchanged -> kept
    * open row with any check column distinct -> closed at ``as_of`` and a
      new open row from ``current`` starting at ``as_of``
    * key only in ``current`` -> new open row from ``as_of``
    * open row whose key vanished from ``current`` -> kept open
    Closed rows pass through untouched. One join, one pass: the 1-or-2 rows
    per key are emitted with ``inline`` instead of a self-union.
    """
    cols = list(keys) + list(check_cols)
    cur = current.select(*cols)
    if history is None:
        return cur.select(*cols, as_of.alias(VALID_FROM), open_end_ts().alias(VALID_TO))
    is_open = F.col(VALID_TO) == open_end_ts()
    closed = history.filter(~is_open).select(*cols, VALID_FROM, VALID_TO)
    open_rows = history.filter(is_open).select(*cols, VALID_FROM, VALID_TO)

    # a version cannot end before it starts: a backdated run is refused
    ends = F.when(F.col(f"o.{VALID_FROM}") <= as_of, as_of).otherwise(
        F.raise_error(F.concat(F.lit("snapshot time before the open version's start "), F.col(f"o.{VALID_FROM}").cast("string")))
    )
    o = open_rows.withColumn("_p", F.lit(True)).alias("o")
    c = cur.withColumn("_p", F.lit(True)).alias("c")
    j = o.join(c, on=list(keys), how="full_outer")
    has_o = F.col("o._p").isNotNull()
    has_c = F.col("c._p").isNotNull()
    changed = has_o & has_c & any_distinct("o", "c", list(check_cols))

    def version(src: str, vf: Column, vt: Column) -> Column:
        fields = [F.col(k).alias(k) for k in keys]
        fields += [F.col(f"{src}.{x}").alias(x) for x in check_cols]
        return F.struct(*fields, vf.alias(VALID_FROM), vt.alias(VALID_TO))

    old_version = F.when(
        has_o, version("o", F.col(f"o.{VALID_FROM}"), F.when(changed, ends).otherwise(F.col(f"o.{VALID_TO}")))
    )
    new_version = F.when((has_c & ~has_o) | changed, version("c", as_of, open_end_ts()))
    rows = j.select(F.inline(F.filter(F.array(old_version, new_version), lambda x: x.isNotNull())))
    return closed.unionByName(rows.select(*cols, VALID_FROM, VALID_TO))


def scd2_pending_changes(
    history: DataFrame | None,
    current: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
) -> DataFrame:
    """Keys a snapshot run at this moment would version: new keys and keys
    whose open row differs (NULL-safe) in any check column."""
    cur = current.select(*keys, *check_cols)
    if history is None:
        return cur.select(*keys)
    open_rows = history.filter(F.col(VALID_TO) == open_end_ts()).select(*keys, *check_cols)
    return (
        cur.alias("c")
        .join(open_rows.withColumn("_p", F.lit(True)).alias("o"), on=list(keys), how="left")
        .filter(F.col("o._p").isNull() | any_distinct("c", "o", list(check_cols)))
        .select(*keys)
    )


def point_in_time_join(
    facts: DataFrame,
    history: DataFrame,
    fact_key: str,
    hist_key: str,
    fact_ts: str,
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
    how: str = "left",
) -> DataFrame:
    """JN-1: facts joined to the history version valid at the fact time.

    Condition: ``key = key AND ts >= valid_from AND ts < valid_to``
    (half-open); output = fact columns + history columns, as a plain join:
    overlapping versions give a row each, an empty interval matches nothing.

    One lazy equi-join on the key with the interval as residual, whatever the
    sizes. Spark broadcasts the history when its measured size allows, else
    both sides shuffle on the key and adaptive execution splits a hot
    station's facts.
    """
    cond = (
        (facts[fact_key] == history[hist_key])
        & (facts[fact_ts] >= history[valid_from])
        & (facts[fact_ts] < history[valid_to])
    )
    return facts.join(history, cond, how)


def _segments(history: DataFrame, hist_key: str, valid_from: str, valid_to: str) -> DataFrame:
    """_k, _p, _b, _x: what is valid for a key from ``_p`` to its next ``_p``:
    the version that started last, ``_b`` (``v``, until ``t``), and earlier
    ones that still hold, ``_x``. Without overlaps ``_x`` is empty, and there
    is one row for each version."""
    version = F.struct(*[F.col(c) for c in history.columns])
    v = history.filter((F.col(valid_from) < F.col(valid_to)) & F.col(hist_key).isNotNull())
    v = v.select(F.col(hist_key).alias("_k"), F.col(valid_from).alias("_s"), F.col(valid_to).alias("_t"), version.alias("_v"))
    by_start = Window.partitionBy("_k").orderBy("_s", "_t", F.xxhash64("_v"))
    v = v.withColumn("_n", F.lead("_s").over(by_start))
    base = v.filter(F.col("_n").isNull() | (F.col("_s") < F.col("_n"))).select("_k", F.col("_s").alias("_p"), F.struct(F.col("_v").alias("v"), F.col("_t").alias("t")).alias("_b"))
    # a version that outlasts the start of the next one
    tails = v.filter(F.col("_n") < F.col("_t")).select("_k", "_n", "_t", "_v")
    none = F.lit(None).cast(base.schema["_b"].dataType).alias("_b")
    points = base.unionByName(tails.select("_k", F.explode(F.array("_n", "_t")).alias("_p"), none)).groupBy("_k", "_p").agg(F.max("_b").alias("_b"))
    points = points.withColumn("_b", F.last("_b", ignorenulls=True).over(Window.partitionBy("_k").orderBy("_p")))
    held = points.select("_k", "_p").join(tails, "_k").filter((F.col("_n") <= F.col("_p")) & (F.col("_p") < F.col("_t")))
    held = held.groupBy("_k", "_p").agg(F.collect_list("_v").alias("_x"))
    return points.join(held, ["_k", "_p"], "left").select("_k", "_p", "_b", F.coalesce("_x", F.array().cast(held.schema["_x"].dataType)).alias("_x"))


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    fact_key: str,
    hist_key: str,
    fact_ts: str,
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
    how: str = "left",
) -> DataFrame:
    """JN-1 for long histories: the rows of :func:`point_in_time_join` at a
    cost of facts plus versions, however many versions a key has.

    Facts and the starts of what is valid are sorted together per (key,
    month), and each fact takes the last start before it; a month opens with
    what its key had last. Months after a key's last start need no rows: one
    row per key answers them. Overlapping versions travel as a list. So no
    task sorts a key's whole facts, and no fact meets versions it does not
    need. Facts without a key or time match nothing.
    """
    if how not in ("left", "inner"):
        raise ValueError(how)
    seg = _segments(history, hist_key, valid_from, valid_to)
    month = lambda c: F.date_trunc("month", c).cast("timestamp_ntz")
    state = F.struct("_p", "_b", "_x")
    starts = seg.select("_k", month("_p").alias("_m"), F.lit(1).alias("_o"), F.col("_p").alias("_at"), state.alias("_g"))
    # the state at the start of each later month up to the key's last start
    last_in_month = starts.groupBy("_k", "_m").agg(F.max_by("_g", "_at").alias("_g"))
    after = F.lead("_m").over(Window.partitionBy("_k").orderBy("_m"))
    months = last_in_month.withColumn("_to", after).filter("_to IS NOT NULL")
    step = F.expr("INTERVAL 1 MONTH")
    edges = months.select("_k", F.explode(F.sequence(F.col("_m") + step, F.col("_to"), step)).alias("_m"), "_g")
    edges = edges.select("_k", "_m", F.lit(0).alias("_o"), F.lit(None).cast(seg.schema["_p"].dataType).alias("_at"), "_g")
    final = seg.groupBy("_k").agg(F.max_by(state, "_p").alias("_final")).withColumnRenamed("_k", "_fk")

    row = F.struct(*[F.col(c) for c in facts.columns]).alias("_f")
    key_type, at_type = seg.schema["_k"].dataType, seg.schema["_p"].dataType
    own = facts.select(F.col(fact_key).cast(key_type).alias("_k"), month(F.col(fact_ts)).alias("_m"), F.lit(2).alias("_o"), F.col(fact_ts).cast(at_type).alias("_at"), row)
    own = own.join(final, F.col("_k") == F.col("_fk"), "left").drop("_fk")
    blank = [F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("_f", "_final")]
    marks = starts.unionByName(edges).select("*", *blank)
    both = own.withColumn("_g", F.lit(None).cast(marks.schema["_g"].dataType)).unionByName(marks)
    seen = F.last("_g", ignorenulls=True).over(Window.partitionBy("_k", "_m").orderBy(F.col("_at").asc_nulls_first(), "_o").rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("_g", F.when(F.col("_at") >= F.col("_final._p"), F.col("_final")).otherwise(seen)).filter("_f IS NOT NULL")
    base = F.when(F.col("_at") < F.col("_g._b.t"), F.array("_g._b.v")).otherwise(F.array().cast(seg.schema["_x"].dataType))
    none = F.array().cast(seg.schema["_x"].dataType)
    valid = F.when(F.col("_k").isNull() | F.col("_at").isNull(), none).otherwise(F.concat(base, F.coalesce("_g._x", none)))
    explode = F.explode_outer if how == "left" else F.explode
    return found.select("_f", explode(valid).alias("_v")).select("_f.*", "_v.*")
