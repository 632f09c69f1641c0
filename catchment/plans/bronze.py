"""Bronze ingestion: validate, de-duplicate and upsert landed records
(SRC-3, SRC-6, AGG-4, UPS-1, UPS-2, UPS-6, AGG-5)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.constraints import Constraints, enforce
from ..operators.keyed import DuplicateKeyError, latest_revision
from ..operators.quality import EmptyBatchError, RequiredFieldError
from ..schemas import HYDRO_KEY, HYDRO_RAW, HYDRO_REQUIRED, METEO_KEY, METEO_RAW, METEO_REQUIRED
from ..sources.store import Lakehouse

BRONZE_COLUMNS = {
    "hydro": [f.name for f in HYDRO_RAW.fields],
    "meteo": [f.name for f in METEO_RAW.fields],
}
KEYS = {"hydro": HYDRO_KEY, "meteo": METEO_KEY}
REQUIRED = {"hydro": HYDRO_REQUIRED, "meteo": METEO_REQUIRED}


# CHECK constraints of calendar fields (24 closes a day).
BRONZE_RANGES = {"hydro": {}, "meteo": {"kuu": (1, 12), "paev": (1, 31), "tund": (0, 24)}}


def partition_day(source: str) -> Column:
    """Day partition of a bronze row; a function of its key, so a key never
    changes partition (hydro: UTC day of the reading; meteo: its calendar day)."""
    if source == "hydro":
        return F.to_date(F.col("timeline_ts_utc"))
    return F.make_date("aasta", "kuu", "paev")


def _present(df: DataFrame, *names: str) -> list[Column]:
    return [F.col(c) for c in names if c in df.columns]


def _landing_order(df: DataFrame) -> list[Column]:
    """Which landing of a record is later: by file date, then (one date landed
    again) by the time of the raw file."""
    return _present(df, "file_date", "relanded_at")


def _record_order(df: DataFrame) -> Column:
    """Position of a record inside its landing unit."""
    cols = _present(df, "source_file", "file_offset", "record_pos")
    return F.struct(*cols) if cols else F.lit(0)


@dataclass
class BatchProfile:
    """What one pass over a raw batch finds."""

    records: int
    missing: int  # records without a required field
    repeated: int  # keys that one landing unit holds more than once
    undated: int  # of those, keys with a record without publication time
    days: set  # file dates that hold a record


def batch_profile(source: str, raw: DataFrame) -> BatchProfile:
    """All checks of a raw batch in one pass: records per (key, landing unit),
    pre-aggregated before the shuffle, then summed up."""
    missing = F.lit(False)
    for c in REQUIRED[source]:
        missing = missing | F.col(c).isNull()
    undated = F.col("avaandmed_ts").isNull() if "avaandmed_ts" in raw.columns else F.lit(False)
    unit = [c for c in ("file_date", "landing_unit") if c in raw.columns]
    per_key = raw.groupBy(*KEYS[source], *unit).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(undated, 1)).alias("undated"), F.max(missing).alias("missing")
    )
    days = F.collect_set("file_date") if "file_date" in unit else F.array()
    r = per_key.agg(
        F.sum("n").alias("records"),
        F.sum(F.when(F.col("missing"), F.col("n"))).alias("missing"),
        F.count(F.when((F.col("n") > 1) & ~F.col("missing"), 1)).alias("repeated"),
        F.count(F.when((F.col("n") > 1) & (F.col("undated") > 0), 1)).alias("undated"),
        days.alias("days"),
    ).first()
    return BatchProfile(int(r["records"] or 0), int(r["missing"] or 0), int(r["repeated"]), int(r["undated"]), set(r["days"]))


def prepare_batch(source: str, raw: DataFrame, on_duplicate: str = "fail", profile: BatchProfile | None = None) -> DataFrame:
    """One row per key from the records of one or more landing units.

    * required fields must be present (else the whole batch fails);
    * across units the later one wins (file date, then re-landing time), as
      day-by-day ingestion in file-date order would do;
    * hydro: a key twice *within* one unit fails (``on_duplicate="fail"``) or
      the later record wins (``"last"``);
    * meteo: within a file date the latest ``avaandmed_ts`` wins, in whichever
      part file it stands, the first record on equal times; ``avaandmed_ts``
      must be present where a key repeats.
    One window over the key decides all of it, pre-limited before the shuffle.
    ``profile`` takes the checks from a pass that already ran.
    """
    if on_duplicate not in ("fail", "last"):
        raise ValueError(on_duplicate)
    keys = KEYS[source]
    p = profile or batch_profile(source, raw)
    if p.missing:
        raise RequiredFieldError(f"{source}: {p.missing} records without required fields {REQUIRED[source]}")
    if source == "hydro":
        if p.repeated and on_duplicate == "fail":
            raise DuplicateKeyError(f"hydro batch repeats {p.repeated} keys {keys} inside one landing")
        return latest_revision(raw, keys, F.struct(*_landing_order(raw), _record_order(raw).alias("pos")))
    if p.undated:
        raise RequiredFieldError(f"meteo: {p.undated} keys repeat without avaandmed_ts")
    version = F.struct(*_present(raw, "file_date"), F.col("avaandmed_ts"), *_present(raw, "relanded_at"))
    return latest_revision(raw, keys, version, _record_order(raw))


# Where a stored row was landed: what decides between it and a later arrival.
PROVENANCE = ["landed_on", "relanded_at", "landed_in", "landings"]


def with_provenance(source: str, raw: DataFrame, batch: DataFrame) -> DataFrame:
    """``batch`` (one row per key of ``raw``) with the place of its record in
    the order of publication, and every landing that held the key."""
    keys = KEYS[source]
    place = {"landed_on": ("file_date", "date"), "relanded_at": ("relanded_at", "timestamp"), "landed_in": ("source_file", "string")}
    known = {a: (F.col(c) if c in batch.columns else F.lit(None)).cast(t).alias(a) for a, (c, t) in place.items()}
    unit = [F.coalesce(F.col(c).cast("string"), F.lit("")) if c in raw.columns else F.lit("") for c in ("file_date", "landing_unit", "source_file")]
    landings = raw.select(*keys, F.struct(F.concat_ws("|", *unit[:2]).alias("unit"), unit[2].alias("file")).alias("l"))
    landings = landings.groupBy(*keys).agg(F.sort_array(F.collect_set("l")).alias("landings"))
    return batch.select(*BRONZE_COLUMNS[source], *known.values()).join(landings, keys)


def _repeats(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``new`` that another file of one of their landing units held before."""
    elsewhere = F.exists("n.landings", lambda a: F.exists("o.landings", lambda b: (a["unit"] == b["unit"]) & (a["file"] != b["file"])))
    return new.alias("n").join(old.alias("o"), keys).filter(elsewhere)


def merge_landed(source: str, old: DataFrame, new: DataFrame, ordered: bool) -> DataFrame:
    """Stored rows and a batch, one row per key.

    ``ordered``: the record that comes later in the order of publication stays,
    whichever arrived first, by the rules of :func:`prepare_batch`; of one
    file's record and its replay, the replay. Otherwise the batch's row does,
    as a job run again overwrites. One join; both sides meet on the key.
    """
    keys = KEYS[source]
    n, o = (lambda c: F.col(f"n.{c}")), (lambda c: F.col(f"o.{c}"))
    take = n("landings").isNotNull()
    if ordered:
        if source == "hydro":
            version = ["landed_on", "relanded_at", "landed_in"]
            later = F.struct(*map(n, version)) >= F.struct(*map(o, version))
        else:
            version = ["landed_on", "avaandmed_ts", "relanded_at"]
            a, b = F.struct(*map(n, version)), F.struct(*map(o, version))
            later = (a > b) | ((a == b) & (n("landed_in") <= o("landed_in")))
        take = take & (o("loaded_at").isNull() | F.coalesce(later, F.lit(True)))
    merged = new.alias("n").join(old.alias("o"), keys, "full_outer")
    values = [c for c in new.columns if c not in (*keys, "landings")]
    none = F.array().cast(new.schema["landings"].dataType)
    landings = F.sort_array(F.array_union(F.coalesce(n("landings"), none), F.coalesce(o("landings"), none)))
    return merged.select(*keys, *[F.when(take, n(c)).otherwise(o(c)).alias(c) for c in values], landings.alias("landings")).select(*new.columns)


@dataclass
class LoadResult:
    rows_processed: int
    rows_loaded: int
    days: list
    missing_days: list = field(default_factory=list)


def upsert_bronze(
    lake: Lakehouse, source: str, batch: DataFrame, loaded_at: Column | None = None, ordered: bool = False, on_duplicate: str = "fail"
) -> LoadResult:
    """UPS-1/2: merge a key-unique batch into ``bronze.<source>``.

    Only the day partitions the batch touches are read (partition pruning)
    and rewritten (dynamic overwrite); on a key match every non-key column
    is replaced (NULLs too) and ``loaded_at`` refreshed; nothing is deleted.
    ``batch`` carries its provenance (:func:`with_provenance`); ``ordered``
    merges by it, and a key that another file of the same landing unit held
    in an earlier batch is checked as within one batch. The days are marked in
    the ledger until a build has covered them.
    """
    name = f"bronze.{source}"
    stamp = loaded_at if loaded_at is not None else F.current_timestamp()
    columns = [*BRONZE_COLUMNS[source], *PROVENANCE]
    b = batch.select(*columns).withColumn("loaded_at", stamp).withColumn("dt", partition_day(source)).persist()
    try:
        # one pass over the batch gives the touched days and the row count
        per_day = {r["dt"]: r["n"] for r in b.groupBy("dt").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not per_day:
            raise EmptyBatchError(f"{name}: empty batch, nothing written")
        days = sorted(per_day)
        required = [*REQUIRED[source], *(c for c in KEYS[source] if c not in REQUIRED[source])]
        enforce(name, b, Constraints(KEYS[source], required, BRONZE_RANGES[source]))
        merged = b
        old = lake.read_partitions(name, days)
        if old is not None:
            # rows stored before provenance was kept: older than any
            old = old.withColumns({c: F.lit(None).cast(b.schema[c].dataType) for c in PROVENANCE if c not in old.columns}).select(*b.columns)
            if ordered:
                again = _repeats(b, old, KEYS[source])
                if source == "hydro" and on_duplicate == "fail" and not again.isEmpty():
                    raise DuplicateKeyError(f"hydro batch repeats keys {KEYS[source]} that another file of their landing held")
                if source == "meteo" and not again.filter(F.col("n.avaandmed_ts").isNull() | F.col("o.avaandmed_ts").isNull()).isEmpty():
                    raise RequiredFieldError("meteo: keys repeat across files without avaandmed_ts")
            merged = merge_landed(source, old, b, ordered)
        with lake.ledger.writing(name, days):
            lake.overwrite_partitions(name, merged)
    finally:
        b.unpersist()
    n = sum(per_day.values())
    return LoadResult(rows_processed=n, rows_loaded=n, days=days)
