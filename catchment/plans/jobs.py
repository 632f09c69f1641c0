"""Composite jobs (JOB-1..4, PRX-1, SCD-1/2, SIL-1/2, GLD-1 materialised).

Driver code only sequences DataFrame jobs and branches on small counts;
all row work runs in Spark. Every step is logged as run events (AUD-2).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.constraints import Constraints, enforce, violations
from ..operators.history import VALID_FROM, VALID_TO, scd2_apply, scd2_pending_changes
from ..operators.keyed import changed_count, classify_changes, latest_revision, merge_rows
from ..operators.quality import EmptyBatchError
from ..schemas import (
    HYDRO_HISTORY,
    HYDRO_STATION_CHECK,
    HYDRO_STATIONS,
    METEO_RAW,
    METEO_STATION_CHECK,
    METEO_STATIONS,
    PROXIMITY,
    PROXIMITY_K,
    PROXIMITY_KEY,
    RUN_LOG,
    SOURCE_LAG_DAYS,
)
from ..session import configure
from ..sources.landing import read_landing, read_landing_schema
from ..sources.seeds import read_hydro_stations, read_meteo_stations
from ..sources.store import Lakehouse
from . import impact
from .audit import RunLog, logged_run
from .bronze import batch_profile, prepare_batch, upsert_bronze, with_provenance
from .gold import gold_hydro_meteo
from .reference_tables import proximity_matrix
from .silver import silver_hydro, silver_meteo

DAG_DAILY = "daily_load"
DAG_SEED = "station_seed"

# What every day of silver and gold depends on.
REFERENCE_TABLES = ["ref.hydro_stations", "ref.meteo_stations", "ref.station_proximity", "snapshots.snap_hydro_stations"]


# Versions of one station from which readings are joined to them by sorting.
LONG_HISTORY = 64
# Names of weather stations that gold was built with.
NAMES_BUILT = "built.meteo_names"
BUILT_SCHEMAS = {
    "ref.hydro_stations": HYDRO_STATIONS,
    "ref.meteo_stations": METEO_STATIONS,
    "ref.station_proximity": PROXIMITY,
    "snapshots.snap_hydro_stations": HYDRO_HISTORY,
    NAMES_BUILT: "jaam_kood string, jaam_nimi string",
}


def target_date(interval_start: dt.date, lag_days: int = SOURCE_LAG_DAYS) -> dt.date:
    """TIM-6: the day a run loads (interval start minus the source lag)."""
    return interval_start - dt.timedelta(days=lag_days)


def _ts(value: dt.datetime | None) -> Column:
    if value is None:
        return F.current_timestamp()
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def around(days: Iterable[dt.date]) -> list[dt.date]:
    """The days, the ones before and the ones after: wherever the zone lies,
    a local day's hours fall into these UTC days, and the reverse."""
    return sorted({d + dt.timedelta(days=i) for d in days for i in (-1, 0, 1)})


class Pipeline:
    """The lakehouse jobs over one table store and one landing area.

    ``landing_root`` holds ``source=<s>/dt=<day>`` folders (or raw
    ``<s>_<day>.json`` arrays under ``source=<s>``).
    """

    def __init__(self, spark: SparkSession, root: str, landing_root: str):
        self.spark = configure(spark)
        self.lake = Lakehouse(spark, f"{root}/tables")
        self.landing_root = landing_root.rstrip("/")
        self.log = RunLog(spark, f"{root}/tables/bronze/run_log")
        self.root = root.rstrip("/")

    def register_views(self) -> list[str]:
        """Temp views over the lake tables plus ``bronze_etl_log``: the current
        state of every logged run (AUD-3), as SQL users of a run-log table
        expect."""
        views = self.lake.register_views()
        try:
            self.log.state().createOrReplaceTempView("bronze_etl_log")
            views.append("bronze_etl_log")
        except Exception as exc:  # no run logged yet
            if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
                raise
        return views

    # ---------------------------------------------------------------- ingest
    def landed(self, source: str, days: Iterable[dt.date] | None = None) -> DataFrame:
        """Landed records of ``days`` (all when None).

        Only the files of those days are listed and read: a raw array
        ``<source>_<day>.json`` and/or a ``dt=<day>`` folder of JSON lines.
        """
        base = f"{self.landing_root}/source={source}"
        if days is None:
            return read_landing(self.spark, source, base)
        alt = ",".join(str(d) for d in days)
        paths = self.lake.fs.glob(f"{base}/{source}_{{{alt}}}.json") + self.lake.fs.glob(f"{base}/dt={{{alt}}}")
        if not paths:
            return self.spark.createDataFrame([], read_landing_schema(source))
        return read_landing(self.spark, source, paths)

    def ingest(self, source: str, days: Iterable[dt.date] | None, on_duplicate: str = "fail", run_ts=None, on_missing: str = "fail"):
        """Read landed files of ``days`` (all when None), validate, collapse to
        one row per key, upsert into bronze. Returns the load result.

        Every requested day must hold records, as a day-by-day load demands:
        nothing is written if one has none, unless ``on_missing="skip"``,
        which logs that day's run as ``skipped``. The landed records are
        parsed once (kept while the checks and the write use them)."""
        days = list(days) if days is not None else None
        target = days[0] if days and len(days) == 1 else None
        with logged_run(self.log, DAG_DAILY, f"ingest_{source}", target_date=target) as run:
            raw = self.landed(source, days).persist()
            try:
                found = batch_profile(source, raw)
                if found.records == 0:
                    raise EmptyBatchError(f"landing {source} {days}: empty batch, nothing written")
                absent = sorted(set(days or ()) - found.days)
                if absent and on_missing != "skip":
                    raise EmptyBatchError(f"landing {source}: empty batch for {', '.join(map(str, absent))}, nothing written")
                rows = with_provenance(source, raw, prepare_batch(source, raw, on_duplicate, found))
                result = upsert_bronze(self.lake, source, rows, _ts(run_ts))
            finally:
                raw.unpersist()
            result.rows_processed, result.missing_days = found.records, absent
            run.set(
                rows_processed=found.records,
                rows_loaded=result.rows_loaded,
                rows_deduplicated=found.records - result.rows_loaded,
            )
        if target is None and days:
            self.log_days(f"ingest_{source}", days, absent)
        return result

    def log_days(self, task_id: str, days: list[dt.date], absent: list[dt.date]) -> None:
        """One finished run per day of a range load, so day coverage sees it."""
        now = dt.datetime.now(dt.timezone.utc)
        blank = dict.fromkeys(f.name for f in RUN_LOG.fields)
        rows = [
            {**blank, "run_id": str(uuid.uuid4()), "event_time": now, "dag_id": DAG_DAILY, "task_id": task_id,
             "target_date": d, "seq": 1, "status": "skipped" if d in absent else "success"}
            for d in days
        ]
        self.spark.createDataFrame(rows, RUN_LOG).coalesce(1).write.mode("append").parquet(self.log.path)

    # ------------------------------------------------------------ reference
    def load_stations(self, kind: str, path: str, run_ts=None) -> int:
        """UPS-3/4: upsert-if-changed of a station seed; returns changed rows."""
        name = f"ref.{kind}_stations"
        reader = read_hydro_stations if kind == "hydro" else read_meteo_stations
        check = HYDRO_STATION_CHECK if kind == "hydro" else METEO_STATION_CHECK
        with logged_run(self.log, DAG_SEED, f"load_{kind}_stations", source_file=path) as run:
            # a code that the file repeats: its last row counts, as row-by-row upserts end
            place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
            incoming = latest_revision(reader(self.spark, path, place), ["station_code"], "_place").drop("_place")
            incoming = incoming.withColumn("loaded_at", _ts(run_ts))
            current = self.lake.read(name)
            if current is None:
                classified = incoming.withColumn("_action", F.lit("insert"))
            else:
                classified = classify_changes(current, incoming, ["station_code"], check, _ts(run_ts))
            classified = classified.persist()
            changed = changed_count(classified)
            if changed:
                out = classified.drop("_action")
                required = [f.name for f in (HYDRO_STATIONS if kind == "hydro" else METEO_STATIONS).fields if not f.nullable]
                enforce(name, out, Constraints(["station_code"], required))
                self.lake.write_version(name, out)
            classified.unpersist()
            run.set(rows_processed=changed, rows_loaded=changed)
        return changed

    def refresh_proximity(self, hydro_changed: int, meteo_changed: int, run_ts=None) -> int:
        """JOB-4 gate + PRX-1 + UPS-5. Returns rows upserted (0 if skipped)."""
        current = self.lake.read("ref.station_proximity")
        if hydro_changed == 0 and meteo_changed == 0 and current is not None and not current.isEmpty():
            return 0
        with logged_run(self.log, DAG_SEED, "refresh_proximity") as run:
            new = proximity_matrix(
                self.lake.read("ref.hydro_stations"), self.lake.read("ref.meteo_stations"), PROXIMITY_K
            ).withColumn("loaded_at", _ts(run_ts))
            merged = new if current is None else merge_rows(current.select(*new.columns), new, PROXIMITY_KEY)
            required = [f.name for f in PROXIMITY.fields if not f.nullable]
            enforce("ref.station_proximity", merged, Constraints(PROXIMITY_KEY, required, {"proximity_rank": (1, PROXIMITY_K)}))
            self.lake.write_version("ref.station_proximity", merged)
            n = new.count()
            run.set(rows_loaded=n)
        return n

    def snapshot(self, as_of: dt.datetime | None = None) -> None:
        """SCD-1/2: one check-strategy snapshot of both station tables."""
        as_of_col = _ts(as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        for kind, check in (("hydro", HYDRO_STATION_CHECK), ("meteo", METEO_STATION_CHECK)):
            current = self.lake.read(f"ref.{kind}_stations")
            if current is None:
                continue
            hist = self.lake.read(f"snapshots.snap_{kind}_stations")
            if hist is not None and scd2_pending_changes(hist, current, ["station_code"], check).isEmpty():
                continue  # nothing to version: keep the current history as is
            out = scd2_apply(hist, current, ["station_code"], check, as_of_col)
            self.lake.write_version(f"snapshots.snap_{kind}_stations", out)

    def run_seed(self, hydro_csv: str, meteo_csv: str, as_of: dt.datetime | None = None) -> dict:
        """JOB-2: both station loads -> gated proximity -> snapshots."""
        h = self.load_stations("hydro", hydro_csv, as_of)
        m = self.load_stations("meteo", meteo_csv, as_of)
        p = self.refresh_proximity(h, m, as_of)
        self.snapshot(as_of)
        return {"hydro_changed": h, "meteo_changed": m, "proximity_rows": p}

    # --------------------------------------------------------- silver/gold
    def silver_hydro_frame(self, utc_days: list | None = None) -> DataFrame | None:
        """SIL-1 over bronze.hydro for the given UTC days (all when None)."""
        bh = self.lake.read("bronze.hydro") if utc_days is None else self.lake.read_partitions("bronze.hydro", utc_days)
        if bh is None:
            return None
        # before the first seed the reference tables exist but are empty
        stations = self._read_or_empty("ref.hydro_stations", HYDRO_STATIONS)
        hist = self._read_or_empty("snapshots.snap_hydro_stations", HYDRO_HISTORY)
        most = hist.groupBy("station_code").count().agg(F.max("count")).first()[0] or 0
        return silver_hydro(bh, hist, stations, VALID_FROM, VALID_TO, most > LONG_HISTORY).withColumn("dt", F.to_date("timeline_ts_utc"))

    def _read_or_empty(self, name: str, schema) -> DataFrame:
        df = self.lake.read(name)
        return self.spark.createDataFrame([], schema) if df is None else df

    def silver_meteo_frame(self, utc_days: list | None = None) -> DataFrame | None:
        """SIL-2 for the given UTC days: local calendar days from the day before
        to the day after hold a UTC day's hours whatever the zone, so those
        are read and the result is cut back to the requested days."""
        if utc_days is None:
            bm = self.lake.read("bronze.meteo")
        else:
            local = around(utc_days)
            bm = self.lake.read_partitions("bronze.meteo", local)
        if bm is None:
            return None
        sm = silver_meteo(bm).withColumn("dt", F.to_date("observation_ts"))
        if utc_days is not None:
            sm = sm.filter(F.col("dt").isin(utc_days))
        return sm

    def _empty_silver_meteo(self) -> DataFrame:
        empty = self.spark.createDataFrame([], METEO_RAW)
        return silver_meteo(empty).withColumn("dt", F.to_date("observation_ts"))

    def build_silver(self, utc_days: list | None = None) -> None:
        """SIL-1/2 for the given UTC days (all when None)."""
        sh = self.silver_hydro_frame(utc_days)
        if sh is not None:
            self.lake.overwrite_partitions("silver.hydro", sh)
        sm = self.silver_meteo_frame(utc_days)
        if sm is not None:
            self.lake.overwrite_partitions("silver.meteo", sm)
            self.build_station_names(utc_days)

    def build_station_names(self, utc_days: list | None = None) -> None:
        """Exact (code, name) pairs of silver.meteo per month: gold's name
        lookup reads this small table instead of scanning all weather
        history. Rebuilt days recompute the months that contain them (two
        columns of those months' silver.meteo folders)."""
        if utc_days is None:
            sm = self.lake.read("silver.meteo")
        else:
            months = sorted({f"{d:%Y-%m}" for d in utc_days})
            sm = self.lake.read_partitions("silver.meteo", [f"{m}-*" for m in months])
        if sm is None:
            return
        names = sm.select("jaam_kood", "jaam_nimi", F.date_format("dt", "yyyy-MM").alias("month")).distinct()
        self.lake.overwrite_partitions("silver.meteo_station_names", names)

    def gold_frame(self, utc_days: list | None = None) -> DataFrame | None:
        """GLD-1 over the stored silver tables for the given UTC days."""
        if utc_days is None:
            sh, sm = self.lake.read("silver.hydro"), self.lake.read("silver.meteo")
        else:
            sh = self.lake.read_partitions("silver.hydro", utc_days)
            sm = self.lake.read_partitions("silver.meteo", utc_days)
        if sh is None:
            return None
        if sm is None:  # no weather for these days: gauge rows still come out (left joins)
            sm = self._empty_silver_meteo()
        names = self.lake.read("silver.meteo_station_names")
        if names is None:  # built before the name table existed: use all weather days
            names = self.lake.read("silver.meteo") or sm
        return gold_hydro_meteo(
            sh,
            sm,
            self._read_or_empty("ref.station_proximity", PROXIMITY),
            self._read_or_empty("ref.meteo_stations", METEO_STATIONS),
            meteo_names_from=names,
        ).withColumn("dt", F.to_date("timeline_ts_utc"))

    def build_gold(self, utc_days: list | None = None) -> None:
        """GLD-1 for the given UTC days (all when None)."""
        gold = self.gold_frame(utc_days)
        if gold is not None:
            self.lake.overwrite_partitions("gold.hydro_meteo", gold)
            self.report_hours(utc_days)

    def report_hours(self, utc_days: list | None = None) -> None:
        """DQ-6 as a stored report: the gauge hours that gold holds more than
        once (``gold.repeated_hours``, by day), of the built days."""
        stored = self.lake.read("gold.hydro_meteo") if utc_days is None else self.lake.read_partitions("gold.hydro_meteo", utc_days)
        if stored is None:
            return
        found = violations(stored, Constraints(["dt", "hydro_station_code", "timeline_ts_utc"])).select(
            F.split("key", r"\|")[1].cast("int").alias("hydro_station_code"), F.split("key", r"\|")[2].cast("timestamp").alias("timeline_ts_utc"),
            "n_rows", F.split("key", r"\|")[0].cast("date").alias("dt"),
        )
        # a day without repeats gets a row without a gauge: it replaces what the last build found
        clean = stored.select("dt").distinct().select(F.lit(None).cast("int").alias("hydro_station_code"), F.lit(None).cast("timestamp").alias("timeline_ts_utc"), F.lit(0).cast("long").alias("n_rows"), "dt")
        self.lake.overwrite_partitions("gold.repeated_hours", found.unionByName(clean))

    def build(self, utc_days: list | None = None, as_of: dt.datetime | None = None) -> None:
        """Model build: snapshots, then silver, then gold.

        The stored tables become those of a full build (``utc_days`` None
        makes one). Built are the given days, all days that bronze writes have
        touched since a build covered them (the ledger), and the days that a
        change of the reference tables reaches: the tables' versions and the
        weather stations' names that the last build used are compared with
        the current ones (``impact``). Without a trace of that build every day
        is built."""
        with logged_run(self.log, DAG_DAILY, "build"):
            self.snapshot(as_of)
            marks = self.lake.ledger.marks()
            built = json.loads(self.lake.fs.read_text(self._built_path) or "{}")
            versions = {n: self.lake.current_version(n) for n in REFERENCE_TABLES}
            silver_days = self._silver_days(utc_days, marks, built.get("versions"), versions)
            self.build_silver(silver_days)
            names = self._keep_names(built.get("names"))
            gold_days = None if silver_days is None else self._gold_days(silver_days, built, versions, names)
            self.build_gold(gold_days)
            self.lake.fs.write_text(self._built_path, json.dumps({"versions": versions, "names": names}))
            self.lake.ledger.clear(marks)

    @property
    def _built_path(self) -> str:
        return f"{self.root}/tables/_BUILT"

    def _silver_days(self, given: list | None, marks: list, old: dict | None, new: dict) -> list | None:
        """UTC days of silver to build: given, touched by bronze writes, or
        reached by a change of gauges or their history. None: all."""
        if given is None or old is None:
            return None
        days = set(given)
        for m in marks:
            days |= set(m.days if m.table == "bronze.hydro" else around(m.days))
        changed = [n for n in ("ref.hydro_stations", "snapshots.snap_hydro_stations") if old.get(n) != new[n]]
        stored = self.lake.read("silver.hydro")
        if changed and stored is not None:
            before, now = ({n: self._version_or_empty(n, v.get(n)) for n in changed} for v in (old, new))
            if any(x is None for x in (*before.values(), *now.values())):
                return None
            history = self._read_or_empty("snapshots.snap_hydro_stations", HYDRO_HISTORY)
            spans = [impact.history_changes(before[n], now[n]) if n.startswith("snap") else impact.fallback_changes(before[n], now[n], history) for n in changed]
            days |= set(impact.reading_days(stored, reduce(DataFrame.union, spans)))
        return sorted(days)

    def _gold_days(self, silver_days: list, built: dict, versions: dict, names: str | None) -> list | None:
        """The days of silver built now, and those of gauges for which the
        weather side has changed. None: all."""
        parts = {"proximity": "ref.station_proximity", "stations": "ref.meteo_stations"}
        old = {k: built["versions"].get(n) for k, n in parts.items()} | {"names": built.get("names")}
        new = {k: versions[n] for k, n in parts.items()} | {"names": names}
        stored = self.lake.read("silver.hydro")
        if old == new or stored is None:
            return silver_days
        table = parts | {"names": NAMES_BUILT}
        frames = [{k: self._version_or_empty(table[k], v) for k, v in x.items()} for x in (old, new)]
        if any(f is None for x in frames for f in x.values()):
            return None
        gauges = impact.weather_changes(*frames)
        return sorted(set(silver_days) | set(impact.reading_days(stored, impact.always(gauges))))

    def _version_or_empty(self, name: str, version: str | None) -> DataFrame | None:
        """A version of a table, empty where there was none yet; None if it
        has been pruned."""
        if version is None:
            return self.spark.createDataFrame([], BUILT_SCHEMAS[name])
        return self.lake.read_version(name, version)

    def _keep_names(self, last: str | None) -> str | None:
        """Version of the weather stations' distinct names as gold uses them;
        a new one only if they have changed."""
        names = self.lake.read("silver.meteo_station_names")
        if names is None:
            return last
        pairs = names.select("jaam_kood", "jaam_nimi").distinct()
        before = self.lake.read_version(NAMES_BUILT, last)
        if before is not None and impact.differing(before, pairs).isEmpty():
            return last
        return self.lake.write_version(NAMES_BUILT, pairs)

    # ----------------------------------------------------------------- jobs
    def run_day(self, day: dt.date, as_of: dt.datetime | None = None, on_duplicate: str = "fail") -> dict:
        """JOB-1: ingest both sources of one local day, then build.

        The build starts only when both ingests succeed; it rebuilds the UTC
        days the two loads touched, and those that earlier loads left unbuilt.
        """
        h = self.ingest("hydro", [day], on_duplicate, as_of)
        m = self.ingest("meteo", [day], run_ts=as_of)
        touched = sorted(set(h.days) | set(around(m.days)))
        self.build(touched, as_of)
        return {"hydro_rows": h.rows_loaded, "meteo_rows": m.rows_loaded, "days": touched}

    def run_scheduled(self, interval_start: dt.date, lag_days: int = SOURCE_LAG_DAYS, **kw) -> dict:
        """JOB-1 as scheduled: a run starting at ``interval_start`` loads the
        day ``interval_start - lag_days``."""
        return self.run_day(target_date(interval_start, lag_days), **kw)

    def run_range(
        self, start: dt.date, end: dt.date, as_of: dt.datetime | None = None, on_duplicate: str = "fail", on_missing: str = "fail"
    ) -> dict:
        """JOB-3: backfill ``[start, end]`` in one pass: all files at once,
        later files win per key (same result as day-by-day ascending), one
        upsert per table, one build of the touched days. A day without
        records fails the load; ``on_missing="skip"`` loads the others and
        returns the missing days."""
        days = [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]
        h = self.ingest("hydro", days, on_duplicate, as_of, on_missing)
        m = self.ingest("meteo", days, run_ts=as_of, on_missing=on_missing)
        touched = sorted(set(h.days) | set(around(m.days)))
        self.build(touched, as_of)
        missing = {"hydro": h.missing_days, "meteo": m.missing_days}
        return {"hydro_rows": h.rows_loaded, "meteo_rows": m.rows_loaded, "days": touched, "missing": missing}
