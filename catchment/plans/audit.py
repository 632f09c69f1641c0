"""Run auditing (AUD-1..3, AGG-5).

The reference updates one log row in place. Here every state change is an
appended event (``running``, then ``success`` or ``error``), and the current
state of each run is a view over the events. Appends never rewrite data, so
concurrent writers and lost executors cannot corrupt the log.
"""

from __future__ import annotations

import datetime as dt
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import ConstraintError
from ..schemas import RUN_LOG, RUN_STATUSES

FINAL_STATES = ("success", "error", "skipped")


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


@dataclass
class RunLog:
    """AUD-1: append-only run events under ``path`` (Parquet)."""

    spark: SparkSession
    path: str

    def append(self, **event) -> None:
        row = {f.name: event.get(f.name) for f in RUN_LOG.fields}
        row["event_time"] = row["event_time"] or _now()
        if row["status"] not in RUN_STATUSES:
            raise ConstraintError(f"run log: status {row['status']!r}; nothing written")
        self.spark.createDataFrame([row], RUN_LOG).coalesce(1).write.mode("append").parquet(self.path)

    def compact(self) -> None:
        """Maintenance: rewrite the many one-event files as one version beside
        the log, then swap folders. Run it while no job is logging."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        fresh, old = f"{self.path}.{uuid.uuid4().hex}", f"{self.path}.old-{uuid.uuid4().hex}"
        self.read().coalesce(1).write.parquet(fresh)
        fs = path(self.path).getFileSystem(conf)
        fs.rename(path(self.path), path(old))
        fs.rename(path(fresh), path(self.path))
        fs.delete(path(old), True)

    def read(self) -> DataFrame:
        return self.spark.read.schema(RUN_LOG).parquet(self.path)

    def state(self) -> DataFrame:
        return run_state(self.read())


@dataclass
class RunHandle:
    run_id: str
    counters: dict = field(default_factory=dict)

    def set(self, **counters) -> None:
        self.counters.update(counters)


@contextmanager
def logged_run(log: RunLog, dag_id: str, task_id: str, target_date=None, source_file=None):
    """AUD-2: log ``running`` on entry, ``success`` or ``error`` on exit.

    The error is always recorded (the reference can lose it on an aborted
    transaction) and then re-raised.
    """
    handle = RunHandle(str(uuid.uuid4()))
    base = dict(run_id=handle.run_id, dag_id=dag_id, task_id=task_id, target_date=target_date, source_file=source_file)
    log.append(**base, status="running", seq=0)
    try:
        yield handle
    except Exception as exc:
        log.append(**base, status="error", seq=1, error_message=str(exc), **handle.counters)
        raise
    log.append(**base, status="success", seq=1, **handle.counters)


def run_state(events: DataFrame) -> DataFrame:
    """AUD-3: one row per run with its identity and latest status.

    ``started_at`` is the first event, ``finished_at`` the last event when
    the run is in a final state; status, counters and error text are the
    latest non-NULL values, the identity columns (``dag_id``, ``task_id``,
    ``target_date``, ``source_file``) the first. Events of equal time are
    ordered by ``seq``, then by status, so the result is the same on every
    run. Aggregates only (partial before the shuffle).
    """
    seq = F.col("seq") if "seq" in events.columns else F.lit(0)
    at = F.struct(F.col("event_time").alias("t"), seq.alias("s"), F.col("status").alias("k"))

    def pick(how, c: str):
        return how(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c)

    agg = events.groupBy("run_id").agg(
        *[pick(F.min_by, c) for c in ("dag_id", "task_id", "target_date", "source_file")],
        F.min("event_time").alias("started_at"),
        F.max("event_time").alias("_last_at"),
        *[pick(F.max_by, c) for c in ("status", "rows_processed", "rows_loaded", "rows_deduplicated", "error_message")],
        F.count(F.lit(1)).alias("n_events"),
    )
    finished = F.when(F.col("status").isin(*FINAL_STATES), F.col("_last_at")).alias("finished_at")
    cols = ["run_id", "dag_id", "task_id", "target_date", "source_file", "started_at", finished, "status"]
    return agg.select(*cols, "rows_processed", "rows_loaded", "rows_deduplicated", "error_message", "n_events")


def day_coverage(events: DataFrame, first_day, last_day, sources: dict[str, str]) -> DataFrame:
    """AUD-4: days of ``[first_day, last_day]`` without a successful load, per
    source (``{source: task_id}``); a run that ended in an error counts as
    missing, as does a day no run was made for."""
    spark = events.sparkSession
    names = spark.createDataFrame(sorted(sources.items()), "source string, task_id string")
    span = F.sequence(F.lit(str(first_day)).cast("date"), F.lit(str(last_day)).cast("date"))
    wanted = names.withColumn("target_date", F.explode(span))
    done = run_state(events).filter("status = 'success'").select("task_id", "target_date").distinct()
    return wanted.join(done, ["task_id", "target_date"], "left_anti").select("source", "target_date")
