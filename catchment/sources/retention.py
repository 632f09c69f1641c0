"""Raw-file retention (RET-1, FLT-5, TIM-7, TIM-8).

Raw landing files older than the retention window (by the date in their
name, not by modification time) are compressed into an archive laid out by
source / year / month / day of that date, then removed from the landing
area. Listing, date parsing, the split, and the archive write are Spark jobs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeconv import file_date
from ..schemas import RETENTION_DAYS
from .landing import RAW_SCHEMAS, read_landing
from .store import _FS


def list_raw_files(spark: SparkSession, raw_dirs: dict[str, str]) -> DataFrame:
    """``(source, file_name, file_path)`` for every file under each raw dir.

    Uses the binary-file source with only path columns selected, so file
    contents are not read.
    """
    frames = []
    for source, path in raw_dirs.items():
        try:
            df = (
                spark.read.format("binaryFile")
                .option("recursiveFileLookup", "true")  # raw files and dt=<day> folders side by side
                .load(path)
                .select(F.col("path").alias("file_path"))
            )
        except Exception as exc:  # directory does not exist: skip, as the reference does
            if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
                continue
            raise
        frames.append(
            df.select(
                F.lit(source).alias("source"),
                F.regexp_extract("file_path", r"([^/]+)$", 1).alias("file_name"),
                "file_path",
            )
        )
    if not frames:
        return spark.createDataFrame([], "source string, file_name string, file_path string")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def plan_retention(files: DataFrame, as_of, max_age_days: int = RETENTION_DAYS) -> DataFrame:
    """Classify raw files: ``archived`` / ``skipped`` / ``unrecognised``.

    Only ``*.json`` files are considered; the cutoff is ``as_of - max_age``
    and a file dated on or after it is kept (``skipped``). Archived files get
    their target ``archive_year`` / ``archive_month`` from the file date.
    """
    as_of_col = F.lit(str(as_of)).cast("date") if not hasattr(as_of, "alias") else as_of
    cutoff = F.date_sub(as_of_col, max_age_days)
    d = file_date("file_name")
    if "file_path" in files.columns:
        # files of a landed dt=<day> folder take the folder's day
        day_dir = F.regexp_extract(F.col("file_path"), r"/dt=([0-9]{4}-[0-9]{2}-[0-9]{2})/[^/]+$", 1)
        d = F.coalesce(d, F.when(day_dir != "", F.try_to_timestamp(day_dir, F.lit("yyyy-MM-dd")).cast("date")))
    json_files = files.filter(F.col("file_name").endswith(".json"))
    outcome = (
        F.when(d.isNull(), F.lit("unrecognised"))
        .when(d >= cutoff, F.lit("skipped"))
        .otherwise(F.lit("archived"))
    )
    archived = outcome == F.lit("archived")
    return json_files.select(
        "*",
        d.alias("file_date"),
        outcome.alias("outcome"),
        F.when(archived, F.date_format(d, "yyyy")).alias("archive_year"),
        F.when(archived, F.date_format(d, "MM")).alias("archive_month"),
    )


def retention_counts(plan: DataFrame) -> DataFrame:
    """Counts per outcome (the reference's archived/skipped/unrecognised)."""
    return plan.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_files"))


def _unit_path() -> Column:
    """What is archived and deleted for a file, wherever it lies below the raw
    dir: the file itself, if its name is dated, else its ``dt=`` folder."""
    folder = F.regexp_extract("file_path", r"^(.*/dt=[0-9]{4}-[0-9]{2}-[0-9]{2})/[^/]+$", 1)
    return F.when(file_date("file_name").isNull() & (folder != ""), folder).otherwise(F.col("file_path"))


def archive_landing_files(
    spark: SparkSession,
    raw_dirs: dict[str, str],
    archive_root: str,
    as_of: dt.date | None = None,
    max_age_days: int = RETENTION_DAYS,
) -> dict[str, int]:
    """RET-1: move old landed days into an archive that reads back.

    The records of the archived days are written as gzip JSON lines under
    ``source=/year=/month=/dt=<day>/unit=<what was landed>`` by all tasks in
    parallel; :func:`catchment.sources.landing.read_landing` reads any part of
    it as it reads the landing area. Archiving the same file or folder again
    replaces it. The raw files of a day are deleted only when the archive
    holds as many records of each unit as were read. Only days and counts
    reach the driver. Returns the outcome counts.
    """
    as_of = as_of or dt.datetime.now(dt.timezone.utc).date()
    plan = plan_retention(list_raw_files(spark, raw_dirs), as_of, max_age_days)
    counts = {r["outcome"]: r["n_files"] for r in retention_counts(plan).collect()}
    old = plan.filter(F.col("outcome") == "archived").groupBy("source").agg(F.collect_set("file_date").alias("days"), F.collect_set(_unit_path()).alias("paths")).collect()
    fs = _FS(spark)
    for row in old:
        source = row["source"]
        folders = {p for p in row["paths"] if not p.endswith(".json")}
        paths = sorted(p for p in row["paths"] if p in folders or p.rpartition("/")[0] not in folders)
        records = read_landing(spark, source, paths)
        landed = [f.name for f in RAW_SCHEMAS[source].fields]
        unit = F.regexp_replace("landing_unit", "[=/]", "-").alias("unit")
        held = records.select(*landed, unit, F.lit(source).alias("source"), F.date_format("file_date", "yyyy").alias("year"),
                              F.date_format("file_date", "MM").alias("month"), F.col("file_date").cast("string").alias("dt"))
        parts = ["source", "year", "month", "dt", "unit"]
        (
            held.hint("rebalance", "dt", "unit")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "gzip")
            .option("ignoreNullFields", "false")
            .partitionBy(*parts)
            .json(archive_root)
        )
        days = ",".join(str(d) for d in sorted(row["days"]))
        stored = fs.glob(f"{archive_root}/source={source}/year=*/month=*/dt={{{days}}}")
        want = {(r["dt"], r["unit"]): r["n"] for r in held.groupBy("dt", "unit").agg(F.count(F.lit(1)).alias("n")).collect()}
        path = F.col("_metadata.file_path")
        back = spark.read.option("recursiveFileLookup", "true").text(stored).select(F.regexp_extract(path, "/dt=([^/]+)", 1).alias("dt"), F.regexp_extract(path, "/unit=([^/]+)", 1).alias("unit")) if stored else None
        got = {} if back is None else {(r["dt"], r["unit"]): r["n"] for r in back.groupBy("dt", "unit").agg(F.count(F.lit(1)).alias("n")).collect()}
        if any(got.get(k) != n for k, n in want.items()):
            raise RuntimeError(f"archive of {source} is missing records; raw files kept")
        for p in paths:
            fs.delete(p)
    return {k: counts.get(k, 0) for k in ("archived", "skipped", "unrecognised")}
