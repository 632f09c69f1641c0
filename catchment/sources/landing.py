"""Raw landing files (SRC-1..7): one JSON array per source and day.

Files are named ``<source>_<YYYY-MM-DD>.json``. Spark's JSON source turns a
top-level array into one row per element, so a whole landing directory is
read in parallel with a declared schema (never inferred).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeconv import file_date
from ..schemas import HYDRO_RAW, METEO_RAW

RAW_SCHEMAS = {"hydro": HYDRO_RAW, "meteo": METEO_RAW}


def _json_reader(spark: SparkSession, schema: T.StructType):
    # recursive lookup: raw array files and dt=<day> folders may sit side by
    # side; partition discovery would silently skip the top-level files
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("mode", "FAILFAST")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]")
    )


def with_file_columns(df: DataFrame) -> DataFrame:
    """Add where each record was landed:

    * ``file_date``: the day in the file name (TIM-7), else of the ``dt=`` folder;
    * ``landing_unit``: what was landed at once - one raw array file, or all
      part files of a ``dt=`` folder together;
    * ``relanded_at``: modification time of a raw file, NULL for folders, so a
      raw file dropped beside a day's folder is the later landing of that day;
    * ``source_file`` and ``file_offset``: with ``record_pos`` the record order
      inside a landing unit.
    """
    day_dir = F.regexp_extract(F.col("_metadata.file_path"), r"dt=([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    landed_day = F.when(day_dir != "", day_dir.cast("date"))
    name = F.col("_metadata.file_name")
    in_folder = file_date(name).isNull() & landed_day.isNotNull()
    return df.select(
        *[F.col(c) for c in df.columns],
        name.alias("source_file"),
        F.col("_metadata.file_block_start").alias("file_offset"),
        F.when(in_folder, F.concat(F.lit("dt="), day_dir)).otherwise(name).alias("landing_unit"),
        F.when(~in_folder, F.col("_metadata.file_modification_time")).alias("relanded_at"),
        F.coalesce(file_date(name), landed_day).alias("file_date"),
    )


def with_record_pos(df: DataFrame) -> DataFrame:
    """Add ``record_pos``: increases in record order inside one file split, so
    (``source_file``, ``file_offset``, ``record_pos``) orders a landing unit."""
    return df.withColumn("record_pos", F.monotonically_increasing_id())


def read_landing(spark: SparkSession, source: str, path: str | list[str]) -> DataFrame:
    """SRC-1/2: read landed records with the declared schema.

    Adds the columns of :func:`with_file_columns` and ``record_pos``.
    Missing optional keys read as NULL; required ones are checked with
    :func:`catchment.operators.require_fields`.
    """
    df = _json_reader(spark, RAW_SCHEMAS[source]).json(path)
    df = df.select(*[f.name for f in RAW_SCHEMAS[source].fields])
    return with_record_pos(with_file_columns(df))


def read_landing_schema(source: str) -> T.StructType:
    """Schema of :func:`read_landing` output (for empty batches)."""
    return T.StructType(
        list(RAW_SCHEMAS[source].fields)
        + [
            T.StructField("source_file", T.StringType()),
            T.StructField("file_offset", T.LongType()),
            T.StructField("landing_unit", T.StringType()),
            T.StructField("relanded_at", T.TimestampType()),
            T.StructField("file_date", T.DateType()),
            T.StructField("record_pos", T.LongType()),
        ]
    )


def read_landing_stream(spark: SparkSession, source: str, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming twin of :func:`read_landing` (new files only; ``record_pos``
    is added per micro-batch)."""
    reader = spark.readStream.schema(RAW_SCHEMAS[source]).option("recursiveFileLookup", "true").option("mode", "FAILFAST").option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]"
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.json(path).select(*[f.name for f in RAW_SCHEMAS[source].fields])
    return with_file_columns(df)


def write_landing(df: DataFrame, root: str, source: str, day: dt.date | str) -> str:
    """SRC-7: land records of one source and day under ``<root>/source=<s>/dt=<day>``.

    JSON lines written by all tasks in parallel; a rerun of the same day
    replaces only that day's folder (dynamic partition overwrite), like the
    reference replacing its day file. Raw JSON-array files dropped by an
    external fetcher can sit next to these and are read the same way.
    """
    out = df.withColumn("source", F.lit(source)).withColumn("dt", F.lit(str(day)))
    out.hint("rebalance").write.mode("overwrite").partitionBy("source", "dt").option("ignoreNullFields", "false").json(root)
    return f"{root}/source={source}/dt={day}"


def write_landing_days(df: DataFrame, root: str, source: str, day_col: str = "dt") -> None:
    """SRC-7 for many days at once: one ``dt=<day>`` folder per value of
    ``day_col``; days present in ``df`` are replaced, others untouched."""
    out = df.withColumn("source", F.lit(source)).withColumn("dt", F.col(day_col).cast("date"))
    if day_col != "dt":
        out = out.drop(day_col)
    # day-aligned, advisory-sized output files (no tasks x days small files)
    out.hint("rebalance", "dt").write.mode("overwrite").partitionBy("source", "dt").option("ignoreNullFields", "false").json(root)


def filter_local_day(df: DataFrame, day: dt.date | str, col: str = "timeline_ts_local") -> DataFrame:
    """SRC-4: rows whose local timestamp lies in ``[day 00:00, day+1 00:00)``."""
    start = F.lit(str(day)).cast("date").cast("timestamp")
    end = F.date_add(F.lit(str(day)).cast("date"), 1).cast("timestamp")
    c = F.col(col)
    return df.filter((c >= start) & (c < end))


def calendar_day_predicate(day: dt.date | str) -> Column:
    d = dt.date.fromisoformat(str(day))
    return (F.col("aasta") == d.year) & (F.col("kuu") == d.month) & (F.col("paev") == d.day)


def filter_calendar_day(df: DataFrame, day: dt.date | str) -> DataFrame:
    """SRC-5: meteo rows of calendar day ``aasta/kuu/paev`` (pushed to the scan)."""
    return df.filter(calendar_day_predicate(day))
