"""Station seed CSVs (SRC-8, SRC-9, STR-1..3).

Files are read as all-text columns (the hydro file carries a UTF-8 byte
order mark, which Spark's CSV reader drops), then typed: text is trimmed
where the reference trims, empty cells of nullable columns become NULL,
numbers are cast with ANSI semantics (bad text raises), and booleans are
``strip().lower() == 'true'``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import empty_to_null, text_flag
from ..schemas import DEC, HYDRO_STATION_COLS, METEO_STATION_COLS


def _read_text_csv(spark: SparkSession, path: str, cols: list[str], place: Column | None = None) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
        .option("nullValue", "\u0000")  # keep empty cells as '' so STR-2 is explicit
        .option("emptyValue", "")
        .csv(path)
    )
    return df if place is None else df.select(*cols, place.alias("_place"))


def _kept(text: DataFrame) -> list[str]:
    return ["_place"] if "_place" in text.columns else []


def clean_hydro_stations(text: DataFrame) -> DataFrame:
    """Type an all-text hydro station table (columns as in the seed)."""
    num = lambda c: empty_to_null(c).cast(DEC)
    return text.select(
        F.col("station_code").cast("int").alias("station_code"),
        F.col("station_category"),
        F.col("station_name"),
        empty_to_null("station_fullname").alias("station_fullname"),
        empty_to_null("water_body").alias("water_body"),
        empty_to_null("catchment_name").alias("catchment_name"),
        num("catchment_size_km2").alias("catchment_size_km2"),
        num("distance_from_mouth_km").alias("distance_from_mouth_km"),
        num("station_altitude_msl_m").alias("station_altitude_msl_m"),
        F.col("latitude").cast(DEC).alias("latitude"),
        F.col("longitude").cast(DEC).alias("longitude"),
        text_flag("is_active").alias("is_active"),
        *_kept(text),
    )


def clean_meteo_stations(text: DataFrame) -> DataFrame:
    """Type an all-text meteo station table; only ``altitude_m`` is nullable."""
    return text.select(
        F.col("station_code"),
        F.col("station_category"),
        F.col("station_name"),
        F.col("latitude").cast(DEC).alias("latitude"),
        F.col("longitude").cast(DEC).alias("longitude"),
        empty_to_null("altitude_m").cast(DEC).alias("altitude_m"),
        text_flag("is_active").alias("is_active"),
        *_kept(text),
    )


def read_hydro_stations(spark: SparkSession, path: str, place: Column | None = None) -> DataFrame:
    """SRC-8: hydro station seed -> typed table; ``place`` (an expression over
    the file rows) is carried as ``_place``, for the order of repeated codes."""
    return clean_hydro_stations(_read_text_csv(spark, path, HYDRO_STATION_COLS, place))


def read_meteo_stations(spark: SparkSession, path: str, place: Column | None = None) -> DataFrame:
    """SRC-9: meteo station seed -> typed table."""
    return clean_meteo_stations(_read_text_csv(spark, path, METEO_STATION_COLS, place))
