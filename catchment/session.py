"""Spark session settings the library relies on.

All time logic assumes the session time zone is UTC (the reference pins
its database session the same way), ANSI casts raise on bad input, and
partitioned tables are overwritten partition-by-partition.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings that change results or write safety; applied to any
# session handed to the library (including a caller's session).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_LTZ",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to an existing session (idempotent)."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and streaming checkpoints.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system) and must be set. Only a local session without it (tests)
    gets a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="catchment-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def get_spark(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "catchment",
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    Master, shuffle partitions and memory are the deployment's business:
    nothing is set unless the caller passes it, so what ``spark-submit`` or
    ``spark-defaults.conf`` say stays in force.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        **REQUIRED_CONF,
        "spark.sql.ansi.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        **({"spark.sql.shuffle.partitions": str(shuffle_partitions)} if shuffle_partitions else {}),
        **(extra or {}),
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
