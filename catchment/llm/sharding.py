"""Sharding by jump consistent hashing.

A document's shard follows from a hash of its id and the number of shards
alone: no ring table, nothing to look up, and one more shard takes rows only
into itself. Slots number the rows of a shard without gaps.

Slots are dealt without sorting a shard in one task: rows fall into (shard,
bucket) cells of bounded size by a hash of the row, a small count table gives
each cell its first slot, and only a cell's rows are ranked together. Rows that
repeat id and text more often than a cell holds take the last slots of their
shard, in cells of their own by a hash of the stored row number; only which of
these equal rows takes which slot depends on that number. Texts stay in the
scan; id, size and checksum are all that is shuffled.

Defined cases: a null text has size 1 and the checksum of no bytes; a null id
is hashed as one fixed key; rows that repeat an id share its shard and take
one slot each; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

ROWS_PER_CELL = 100_000  # aim for the rows that are ranked together


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hash (Lamping and Veach) of 64-bit keys, all at once."""
    key = keys.astype(np.uint64)
    at = np.full(len(key), -1, np.int64)
    jump = np.zeros(len(key), np.int64)
    while (live := jump < shards).any():
        at[live] = jump[live]
        key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((key[live] >> np.uint64(33)).astype(np.float64) + 1.0)
        jump[live] = np.minimum((at[live] + 1) * step, float(1 << 62)).astype(np.int64)
    return at


def shard_of(key: Column, shards: int) -> Column:
    """Shard 0 .. ``shards`` - 1 of a 64-bit key column (already well mixed)."""

    @F.arrow_udf("int")
    def jump(k: pa.Array) -> pa.Array:
        return pa.array(jump_hash(k.to_numpy(zero_copy_only=False), shards).astype(np.int32))

    return jump(key)


def deal_cells(placed: DataFrame, shards: int) -> DataFrame:
    """``placed`` with the cell of each row."""
    cells = max(1, placed.count() // (shards * ROWS_PER_CELL))
    row = ["key", "text_crc32", "size"]
    many = placed.groupBy(*row).agg(F.count("*").alias("n")).filter(F.col("n") > ROWS_PER_CELL)
    many = stage(many.select(*row, F.ceil(F.col("n") / ROWS_PER_CELL).cast("long").alias("parts")), "shard-copies")
    # size and checksum spread the rows of one id over the cells too
    one = F.pmod(F.xxhash64(*row), F.lit(cells)).cast("int")
    part = F.pmod(F.xxhash64("row"), F.col("parts"))
    zero = F.lit(0).cast("long")
    rare = F.struct(one.alias("no"), *(zero.alias(c) for c in row), zero.alias("part"))
    own = F.struct(F.lit(cells).alias("no"), *(F.col(c).alias(c) for c in row), part.alias("part"))
    return placed.join(many, row, "left").withColumn("cell", F.when(F.col("parts").isNull(), rare).otherwise(own)).drop("parts")


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, law, shard, slot and grown_shard of each row."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    key = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("\0null")))
    rows = docs.select(
        F.col(id_col),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        key.alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )
    placed = stage(rows.withColumn("shard", shard_of(F.col("key"), shards)).withColumn("grown_shard", shard_of(F.col("key"), shards + 1)), "shards")
    placed = deal_cells(placed, shards)
    counts = placed.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rank = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("key", "text_crc32", "size", "row"))
    return (
        placed.withColumn("rank", rank)
        .join(first, ["shard", "cell"])
        .select(
            id_col, "size", "text_crc32", F.lit("key").alias("law"), "shard",
            (F.col("first") + F.col("rank") - 1).cast("long").alias("slot"), "grown_shard",
        )
    )
