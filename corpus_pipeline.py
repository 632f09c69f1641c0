"""Corpus pipeline: raw documents to tokenised training text.

STAGES lists the stages in order; each is (name, function), and each function
takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` applies them to
the documents table; a stage's rows are written as Parquet to the shared
folder and read again as the next one's input, so a lost executor repeats one
stage at most; tables that a stage has done with are deleted. Every stage works on all that its predecessor kept, and all but
the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment.llm.byte_bpe import decode, encode, load_ranks
from catchment.llm.common import ship, staged_result, table, unstage
from catchment.llm.decontaminate import drop_contaminated
from catchment.llm.line_dedup import drop_repeated_lines
from catchment.llm.ngram_jaccard import one_per_component
from catchment.llm.quality_rules import keep_quality

# Near duplicates: word n-grams and the least similarity, NUM / DEN.
NGRAM, NUM, DEN = 5, 80, 100
# Line dedup: words from which a later run of one or two lines is deleted too.
LONG_WORDS = 50


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised quality rules keep."""
    ship(spark)
    return keep_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that earlier ones hold (three lines
    and more, LONG_WORDS words and more, or a whole document); those left
    without a word go. ``n_chars`` follows the text."""
    kept = drop_repeated_lines(docs, long_words=LONG_WORDS)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    ship(spark)
    return one_per_component(docs, NGRAM, NUM, DEN)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, decoded again: a text that its ids don't
    give back byte by byte fails the stage."""
    ship(spark)
    ranks = load_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    ids = docs.select("doc_id", "lang", "source", "text", encode(F.col("text"), ranks, public_tokenizers.PATTERN).alias("ids"))
    same = decode(F.col("ids"), ranks) == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    lost = F.raise_error(F.concat(F.lit("byte_bpe: the ids do not decode to the text of document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    return ids.select("doc_id", "lang", "source", F.when(same, F.col("ids")).otherwise(lost).alias("ids"), F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

# The label model and the byte-pair encoder have no SQL form; the tests hold
# run() against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, step in STAGES:
        docs = staged_result(lambda step=step, docs=docs: step(spark, docs, sf_dir), name)
        unstage(*before)  # the stage before has been read to its end
        before = [docs]
    return docs
