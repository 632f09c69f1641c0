"""Line dedup by winnowing, in built-in functions only.

Lines are compared without outer ASCII white space; lines without a word don't
take part and are kept. Of every ``run`` consecutive lines of a document the
least line hash is the fingerprint, recorded when the choice moves on, so any
run of ``run`` lines that two places share leaves the same fingerprint in
both. Fingerprints recorded once in the corpus end there. Around the others
the match is extended both ways, a window of ``run`` lines at a time: a window
whose lines also stand earlier (by document id, then text hash, then position)
is a repeat, and the lines of repeats, which chain to runs of any length, are
deleted. The first place of every run stays whole.

With ``long_words`` a later run of fewer than ``run`` lines is deleted as well
when it has so many words or is all of its document. Such short runs are their
own fingerprints; those that are all of a document are also looked up among
the short runs of the others.

Counting is pre-aggregated before each shuffle; what is joined is written
first, so that both join sides are plain exchanges whose hot partitions
adaptive execution can split. No group of equal lines is gathered anywhere;
only one document's own line numbers are.

Defined cases: a null text stays null and an empty one empty; documents with
fewer than ``run`` lines with a word are unchanged unless ``long_words`` is
given; null ids come after all
others; rows that repeat id and text are the same document and get the same
result; an empty table gives no rows; extra columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

RUN = 3
SPACE = " \t\n\x0b\x0c\r"
GAP = r"[ \t\n\x0B\f\r]+"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_windows(docs: DataFrame, run: int, id_col: str, text_col: str) -> DataFrame:
    """(doc, key, fingerprint, fresh, id_a, id_b, lines) for every window."""
    kept = F.filter(
        F.transform(_lines(F.col(text_col)), lambda x, i: F.struct(i.alias("no"), F.btrim(x, F.lit(SPACE)).alias("line"))),
        lambda x: x["line"] != "",
    )
    hashed = F.transform(kept, lambda x: F.struct(x["no"].alias("no"), F.xxhash64(x["line"]).alias("h")))
    rows = docs.select(F.col(id_col).alias("doc"), text_key(F.col(text_col)).alias("key"), hashed.alias("seq")).filter(F.size("seq") >= run)
    rows = rows.select("doc", "key", F.col("seq.no").alias("no"), F.col("seq.h").alias("h"))
    h, no = F.col("h"), F.col("no")

    def least(i: Column) -> Column:
        m = F.least(*(h[i + j] for j in range(run))) if run > 1 else h[i]
        at = F.coalesce(*(F.when(h[i + j] == m, i + j) for j in reversed(range(run))))
        return F.struct(m.alias("print"), at.alias("at"))

    starts = F.sequence(F.lit(0), F.size("h") - run)
    rows = rows.withColumn("least", F.transform(starts, least))
    low = F.col("least")

    def window(i: Column) -> Column:
        fresh = F.when(i == 0, F.lit(True)).otherwise(low[i]["at"] != low[F.greatest(i - 1, F.lit(0))]["at"])
        return F.struct(
            i.alias("at"),
            low[i]["print"].alias("print"),
            fresh.alias("fresh"),
            F.xxhash64(*(h[i + j] for j in range(run))).alias("id_a"),
            F.xxhash64(F.lit(run), *(h[i + j] for j in reversed(range(run)))).alias("id_b"),
            F.array(*(no[i + j] for j in range(run))).alias("lines"),
        )

    return rows.select("doc", "key", F.inline(F.transform(starts, window)))


def short_windows(docs: DataFrame, run: int, id_col: str, text_col: str) -> DataFrame:
    """(doc, key, at, id_a, id_b, lines, words, whole) for every window of
    fewer than ``run`` lines; ``whole``: it is all of its document."""
    kept = F.filter(
        F.transform(_lines(F.col(text_col)), lambda x, i: F.struct(i.alias("no"), F.btrim(x, F.lit(SPACE)).alias("line"))),
        lambda x: x["line"] != "",
    )
    counted = F.transform(kept, lambda x: F.struct(x["no"].alias("no"), F.xxhash64(x["line"]).alias("h"), F.size(F.split(x["line"], GAP)).alias("words")))
    rows = docs.select(F.col(id_col).alias("doc"), text_key(F.col(text_col)).alias("key"), counted.alias("seq")).filter(F.size("seq") > 0)
    rows = rows.select("doc", "key", F.col("seq.no").alias("no"), F.col("seq.h").alias("h"), F.col("seq.words").alias("words"))
    h, no, words = F.col("h"), F.col("no"), F.col("words")

    def of_size(n: int) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size("h") - 1), lambda i: i + n <= F.size("h"))
        return F.transform(
            starts,
            lambda i: F.struct(
                i.alias("at"),
                F.xxhash64(*(h[i + j] for j in range(n))).alias("id_a"),
                F.xxhash64(F.lit(n), *(h[i + j] for j in reversed(range(n)))).alias("id_b"),
                F.array(*(no[i + j] for j in range(n))).alias("lines"),
                sum((words[i + j] for j in range(1, n)), words[i]).alias("words"),
                (F.size("h") == n).alias("whole"),
            ),
        )

    return rows.select("doc", "key", F.inline(F.concat(*(of_size(n) for n in range(1, run)))))


def _windows(docs: DataFrame, run: int, id_col: str, text_col: str, long_words: int | None) -> DataFrame:
    """The windows that are compared; ``may``: a later one is deleted."""
    windows = line_windows(docs, run, id_col, text_col).withColumn("may", F.lit(True))
    if long_words is None or run < 2:
        return stage(windows, "line-windows")
    short = short_windows(docs, run, id_col, text_col).withColumns({"print": F.col("id_a"), "fresh": F.lit(True)})
    few = F.col("words") < long_words
    own = short.filter(~few | F.col("whole")).withColumns({"may": F.lit(True), "whole": few})
    windows = stage(windows.withColumn("whole", F.lit(False)).unionByName(own.drop("words")), "line-windows")
    wholes = stage(windows.filter("whole").select("id_a", "id_b").distinct(), "line-wholes")
    windows = windows.drop("whole")
    if wholes.isEmpty():
        return windows
    inner = short.filter(few & ~F.col("whole")).drop("words", "whole").withColumn("may", F.lit(False))
    return windows.unionByName(stage(inner.join(wholes, ["id_a", "id_b"], "left_semi"), "line-inner"))


def repeated_lines(
    docs: DataFrame, run: int = RUN, id_col: str = "doc_id", text_col: str = "text", long_words: int | None = None
) -> DataFrame:
    """(doc, key, lines): numbers of the lines to delete from each document."""
    windows = _windows(docs, run, id_col, text_col, long_words)
    prints = windows.filter("fresh").groupBy("print").agg(F.count("*").alias("n")).filter("n > 1").select("print")
    near = stage(windows.join(stage(prints, "line-prints"), "print", "left_semi").drop("print", "fresh"), "line-matches")
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "key", "at")
    first = near.groupBy("id_a", "id_b").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = near.join(stage(first, "line-first"), ["id_a", "id_b"]).filter(F.col("may") & ~place.eqNullSafe(F.col("first")))
    numbers = later.select("doc", "key", F.explode("lines").alias("no"))
    return numbers.groupBy("doc", "key").agg(F.collect_set("no").alias("lines"))


def dedup_lines(docs: DataFrame, run: int = RUN, id_col: str = "doc_id", text_col: str = "text", long_words: int | None = None) -> DataFrame:
    """``docs`` as struct ``doc``, with ``clean`` (the text without repeated
    runs), ``n_lines`` (lines with a word) and ``n_removed``."""
    gone = repeated_lines(docs, run, id_col, text_col, long_words).select(
        F.col("doc").alias("_id"), F.col("key").alias("_key"), F.sort_array("lines").alias("_gone")
    )
    text = F.col("doc")[text_col]
    rows = docs.select(F.struct(*docs.columns).alias("doc"))
    joined = rows.join(gone, F.col("doc")[id_col].eqNullSafe(F.col("_id")) & (text_key(text) == F.col("_key")), "left")
    joined = joined.withColumn("_lines", _lines(text))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone")
    clean = F.when(F.col("_gone").isNull(), text).otherwise(F.array_join(F.transform(stay, lambda i: F.col("_lines")[i]), "\n"))
    worded = F.filter("_lines", lambda x: F.btrim(x, F.lit(SPACE)) != "")
    return joined.select(
        "doc",
        clean.alias("clean"),
        F.coalesce(F.size(worded), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


def drop_repeated_lines(
    docs: DataFrame, run: int = RUN, id_col: str = "doc_id", text_col: str = "text", long_words: int | None = None
) -> DataFrame:
    """The documents without repeated runs, same columns; documents of which
    every line with a word was deleted go."""
    rows = dedup_lines(docs, run, id_col, text_col, long_words).filter("n_removed = 0 or n_removed < n_lines")
    return rows.select(*(F.col("clean").alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns))
