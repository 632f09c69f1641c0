"""Benchmark decontamination by winnowing, in built-in functions only.

Words of both sides are hashed; of every ``span`` consecutive words the least
hash among their ``k``-grams is the span's fingerprint, the same on both sides
wherever the span occurs. Joining fingerprints therefore finds every shared
span; each match is then extended word by word: the spans of the document that
carry the fingerprint are compared whole (two k-gram hashes cover a span), and
overlapping spans merge into hit stretches of any length. Items shorter than
``span`` are one window each, compared at their own length, where winnowing
keeps every window.

The benchmark side is stored once; its two lookup tables are broadcast only
while their counted rows stay within BROADCAST_ROWS, else the same joins
shuffle. The document side is read once; only rows of matched spans and one
row per document leave the scan. What is grouped later is one document's
matches, never more than its words.

Defined cases: null and empty texts have no words; documents are judged row
by row, so null ids and repeated rows get a row each; items with a null id
mark words as hit but are not listed; repeated items count once per item id;
an empty benchmark or document table gives clean or no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

# What separates words, and the letters that are folded.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BROADCAST_ROWS = 1_000_000  # of three longs at most: some 50 MB as a hash table


def word_hashes(text: Column) -> Column:
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.transform(F.filter(F.split(folded, SEPARATORS), lambda w: w != ""), lambda w: F.xxhash64(w))


def _over(n: Column, make: Callable[[Column], Column]) -> Column:
    """[make(0), ..., make(n - 1)], empty for n <= 0."""
    return F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), make)


def _starts(df: DataFrame, hashes: str, span: int, k: int, short: list[int]) -> tuple[DataFrame, Column]:
    """``df`` with its k-gram hashes, and its windows as an array of (start,
    words, fingerprint, id_a, id_b)."""
    h, n = F.col(hashes), F.size(hashes)
    grams = _over(n - k + 1, lambda i: F.xxhash64(*(h[i + j] for j in range(k))))
    df = df.withColumn("grams", F.when(n >= span, grams))
    g = F.col("grams")

    def whole(i: Column) -> Column:
        least = F.least(*(g[i + j] for j in range(span - k + 1)))
        return _window(i, span, least, g[i], g[i + span - k])

    out = [F.when(n >= span, _over(n - span + 1, whole))]

    def few(m: int) -> Callable[[Column], Column]:
        def at(i: Column) -> Column:
            a = F.xxhash64(*(h[i + j] for j in range(m)), F.lit(m))
            b = F.xxhash64(F.lit(m), *(h[i + j] for j in reversed(range(m))))
            return _window(i, m, a, a, b)

        return at

    out += [F.when(n >= m, _over(n - m + 1, few(m))) for m in short]
    none = F.array().cast("array<struct<at:int,words:int,print:bigint,id_a:bigint,id_b:bigint>>")
    return df, F.concat(*(F.coalesce(x, none) for x in out))


def _window(at: Column, words: int, least: Column, a: Column, b: Column) -> Column:
    return F.struct(at.cast("int").alias("at"), F.lit(words).alias("words"), least.alias("print"), a.alias("id_a"), b.alias("id_b"))


def item_windows(bench: DataFrame, span: int, k: int, id_col: str, text_col: str) -> tuple[DataFrame, list[int]]:
    """Stored windows of all items, and the lengths of those below ``span``."""
    items = bench.select(F.col(id_col).cast("string").alias("item"), word_hashes(F.col(text_col)).alias("h"))
    n = F.size("h")
    lengths = items.filter((n > 0) & (n < span)).select(n.alias("n")).distinct().collect()  # span - 1 rows at most
    short = sorted(r[0] for r in lengths)
    items, windows = _starts(items, "h", span, k, short)
    found = items.select("item", n.alias("n"), F.inline(windows))
    found = found.filter(F.col("words") == F.least(F.col("n"), F.lit(span)))
    return stage(found.select("item", "words", "print", "id_a", "id_b").distinct(), "item-windows"), short


def find_contamination(
    docs: DataFrame,
    bench: DataFrame,
    carry: list[Column],
    span: int = 10,
    k: int = 5,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document: the carried columns, n_words, n_hit and the
    sorted ids of the items with a shared window."""
    if not k < span <= 2 * k:
        raise ValueError("two k-grams must cover a span: k < span <= 2 * k")
    windows, short = item_windows(bench, span, k, item_id, item_text)
    prints = windows.select(F.col("print").alias("p")).distinct()
    spans = windows.groupBy("words", "id_a", "id_b").agg(F.min("print").alias("print"))
    if windows.count() <= BROADCAST_ROWS:
        prints, spans = F.broadcast(prints), F.broadcast(spans)

    rows = docs.select(F.struct(*carry).alias("doc"), word_hashes(F.col(text_col)).alias("h"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows, own = _starts(rows, "h", span, k, short)
    # one row per document whatever matches: it carries the number of words
    head = F.array(_window(F.lit(-1), 0, F.lit(0).cast("long"), F.size("h").cast("long"), F.lit(0).cast("long")))
    each = rows.select("row", "doc", F.inline(F.concat(head, own)))
    each = each.select("row", F.when(F.col("at") < 0, F.col("doc")).alias("doc"), "at", "words", "print", "id_a", "id_b")
    near = each.join(prints, F.col("print") == F.col("p"), "left").filter((F.col("at") < 0) | F.col("p").isNotNull())
    matched = near.join(spans.withColumnRenamed("print", "q"), ["words", "id_a", "id_b"], "left")
    matched = stage(matched.filter((F.col("at") < 0) | F.col("q").isNotNull()).drop("p", "q", "print"), "matched-spans")

    hits = matched.filter("at >= 0")
    covered = F.aggregate(
        F.sort_array(F.collect_set(F.struct("at", "words"))),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, w: F.struct(
            F.greatest(acc["end"], w["at"] + w["words"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), w["at"] + w["words"] - F.greatest(acc["end"], w["at"]))).alias("n"),
        ),
        lambda acc: acc["n"].cast("long"),
    )
    per_doc = hits.groupBy("row").agg(covered.alias("n_hit"))
    shared = hits.select("row", "words", "id_a", "id_b").distinct().join(windows.select("item", "words", "id_a", "id_b"), ["words", "id_a", "id_b"])
    items = shared.filter("item is not null").groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return (
        matched.filter("at < 0")
        .join(per_doc, "row", "left")
        .join(items, "row", "left")
        .select(
            "doc.*",
            F.col("id_a").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def drop_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Documents without a shared window, all columns. Rows are matched back
    by id and a hash of the text, so rows without an id are judged alone."""
    text_key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    judged = find_contamination(docs, bench, [F.col(id_col).alias("_id"), text_key.alias("_key")], text_col=text_col, **options)
    bad = judged.filter("n_hit > 0").select("_id", "_key").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.struct(F.col(id_col).alias("id"), text_key.alias("key")).alias("own"))
    return rows.join(bad, F.col("own.id").eqNullSafe(F.col("_id")) & (F.col("own.key") == F.col("_key")), "left_anti").select("doc.*")
