"""URL filters: rules first, then naive Bayes over segmented host words.

A url's host and path are cut out; the longest rule that fits decides. Every
other url is judged by a multinomial naive Bayes model over the words of its
host and path. Host names run words together, so each alphabetic piece of a
host is first split by a unigram Viterbi segmentation whose word counts come
from the text of all pages.

Nothing is done twice for equal input and nothing large is broadcast: pages
are pre-aggregated to url shapes (host and path with digits masked), pieces to
distinct pieces; a piece's substrings are joined with the word counts, so each
segmentation sees only its own substrings. Only page counts per class reach
the driver.

No page is labelled, so the model is trained twice. ``BLOCK_WORDS`` only
start it: pages whose host holds one are taken as unwanted. The first model
learns from these labels with every block word left out of the features, so it
can use nothing but what stands beside them (``free`` of ``free-bets``). Pages
that it finds unwanted join the unwanted ones, and the second model, which sees
all words, gives the verdict. A class's word shares are mixed with those of all
pages (``MIX``), so a rare word says little and the odds do not depend on the
table's size.

Defined cases: a null url or one without ``://`` has an empty host and path;
it fits no rule and is judged by the class shares alone; html may be null or
empty; every row is judged for itself, so null and repeated page ids get a row
each; only the three named columns are read, so others may have any name; a
host's pieces are split whole, however long; without any block word on a host
everything outside the rules is allowed; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

# Fixed values: (action, host and path) of each rule.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
# Words that mark a host as unwanted when training starts.
BLOCK_WORDS = ["adult", "ads", "bets", "casino", "pills", "porn", "spam", "warez"]

LONGEST = 20  # letters of the longest word
MIX = 0.1  # weight of all pages' word shares in those of a class
SMOOTHING = 0.5  # pages added to each class
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SKIP = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.S)
_WORD = re.compile(r"[a-z]+")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct of the longest fitting rule and its action, else null."""
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))).otherwise(out)
    return out


def word_counts(pages: DataFrame, html_col: str) -> DataFrame:
    """(word, n) of the words of a-z in the text of all pages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for html in batch.column(0).to_pylist():
                seen.update(_WORD.findall(_SKIP.sub(" ", (html or "").lower())))
            seen = {w: n for w, n in seen.items() if len(w) <= LONGEST}
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    counted = pages.select(F.col(html_col).alias("html")).mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def viterbi(piece: str, counts: dict[str, int], total: int) -> list[str]:
    """The likeliest split of ``piece`` into words; a string that is no word
    costs as much again for each letter."""
    best, back = [0.0], [0]
    for end in range(1, len(piece) + 1):
        options = []
        for start in range(max(0, end - LONGEST), end):
            n = counts.get(piece[start:end])
            cost = -math.log(n / total) if n else math.log(total) + math.log(10) * (end - start)
            options.append((best[start] + cost, -start))
        cost, start = min(options)
        best.append(cost)
        back.append(-start)
    out, end = [], len(piece)
    while end:
        out.append(piece[back[end] : end])
        end = back[end]
    return out[::-1]


def segment(pieces: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(piece, words) of the distinct pieces in ``pieces.piece``."""
    n = F.length("piece")
    starts = F.sequence(F.lit(1), n)
    cut = F.transform(starts, lambda s: F.transform(F.sequence(F.lit(1), F.least(F.lit(LONGEST), n - s + 1)), lambda k: F.substring(F.col("piece"), s, k)))
    parts = pieces.select("piece", F.explode(F.array_distinct(F.flatten(cut))).alias("word"))
    known = parts.join(counts, "word").groupBy("piece").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    @F.arrow_udf("array<string>")
    def split(names: pa.Array, known: pa.Array) -> pa.Array:
        rows = zip(names.to_pylist(), known.to_pylist(), strict=True)
        return pa.array([viterbi(p, {x["word"]: x["n"] for x in k or []}, total) for p, k in rows], pa.list_(pa.string()))

    return pieces.join(known, "piece", "left").select("piece", split("piece", "known").alias("words"))


def naive_bayes(known: DataFrame, blocked: Column) -> tuple[DataFrame, float]:
    """(host, shape, odds) of the shapes with tokens, and the log odds of the
    classes alone: multinomial naive Bayes learned from ``known`` (host, shape,
    pages, tokens), where ``blocked`` tells the class."""
    rows = known.select("host", "shape", "pages", blocked.alias("blocked"), "tokens")
    pages_of = lambda wanted: F.coalesce(F.sum(F.when(wanted, F.col("pages"))), F.lit(0))
    bad, good = rows.agg(pages_of(F.col("blocked")), pages_of(~F.col("blocked"))).first()
    each = rows.select("host", "shape", "pages", "blocked", F.explode("tokens").alias("token"))
    weight = stage(each.groupBy("token").agg(pages_of(F.col("blocked")).alias("b"), pages_of(~F.col("blocked")).alias("a")), "token-weights")
    in_bad, in_good = (n or 0 for n in weight.agg(F.sum("b"), F.sum("a")).first())
    background = MIX * (F.col("b") + F.col("a")) / max(in_bad + in_good, 1)
    # a class without any tokens has the shares of all pages
    p_bad = (1 - MIX) * F.col("b") / in_bad + background if in_bad else background / MIX
    p_good = (1 - MIX) * F.col("a") / in_good + background if in_good else background / MIX
    odds = weight.select("token", F.log(p_bad / p_good).alias("odds"))
    prior = math.log((bad + SMOOTHING) / (good + SMOOTHING))
    scores = each.join(odds, "token").groupBy("host", "shape").agg(F.round(F.sum("odds") + prior, 6).alias("odds"))
    return stage(scores, "url-scores"), prior


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    block_words: list[str] = BLOCK_WORDS,
) -> DataFrame:
    """id, host, path, rule, verdict, p_block and p_unseeded (the first model's
    probability, to which the block words are unknown) of every page."""
    cut = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    cut = cut.withColumn("shape", F.regexp_replace(F.translate("path", UPPER, LOWER), "[0-9]+", "0"))
    rows = stage(cut, "urls")
    shapes = stage(rows.groupBy("host", "shape").agg(F.count("*").alias("pages")), "url-shapes")

    counts = stage(word_counts(pages, html_col), "word-counts")
    total = (counts.agg(F.sum("n")).first()[0] or 0) + 1
    # the marked words are words, whether or not the pages use them
    marked = pages.sparkSession.createDataFrame([(w, max(1, total // 10_000)) for w in block_words], "word string, n bigint")
    counts = counts.union(marked).groupBy("word").agg(F.max("n").alias("n"))

    pieces_of = F.filter(F.split("host", "[^a-z]+"), lambda x: x != "")
    hosts = shapes.select("host").distinct().withColumn("pieces", pieces_of)
    each = hosts.select("host", F.explode("pieces").alias("piece"))
    words = segment(each.select("piece").distinct(), counts, total)
    host_words = each.join(words, "piece").groupBy("host").agg(F.flatten(F.collect_list("words")).alias("words"))
    host_words = stage(host_words, "host-words")

    path_words = F.filter(F.split("shape", "[^a-z0-9]+"), lambda x: x != "")
    known = shapes.join(host_words, "host", "left").withColumn("words", F.coalesce("words", F.array().cast("array<string>")))
    seeds = F.array(*map(F.lit, block_words)).cast("array<string>")
    host_tokens = lambda x: F.transform(x, lambda w: F.concat(F.lit("host:"), w))
    path_tokens = F.transform(path_words, lambda w: F.concat(F.lit("path:"), w))
    known = known.select(
        "host",
        "shape",
        "pages",
        F.arrays_overlap("words", seeds).alias("seeded"),
        F.concat(host_tokens(F.filter("words", lambda w: ~F.array_contains(seeds, w))), path_tokens).alias("unseeded"),
        F.concat(host_tokens("words"), path_tokens).alias("tokens"),
    )
    known = stage(known, "url-tokens")

    first, first_prior = naive_bayes(known.drop("tokens").withColumnRenamed("unseeded", "tokens"), F.col("seeded"))
    first = first.withColumnRenamed("odds", "first")
    joined = known.join(first, ["host", "shape"], "left").withColumn("first", F.coalesce("first", F.lit(first_prior)))
    second, prior = naive_bayes(joined, F.col("seeded") | (F.col("first") >= 0))
    scores = joined.select("host", "shape", "first").join(second, ["host", "shape"], "left")
    judged = rows.join(scores, ["host", "shape"], "left").withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    p = 1 / (1 + F.exp(-F.coalesce("odds", F.lit(prior))))
    return judged.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("rule.rule").alias("rule"),
        F.coalesce(F.col("rule.action"), F.when(p >= 0.5, "block").otherwise("allow")).alias("verdict"),
        p.alias("p_block"),
        (1 / (1 + F.exp(-F.coalesce("first", F.lit(first_prior))))).alias("p_unseeded"),
    )
