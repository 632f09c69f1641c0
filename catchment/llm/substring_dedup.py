"""Substring dedup by relative Lempel-Ziv parsing.

Every document is parsed against the documents with smaller ids. The index of
the reference is a table of phrases (``window`` consecutive words) with the
smallest id that holds each, in blocks by phrase hash; a factor is a maximal
stretch of phrases with the same source. Each phrase is looked up on its own,
so phrases that straddle a factor boundary are checked as well and no repeat
of ``window`` words is missed. The words of all factors are duplicate spans.

Most phrases occur once, and looking all of them up would move the corpus
several times. Of the ``k``-grams of each phrase the one of least hash is its
anchor, the same wherever the phrase stands; anchors, about a fifth of the
words, are counted first, and only phrases whose anchor stands in two
documents or more enter the index.

Anchors and phrases are pre-aggregated before each shuffle, and what is joined
is written first, so that both join sides are plain exchanges whose hot
partitions adaptive execution can split. What is gathered per document never
exceeds its words.

Defined cases: null and empty texts have no words; documents with fewer than
``window`` words lose nothing; a null id is smaller and larger than no other,
so such rows are unchanged and no reference; rows that share an id don't
repeat each other; an empty table gives no rows; extra columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, flat, give_back, mix, stage, unstage, window_hashes, words, worker_state

WINDOW = 13
GRAM = 5
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def _anchors(h: np.ndarray, doc: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of every phrase and the hash of its anchor."""
    at, gram = window_hashes(h, doc, k)
    if len(h) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = np.full(len(h), _MOST)
    least[at] = gram
    span = 1
    while span < window - k + 1:  # least of ``span`` grams from each start, doubled
        step = min(span, window - k + 1 - span)
        least[:-step] = np.minimum(least[:-step], least[step:])
        span += step
    start = np.flatnonzero(doc[: len(doc) - window + 1] == doc[window - 1 :])
    return start, least[start]


def anchors(text: Column, window: int, k: int) -> Column:
    """Array of the anchor hashes of a text."""

    @F.arrow_udf("array<bigint>")
    def of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker_state("substring_dedup")
        for part in parts:
            values, ends = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
            for texts in chunks(part):
                w = words(*flat(texts))
                start, anchor = _anchors(w.hashes(), w.doc, window, k)
                doc = w.doc[start]
                new = np.ones(len(start), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
                values.append(anchor[new].view(np.int64))
                ends.append(ends[-1][-1] + np.cumsum(np.bincount(doc[new], minlength=len(texts))))
            yield pa.ListArray.from_arrays(pa.array(np.concatenate(ends), pa.int32()), pa.array(np.concatenate(values)))
        give_back()

    return of(text)


def _member(anchor: np.ndarray, doc: np.ndarray, shared: pa.Array) -> np.ndarray:
    """Whether each anchor is in its own document's list."""
    size = np.diff(shared.offsets.to_numpy())
    values = shared.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    owner = np.repeat(np.arange(len(shared)), size)
    tag = lambda d: mix(d.astype(np.uint64) + np.uint64(1))
    return np.isin(anchor ^ tag(doc), values ^ tag(owner))


def phrases(docs: DataFrame, window: int, k: int) -> DataFrame:
    """(doc, key, at, id_a, id_b) of the phrases whose anchor is in the
    document's list ``shared``; reads (doc, key, text, shared)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in chunks(batch.column(2)):
                own = batch.slice(done, len(texts))
                done += len(texts)
                w = words(*flat(texts))
                h = w.hashes()
                start, anchor = _anchors(h, w.doc, window, k)
                hit = _member(anchor, w.doc[start], own.column(3))
                _, id_a = window_hashes(h, w.doc, window)
                _, id_b = window_hashes(mix(h), w.doc, window)
                doc = pa.array(w.doc[start][hit])
                cols = [
                    own.column(0).take(doc),
                    own.column(1).take(doc),
                    pa.array((start - w.bounds[w.doc[start]])[hit].astype(np.int32)),
                    pa.array(id_a[hit].view(np.int64)),
                    pa.array((id_b[hit] >> np.uint64(33)).astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=["doc", "key", "at", "id_a", "id_b"])

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.mapInArrow(of, f"doc {kind}, key bigint, at int, id_a bigint, id_b int")


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def duplicate_phrases(docs: DataFrame, window: int = WINDOW, k: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, key, at, source): every phrase that also stands in a document
    with a smaller id, and the smallest such id."""
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    every = stage(rows.select("doc", F.explode(anchors(F.col("text"), window, k)).alias("anchor")), "anchors")
    ends = every.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    twice = stage(ends.filter("low < high").select("anchor"), "shared-anchors")
    shared = every.join(twice, "anchor", "left_semi").groupBy("doc").agg(F.collect_set("anchor").alias("shared"))
    shared = stage(shared, "shared-by-document")
    unstage(every, twice)
    found = stage(phrases(rows.join(shared, "doc").select("doc", "key", "text", "shared"), window, k), "phrases")
    unstage(shared)
    index = found.groupBy("id_a", "id_b").agg(F.min("doc").alias("source"), F.max("doc").alias("last"))
    index = stage(index.filter("source < last").drop("last"), "phrase-index")
    later = stage(found.join(index, ["id_a", "id_b"]).filter("source < doc").select("doc", "key", "at", "source"), "repeats")
    unstage(found, index)
    return later


def factors(docs: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """(doc, key, factors): per document its factors (start, words, source),
    in order; a factor is a stretch of phrases with one source."""
    found = duplicate_phrases(docs, window=window, **options)
    rows = found.groupBy("doc", "key").agg(F.sort_array(F.collect_set(F.struct("at", "source"))).alias("p"))
    p, cut = F.col("p"), F.col("cut")

    def breaks(i: Column) -> Column:
        prior = p[F.greatest(i - 1, F.lit(0))]
        return (i == 0) | (prior["at"] + 1 != p[i]["at"]) | (prior["source"] != p[i]["source"])

    rows = rows.withColumn("cut", F.filter(F.sequence(F.lit(0), F.size("p") - 1), breaks))

    def factor(c: Column, j: Column) -> Column:
        last = F.when(j + 1 < F.size("cut"), cut[F.least(j + 1, F.size("cut") - 1)] - 1).otherwise(F.size("p") - 1)
        return F.struct(p[c]["at"].alias("start"), (p[last]["at"] - p[c]["at"] + window).alias("words"), p[c]["source"].alias("source"))

    return rows.select("doc", "key", F.transform("cut", factor).alias("factors"))


_STRIPPED = "clean string, n_words bigint, n_removed bigint"


def strip(text: Column, start: Column, length: Column) -> Column:
    """The words of a text outside the given spans, joined by one space, with
    the numbers of all and of removed words."""

    @F.arrow_udf(_STRIPPED)
    def of(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for texts, starts, lengths in parts:
            clean, n_words, n_removed = [], [], []
            for t, at, size in zip(texts.to_pylist(), starts.to_pylist(), lengths.to_pylist(), strict=True):
                own = _WORD.findall(t or "")
                keep = np.ones(len(own), bool)
                for a, n in zip(at or [], size or [], strict=True):
                    keep[a : a + n] = False
                n_words.append(len(own))
                n_removed.append(len(own) - int(keep.sum()))
                clean.append(" ".join(own if n_removed[-1] == 0 else [x for x, k in zip(own, keep, strict=True) if k]))
            cols = [pa.array(clean, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
            yield pa.StructArray.from_arrays(cols, names=["clean", "n_words", "n_removed"])

    return of(text, start, length)


def dedup_substrings(docs: DataFrame, window: int = WINDOW, k: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` as struct ``doc`` with its ``factors``, the text without their
    words (``clean``), ``n_words`` and ``n_removed``."""
    found = factors(docs, window=window, k=k, id_col=id_col, text_col=text_col).withColumnsRenamed({"doc": "_id", "key": "_key"})
    text = F.col("doc")[text_col]
    rows = docs.select(F.struct(*docs.columns).alias("doc"))
    joined = rows.join(found, (F.col("doc")[id_col] == F.col("_id")) & (text_key(text) == F.col("_key")), "left")
    cut = strip(text, F.col("factors.start"), F.col("factors.words"))
    return joined.select("doc", "factors", cut.alias("cut")).select("doc", "factors", "cut.*")
