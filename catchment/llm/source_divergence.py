"""How far the sources of each language differ in their words.

Each task runs its texts through an Arrow compute pipeline (``ascii_lower``,
``split_pattern_regex``, ``dictionary_encode``, hash ``group_by``) and returns
counts per (language, source, term), merged over the task's batches while they
fit in memory. Spark adds them up. The terms that a language keeps are dealt
to shards by their hash, with all sources' counts of a term in one shard; a
shard becomes dense matrices (sources x terms) from which numpy computes the
divergences of all pairs of sources and the terms that lead in each source.

A term's share in a group is p = 1 + floor(SCALE * (count + 1) / (N + V)), N
the group's count over the language's V kept terms, and the divergence of p
from q is floor((p - q)^2 / q), all in whole numbers (exact while a group
holds fewer than 9 * 10^15 terms).

Defined cases: null text, language or source count as ''; a group without
terms has the share of a count of 0 everywhere; a language without kept terms
gives pairs of value 0 and no terms; a repeated row counts as a document of
its own; no rows, no result. Extra columns are not read. A text is split as a
whole, so a task holds the longest text's terms at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, give_back, ship, stage, unstage

# Everything but ASCII letters and characters beyond ASCII.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 10**9
MIN_DOCS = 3  # documents of its language in which a kept term stands
TOP_TERMS = 200
HELD_ROWS = 1_000_000  # counts that a task merges before it returns them
SHARD_ROWS = 200_000  # about so many counts go to one shard
CELLS = 1 << 21  # of a dense matrix

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _count(batch: pa.RecordBatch) -> pa.Table:
    """Counts of one piece of a batch (lang, source, text)."""
    text = pc.ascii_lower(pc.fill_null(batch["text"], ""))
    lists = pc.split_pattern_regex(text, pattern=BETWEEN)
    terms, row = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.not_equal(terms, "")
    coded = terms.filter(full).dictionary_encode()
    group = pa.table({"lang": batch["lang"], "source": batch["source"]})
    names = group.group_by(["lang", "source"], use_threads=False).aggregate([])
    key = {pair: i for i, pair in enumerate(zip(names["lang"].to_pylist(), names["source"].to_pylist(), strict=True))}
    of_row = pa.array([key[p] for p in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), strict=True)], pa.int32())
    each = pa.table({"row": row.filter(full), "term": coded.indices}).group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    each = pa.table({"group": of_row.take(each["row"]), "term": each["term"], "n": each["count_all"]})
    total = each.group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    found = pa.table(
        [names["lang"].take(total["group"]), names["source"].take(total["group"]), coded.dictionary.take(total["term"]), total["n_sum"], total["n_count"]],
        schema=_COUNTS,
    )
    zero = pa.array(np.zeros(len(names), np.int64))
    seen = pa.table([names["lang"], names["source"], pa.nulls(len(names), pa.string()), zero, zero], schema=_COUNTS)
    return pa.concat_tables([seen, found])


def _merge(parts: list[pa.Table]) -> pa.Table:
    one = pa.concat_tables(parts).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return one.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(_COUNTS.names).cast(_COUNTS)


def _task_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: list[pa.Table] = []
    rows = 0
    for batch in batches:
        at = 0
        for text in chunks(batch["text"]):
            parts.append(_count(batch.slice(at, len(text))))
            at += len(text)
            rows += len(parts[-1])
            if rows > HELD_ROWS:
                parts = [_merge(parts)]
                rows = len(parts[0])
                if rows > HELD_ROWS // 2:
                    yield from parts.pop().to_batches(max_chunksize=50_000)
                    rows = 0
    if parts:
        yield from _merge(parts).to_batches(max_chunksize=50_000)
    give_back()


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, term, docs (documents that hold it), total (occurrences) and
    ``per``, its occurrences by source; a row with a null term lists all of a
    language's sources. Tasks' counts cross the network once, dealt by term;
    ``per`` holds one entry per source."""
    ship(docs.sparkSession)
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))]
    found = docs.select(*named, F.col(text_col).cast("string").alias("text")).mapInArrow(_task_counts, "lang string, source string, term string, n long, docs long")
    each = found.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    per = F.collect_list(F.struct("source", "n")).alias("per")
    return each.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), per)


def shares(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / (total + terms)), by long division."""
    d = total + terms
    q, r = np.divmod(count + 1, d)
    for _ in range(3):  # SCALE is 1000^3
        digit, r = np.divmod(r * 1000, d)
        q = q * 1000 + digit
    return q + 1


def _shard(n: np.ndarray, total: np.ndarray, sizes: np.ndarray, lang_size: int, kept: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a dense matrix (sources x terms): sums of all pairs' divergences and
    each source's own from the language (-1 where it does not lead)."""
    p = shares(n, sizes[:, None], kept)
    pairs = np.stack([((one - p) ** 2 // p).sum(axis=1) for one in p])
    q = shares(total, np.full(1, lang_size), kept)
    return pairs, np.where((n > 0) & (p > q), (p - q) ** 2 // q, -1)


_FOUND = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _diverge(counts: pa.Table, groups: pa.Table, top: int) -> pa.Table:
    """Partial sums and leading terms of one shard (language, bucket)."""
    groups = groups.sort_by("source")
    source, lang = groups["source"].combine_chunks(), groups["lang"][0]
    sizes, kept, lang_size = groups["size"].to_numpy(), groups["kept"][0].as_py(), groups["lang_size"][0].as_py()
    sums, out = np.zeros((len(source), len(source)), np.int64), []
    if len(counts):
        counts = counts.sort_by([("term", "ascending")])
        coded = counts["term"].combine_chunks().dictionary_encode()
        col = coded.indices.to_numpy()
        row = pc.index_in(counts["source"], value_set=source).to_numpy()
        n, total = counts["n"].to_numpy(), counts["total"].to_numpy()
        width = max(1, CELLS // len(source))
        best: list[list[tuple[int, int]]] = [[] for _ in range(len(source))]
        for start in range(0, len(coded.dictionary), width):
            a, b = np.searchsorted(col, [start, start + width])
            w = min(width, len(coded.dictionary) - start)
            dense, whole = np.zeros((len(source), w), np.int64), np.zeros(w, np.int64)
            dense[row[a:b], col[a:b] - start] = n[a:b]
            whole[col[a:b] - start] = total[a:b]
            pairs, own = _shard(dense, whole, sizes, lang_size, kept)
            sums += pairs
            for s in range(len(source)):
                lead = np.flatnonzero(own[s] >= 0)  # terms in order: a stable sort keeps ties in it
                lead = lead[np.argsort(-own[s][lead], kind="stable")[:top]]
                best[s] = sorted(best[s] + [(-int(own[s][i]), start + int(i)) for i in lead])[:top]
        for s, found in enumerate(best):
            item = coded.dictionary.take(pa.array([i for _, i in found], pa.int64()))
            k = len(found)
            out.append(pa.table([pa.repeat(lang, k), pa.repeat(source[s], k), pa.repeat("term", k), item, pa.array([-v for v, _ in found], pa.int64())], schema=_FOUND))
    i, j = np.nonzero(~np.eye(len(source), dtype=bool))
    pairs = [pa.repeat(lang, len(i)), source.take(pa.array(i)), pa.repeat("pair", len(i)), source.take(pa.array(j)), pa.array(sums[i, j])]
    return pa.concat_tables([pa.table(pairs, schema=_FOUND), *out])


def source_divergence(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS, top: int = TOP_TERMS
) -> DataFrame:
    """lang, source, part, item, value, rank: the divergence of each source
    from each other one of its language (part ``pair``, all of them) and of
    its leading terms from the language (part ``term``, ``top`` of them)."""
    counts = term_counts(docs, lang_col, source_col, text_col)
    kept = stage(counts.filter(F.col("term").isNull() | (F.col("docs") >= min_docs)), "source-terms")
    shards = kept.filter("term IS NOT NULL").select("lang", "term", "total", F.explode("per").alias("one")).select("lang", "term", "total", "one.source", "one.n")
    n_shards = 1 + shards.count() // SHARD_ROWS

    sizes = shards.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    by_lang = kept.filter("term IS NOT NULL").groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_size"))
    groups = kept.filter("term IS NULL").select("lang", F.explode("per.source").alias("source"))
    groups = groups.join(sizes, ["lang", "source"], "left").join(by_lang, "lang", "left").na.fill(0, ["size", "kept", "lang_size"])
    groups = stage(groups, "source-groups")
    dealt = groups.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))).groupBy("lang", "bucket")
    bucketed = shards.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(n_shards)).cast("int")).groupBy("lang", "bucket")
    found = bucketed.cogroup(dealt).applyInArrow(lambda c, g: _diverge(c, g, top), "lang string, source string, part string, item string, value long")
    # sums of the pairs; a term stands in one shard
    found = stage(found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")), "source-divergence")
    unstage(kept, groups)
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), F.col("item"))
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top)).select("lang", "source", "part", "item", "value", "rank")
