"""Token counts by a two-tier lookup, entirely on the map side.

Tier one is a broadcast hash table of frequent pre-tokens and their token
counts, of bounded size. Tier two is a cache in each Python worker: pre-tokens
that miss tier one are encoded once per worker, in batches, by the tokenizer
library itself. No pre-token is ever shuffled; counts do not depend on what
either tier holds, which only saves time.

Defined cases: a null or empty text has 0 tokens; a special string inside a
text is one token, as the library takes it; rows are counted one by one, so
repeated rows, null ids and extra columns change nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import worker_state

CACHE_ENTRIES = 1_000_000  # a worker's cache is emptied beyond this
TIER_ENTRIES = 65_536  # frequent pre-tokens that are broadcast
TIER_SAMPLE_ROWS = 4_000  # about so many documents choose them

def _tokenizer(path: str):
    from tokenizers import Tokenizer

    kept = worker_state("token_counts")
    if kept.get("path") != path:
        import json

        with open(path, encoding="utf-8") as f:
            special = [t["content"] for t in json.load(f)["added_tokens"]]
        kept.update(path=path, tok=Tokenizer.from_file(path), special=special, cache={})
    return kept


def _pieces(text: str, pattern, special: list[str]) -> tuple[list[str], int]:
    """Pre-tokens of a text and the number of special strings in it."""
    hits = 0
    if any(s in text for s in special):
        parts = regex.split("|".join(map(regex.escape, sorted(special, key=len, reverse=True))), text)
        hits = len(parts) - 1
        return [p for x in parts for p in pattern.findall(x)], hits
    return pattern.findall(text), hits


def _lengths(state: dict, pieces: list[str]) -> dict[str, int]:
    got = state["tok"].encode_batch(pieces, add_special_tokens=False)
    return dict(zip(pieces, map(len, got), strict=True))


def frequent_lengths(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> dict[str, int]:
    """Tier one: token counts of the pre-tokens most frequent in a sample of
    about TIER_SAMPLE_ROWS documents (TIER_ENTRIES at most)."""
    n = docs.count()
    if n == 0:
        return {}
    sample = docs.select(F.col(text_col).alias("text")).sample(min(1.0, TIER_SAMPLE_ROWS / n), seed=7)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pat, special, seen = regex.compile(pattern), _tokenizer(path)["special"], Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                seen.update(_pieces(text or "", pat, special)[0])
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["piece", "n"])

    counted = sample.mapInArrow(count, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    top = [r[0] for r in counted.filter("n > 1").orderBy(F.desc("n"), "piece").limit(TIER_ENTRIES).collect()]
    return _lengths(_tokenizer(path), top)


def token_count(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> Column:
    """Column of token counts for ``docs.text``."""
    tier = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, pattern, text_col))

    @F.arrow_udf("long")
    def count(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        state, pat, hot = _tokenizer(path), regex.compile(pattern), tier.value
        cache = state["cache"]
        for part in parts:
            out = []
            for a in range(0, len(part), 500):
                found = [_pieces(t or "", pat, state["special"]) for t in part.slice(a, 500).to_pylist()]
                if len(cache) > CACHE_ENTRIES:
                    cache.clear()
                missing = {p for ps, _ in found for p in ps if p not in hot and p not in cache}
                cache.update(_lengths(state, list(missing)))
                for ps, hits in found:
                    out.append(hits + sum(hot[p] if p in hot else cache[p] for p in ps))
            yield pa.array(out, pa.int64())

    return count(F.col(text_col))


def count_tokens(docs: DataFrame, path: str, pattern: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens and over_limit of each document."""
    n = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long")
    counted = docs.select(F.col(id_col), n.alias("n_bytes"), token_count(docs, path, pattern, text_col).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
