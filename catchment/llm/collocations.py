"""Phrases whose words stand together more often than chance, per language.

Texts become blocks of word codes with a dictionary per block; a piece break
(``BREAKS``) is a gap that no phrase crosses. One level counts the phrases of
one more word: the entries of all blocks' dictionaries are added up, those
found ``least`` times get dense ids in order of frequency, and a block's codes
are replaced by these ids (an entry below is a gap). A phrase of k words is
the pair of the ids of its first and its last k - 1 words, so all levels from
the second on count pairs of ids. Pairs are dealt to square tiles of ids: a
block counts a tile with many pairs by ``bincount`` over all its cells, which
the frequency order makes the rule for common words, and all other tiles as
sorted coordinates. Frequent pairs are ranked again and are the ids of the
next level.

A pair's key is its tile and its cell, so sorted keys lie close together and
cross the network as packed differences, one row for each bucket of keys. No
dictionary is broadcast: blocks look their entries up bucket by bucket, and a
block's answers return to it alone, so memory depends on the size of a block
(BLOCK_WORDS words, or one text) and of a bucket (about BUCKET_KEYS keys), not
on the corpus. All counts are exact.

Defined cases: null text counts as empty, null language as ``und``; text
without words adds nothing; repeated rows count each; of equal scores the
more frequent, then the smaller phrase comes first; no phrases, no rows.
Extra columns are not read. A language may have 2^31 frequent phrases of a
length; more raise an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, flat, give_back, mix, ship, stage, unstage
from .runs import FOLD, byte_class, cut

BREAKS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"
MAX_WORDS = 5
LEAST = 100
TOP = 2000
CLOSED = 100  # percent of a phrase's places that a longer one must fill to replace it
BLOCK_WORDS = 1 << 20
HELD_WORDS = 2 << 20  # of all languages of a task together
HELD_KEYS = 1 << 20  # entries that a task adds up before it passes them on
BUCKET_KEYS = 1 << 20
TILE_BITS = 10
DENSE = 1 << 15  # pairs of a block from which a tile is counted cell by cell
ORDER_ROWS = 200_000  # entries of a range of the frequency order
TOP_SALT = 32

_BREAK = byte_class(BREAKS)
_WORD = ~(_BREAK | byte_class(SPACES))
_BLOCK = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("n", pa.int32()), ("words", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("codes", pa.binary())])
_BLOCK_DDL = "block long, lang string, n int, words long, keys binary, counts binary, codes binary"


def pack(x: np.ndarray) -> bytes:
    """Whole numbers, byte planes one after the other, compressed."""
    x = np.ascontiguousarray(x, "<i8" if x.dtype.itemsize == 8 else "<i4")
    planes = x.view(np.uint8).reshape(-1, x.dtype.itemsize).T
    return bytes([x.dtype.itemsize]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8).reshape(raw[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<i{raw[0]}").ravel()


class Words:
    """Sorted keys that are words: distinct, without a line feed."""

    ddl, kind = "string", pa.string()

    @staticmethod
    def pack(keys: pa.Array) -> bytes:
        return zstandard.ZstdCompressor(level=1).compress(b"\n".join(keys.to_pylist()))

    @staticmethod
    def unpack(raw: bytes) -> pa.Array:
        return pa.array(zstandard.ZstdDecompressor().decompress(raw).split(b"\n"), pa.large_binary())

    @staticmethod
    def buckets(keys: pa.Array, n: int) -> np.ndarray:
        h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in keys.to_pylist()), np.uint64, len(keys))
        return (h % np.uint64(n)).astype(np.int64)

    @staticmethod
    def take(keys: pa.Array, at: np.ndarray) -> pa.Array:
        return keys.take(pa.array(at))

    @staticmethod
    def add(keys: list[pa.Array], counts: list[np.ndarray]) -> tuple[pa.Array, np.ndarray]:
        one = pa.table([pa.chunked_array(keys), pa.array(np.concatenate(counts))], names=["k", "c"])
        one = one.group_by("k", use_threads=False).aggregate([("c", "sum")]).sort_by("k").combine_chunks()
        return one["k"].combine_chunks(), one["c_sum"].to_numpy()

    @staticmethod
    def column(keys: pa.Array) -> pa.Array:
        return keys.cast(pa.string())

    @staticmethod
    def find(keys: pa.Array, among: pa.ChunkedArray, ids: np.ndarray) -> np.ndarray:
        at = pc.index_in(keys, value_set=among.cast(pa.large_binary())).fill_null(-1).to_numpy()
        return np.append(ids, -1)[at].astype(np.int32)


class Pairs:
    """Sorted keys that are pairs of ids, tile by tile and cell by cell."""

    ddl, kind = "long", pa.int64()

    @staticmethod
    def pack(keys: np.ndarray) -> bytes:
        return pack(np.diff(keys, prepend=0))

    @staticmethod
    def unpack(raw: bytes) -> np.ndarray:
        return np.cumsum(unpack(raw))

    @staticmethod
    def buckets(keys: np.ndarray, n: int) -> np.ndarray:
        return (mix((keys >> TILE_BITS).astype(np.uint64)) % np.uint64(n)).astype(np.int64)  # a row of a tile stays together

    @staticmethod
    def take(keys: np.ndarray, at: np.ndarray) -> np.ndarray:
        return keys[at]

    @staticmethod
    def add(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        key, count = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        return key[first], np.add.reduceat(count[order], first) if len(first) else count

    @staticmethod
    def column(keys: np.ndarray) -> pa.Array:
        return pa.array(keys)

    @staticmethod
    def find(keys: np.ndarray, among: pa.ChunkedArray, ids: np.ndarray) -> np.ndarray:
        known = among.to_numpy()
        order = np.argsort(known)
        at = np.minimum(np.searchsorted(known, keys, sorter=order), len(known) - 1)
        return np.where(known[order][at] == keys, ids[order][at], -1).astype(np.int32)


def _codes(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct words of some texts and their codes, -1 between pieces."""
    raw, offsets = flat(texts)
    raw = FOLD[raw]
    w = cut(raw, offsets, _WORD)
    brk = np.cumsum(_BREAK[raw], dtype=np.int64)[w.begin] if len(w.begin) else w.begin
    fresh = np.zeros(len(w.code), bool)
    fresh[1:] = (brk[1:] != brk[:-1]) | (w.doc[1:] != w.doc[:-1])
    gaps = np.cumsum(fresh)
    out = np.full(len(w.code) + (int(gaps[-1]) if len(gaps) else 0), -1, np.int32)
    out[np.arange(len(gaps)) + gaps] = w.code
    return w.distinct, out


def _block(number: int, lang: str, kind: type, keys, counts: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
    row = [number, lang, len(counts), int(counts.sum()), kind.pack(keys), pack(counts.astype(np.int64)), pack(codes.astype(np.int32))]
    return pa.record_batch([pa.array([x], f.type) for x, f in zip(row, _BLOCK, strict=True)], schema=_BLOCK)


def _word_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a task's texts (lang, text), by language."""
    task = TaskContext.get().partitionId() << 32
    held: dict[str, list[tuple[pa.Array, np.ndarray]]] = {}
    sizes: dict[str, int] = {}
    made = 0

    def out(lang: str) -> pa.RecordBatch:
        nonlocal made
        parts = held.pop(lang)
        del sizes[lang]
        one = pa.chunked_array([p[0] for p in parts]).combine_chunks().dictionary_encode()
        order = pc.array_sort_indices(one.dictionary).to_numpy().astype(np.int64)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        to, at, codes = place[one.indices.to_numpy()], 0, []
        for distinct, code in parts:
            codes += [np.append(to[at : at + len(distinct)], -1)[code], [-1]]
            at += len(distinct)
        codes = np.concatenate(codes)
        made += 1
        counts = np.bincount(codes[codes >= 0], minlength=len(order))
        return _block(task + made - 1, lang, Words, one.dictionary.take(pa.array(order)), counts, codes)

    for batch in batches:
        langs = np.array(batch["lang"].to_pylist(), object)
        for lang in dict.fromkeys(langs):
            own = batch["text"].filter(pa.array(langs == lang))
            for texts in chunks(own):
                distinct, codes = _codes(texts)
                if not len(codes):
                    continue
                held.setdefault(lang, []).append((distinct, codes))
                sizes[lang] = sizes.get(lang, 0) + len(codes)
                if sizes[lang] >= BLOCK_WORDS:
                    yield out(lang)
        if sum(sizes.values()) >= HELD_WORDS:
            for lang in list(held):
                yield out(lang)
    for lang in list(held):
        yield out(lang)
    give_back()


def tally(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs as sorted keys, their counts, and which of them each
    pair is. A key's bits from the highest: tile of the left and of the right
    id, cell of the left and of the right id."""
    low = (1 << TILE_BITS) - 1
    tile = (left >> TILE_BITS) << (31 - TILE_BITS) | right >> TILE_BITS
    cell = (left & low) << TILE_BITS | right & low
    keys, counts, places = [], [], []
    rest = np.ones(len(left), bool)
    tiles, sizes = np.unique(tile, return_counts=True)
    for t in tiles[sizes >= DENSE]:
        own = np.flatnonzero(tile == t)
        full = np.bincount(cell[own], minlength=1 << 2 * TILE_BITS)
        at = np.flatnonzero(full)
        place = np.zeros(len(full), np.int64)
        place[at] = np.arange(len(at))
        rest[own] = False
        keys.append(t << 2 * TILE_BITS | at)
        counts.append(full[at])
        places.append((own, place[cell[own]]))
    own = np.flatnonzero(rest)
    key, place, full = np.unique(tile[own] << 2 * TILE_BITS | cell[own], return_inverse=True, return_counts=True)
    keys.append(key)
    counts.append(full)
    places.append((own, place))
    key = np.concatenate(keys)
    order = np.argsort(key)
    rank = np.empty(len(key), np.int64)
    rank[order] = np.arange(len(key))
    which, before = np.empty(len(left), np.int64), 0
    for k, (own, place) in zip(keys, places, strict=True):
        which[own] = rank[before + place]
        before += len(k)
    return key[order], np.concatenate(counts)[order], which


def halves(key: Column) -> tuple[Column, Column]:
    """Left and right id of a key."""
    low, high = (1 << TILE_BITS) - 1, (1 << (31 - TILE_BITS)) - 1
    join = lambda tile, cell: F.shiftleft(tile, TILE_BITS).bitwiseOR(cell.bitwiseAND(low)).cast("int")
    left = join(F.shiftright(key, 31 + TILE_BITS), F.shiftright(key, TILE_BITS))
    return left, join(F.shiftright(key, 2 * TILE_BITS).bitwiseAND(high), key)


def _pair_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring ids of each block (block, lang, ids) as pairs."""
    for batch in batches:
        for block, lang, raw in zip(*(batch[c] for c in ("block", "lang", "ids")), strict=True):
            ids = unpack(raw.as_py()).astype(np.int64)
            at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
            if not len(at):
                continue
            keys, counts, which = tally(ids[at], ids[at + 1])
            # gaps shrink to one place
            place = np.cumsum(np.append(0, np.minimum(np.diff(at) - 1, 1))) + np.arange(len(at))
            codes = np.full(int(place[-1]) + 1, -1, np.int32)
            codes[place] = which
            yield _block(block.as_py(), lang.as_py(), Pairs, keys, counts, codes)
    give_back()


def _dealt(kind: type, keys, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Buckets of some keys with the places of theirs, in order."""
    bucket = kind.buckets(keys, n)
    order = np.argsort(bucket, kind="stable")
    ends = np.cumsum(np.bincount(bucket, minlength=n))
    for b, (a, z) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)):
        if z > a:
            yield b, order[a:z]


_SHARD = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _shards(kind: type, n: int) -> Callable:
    """Sums of a task's blocks, by language and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[list, list]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                keys, counts = kind.add(*parts)
                for b, at in _dealt(kind, keys, n):
                    yield pa.record_batch([pa.array([lang]), pa.array([b], pa.int32()), pa.array([kind.pack(kind.take(keys, at))]), pa.array([pack(counts[at])])], schema=_SHARD)
            held.clear()

        for batch in batches:
            for lang, keys, counts in zip(batch["lang"].to_pylist(), batch["keys"], batch["counts"], strict=True):
                own = held.setdefault(lang, ([], []))
                own[0].append(kind.unpack(keys.as_py()))
                own[1].append(unpack(counts.as_py()))
                size += len(own[1][-1])
                if size > HELD_KEYS:
                    held[lang] = tuple([x] for x in kind.add(*own))
                    size = sum(len(c) for _, cs in held.values() for c in cs)
                    if size > HELD_KEYS // 2:
                        yield from out()
                        size = 0
        yield from out()
        give_back()

    return run


def _sum(kind: type, least: int) -> Callable:
    """Entries of one language and bucket found ``least`` times."""

    def run(group: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, bucket = group
        parts: tuple[list, list] = ([], [])
        size = 0
        for batch in batches:
            for keys, counts in zip(batch["keys"], batch["counts"], strict=True):
                parts[0].append(kind.unpack(keys.as_py()))
                parts[1].append(unpack(counts.as_py()))
                size += len(parts[1][-1])
                if size > 4 * HELD_KEYS:
                    parts = tuple([x] for x in kind.add(*parts))
                    size = len(parts[1][0])
        keys, counts = kind.add(*parts)
        at = np.flatnonzero(counts >= least)
        for a in range(0, len(at), 50_000):
            own = at[a : a + 50_000]
            columns = [pa.repeat(lang, len(own)), pa.repeat(bucket, len(own)), kind.column(kind.take(keys, own)), pa.array(counts[own])]
            yield pa.record_batch(columns, names=["lang", "bucket", "key", "f"])

    return run


def frequent(blocks: DataFrame, kind: type, n: int, least: int) -> DataFrame:
    """lang, bucket, key, f, id: the entries found ``least`` times in all
    blocks of their language, with ids 0, 1, ... by falling frequency."""
    shards = blocks.select("lang", "keys", "counts").mapInArrow(_shards(kind, n), "lang string, bucket int, keys binary, counts binary")
    found = shards.groupBy("lang", "bucket").applyInArrow(_sum(kind, least), f"lang string, bucket int, key {kind.ddl}, f long")
    found = stage(found, "phrase-counts")
    parts = 1 + found.count() // ORDER_ROWS
    laid = found.repartitionByRange(parts, "lang", F.desc("f"), "key").sortWithinPartitions("lang", F.desc("f"), "key")
    laid = stage(laid.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "phrase-order")
    unstage(found)
    # a language's rows lie in neighbouring partitions: one row for each gives the ids before it
    edges = laid.groupBy("lang", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    number = F.col("at") - F.col("first") + F.col("before")
    fits = F.when(number < 2**31, number.cast("int")).otherwise(F.raise_error(F.lit("collocations: more than 2^31 frequent phrases of a length in a language")).cast("int"))
    return laid.join(edges.select("lang", "part", "first", before.alias("before")), ["lang", "part"]).select("lang", "bucket", "key", "f", fits.alias("id"))


def _asked(kind: type, n: int) -> Callable:
    """The keys of each block, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lang, raw in zip(*(batch[c] for c in ("block", "lang", "keys")), strict=True):
                keys = kind.unpack(raw.as_py())
                for b, at in _dealt(kind, keys, n):
                    yield pa.record_batch([pa.array([lang.as_py()]), pa.array([b], pa.int32()), pa.array([block.as_py()]), pa.array([kind.pack(kind.take(keys, at))])], names=["lang", "bucket", "block", "keys"])
        give_back()

    return run


def _answered(kind: type) -> Callable:
    """Ids of the keys that blocks asked for in one bucket."""

    def run(asked: pa.Table, ranked: pa.Table) -> pa.Table:
        block, ids = [], []
        if len(ranked):
            known = ranked["id"].to_numpy()
            for b, raw in zip(asked["block"].to_pylist(), asked["keys"], strict=True):
                found = kind.find(kind.unpack(raw.as_py()), ranked["key"], known)
                if found.max() >= 0:
                    block.append(b)
                    ids.append(pack(found))
        bucket = asked["bucket"][0].as_py() if len(asked) else 0
        return pa.table([pa.array(block, pa.int64()), pa.array([bucket] * len(block), pa.int32()), pa.array(ids, pa.binary())], names=["block", "bucket", "ids"])

    return run


def _in_bucket_order(kind: type, n: int) -> Callable:
    """Blocks whose codes count their keys bucket by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lang, raw, codes in zip(*(batch[c] for c in ("block", "lang", "keys", "codes")), strict=True):
                bucket = kind.buckets(kind.unpack(raw.as_py()), n)
                place = np.empty(len(bucket) + 1, np.int32)
                place[np.argsort(bucket, kind="stable")] = np.arange(len(bucket))
                place[-1] = -1
                row = [pa.array([block.as_py()]), pa.array([lang.as_py()]), pa.array([pack(np.bincount(bucket, minlength=n))]), pa.array([pack(place[unpack(codes.as_py())])])]
                yield pa.record_batch(row, names=["block", "lang", "sizes", "codes"])
        give_back()

    return run


def _ids(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """One block with the ids of its entries in place of its codes."""
    schema = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("ids", pa.binary())])
    if not len(blocks) or not len(answers):
        return schema.empty_table()
    first = np.append(0, np.cumsum(unpack(blocks["sizes"][0].as_py())))
    to = np.full(first[-1] + 1, -1, np.int32)
    for bucket, raw in zip(answers["bucket"].to_pylist(), answers["ids"], strict=True):
        to[first[bucket] : first[bucket + 1]] = unpack(raw.as_py())
    ids = to[unpack(blocks["codes"][0].as_py())]
    keep = np.ones(len(ids), bool)
    keep[1:] = (ids[1:] >= 0) | (ids[:-1] >= 0)
    return pa.table([blocks["block"], blocks["lang"], pa.array([pack(ids[keep])], pa.binary())], schema=schema)


def relabel(blocks: DataFrame, ranked: DataFrame, kind: type, n: int) -> DataFrame:
    """block, lang, ids: staged blocks with their entries' ids, gaps elsewhere."""
    asked = blocks.select("block", "lang", "keys").mapInArrow(_asked(kind, n), "lang string, bucket int, block long, keys binary")
    answers = asked.groupBy("lang", "bucket").cogroup(ranked.select("lang", "bucket", "key", "id").groupBy("lang", "bucket"))
    answers = answers.applyInArrow(_answered(kind), "block long, bucket int, ids binary")
    coded = blocks.select("block", "lang", "keys", "codes").mapInArrow(_in_bucket_order(kind, n), "block long, lang string, sizes binary, codes binary")
    return coded.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_ids, "block long, lang string, ids binary")


def n_buckets(blocks: DataFrame) -> int:
    return 1 + (blocks.agg(F.sum("n")).first()[0] or 0) // BUCKET_KEYS


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)) in whole numbers of 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")
    over = (wide(a) * wide(n)).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    return F.call_function("div", over, wide(left) * wide(right))


def mine_collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    max_words: int = MAX_WORDS,
    least: int = LEAST,
    top: int | None = TOP,
    closed: int = CLOSED,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: phrases of 2 to ``max_words``
    words found ``least`` times, less those that a longer one replaces
    (``closed``), by the score of their weakest cut; ``top`` of a language
    (None: all)."""
    ship(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    blocks = stage(texts.filter("text IS NOT NULL").mapInArrow(_word_blocks, _BLOCK_DDL), "phrase-words")
    kind, n = Words, n_buckets(blocks)
    ranked = stage(frequent(blocks, kind, n, least), "phrase-ids")
    totals = stage(blocks.groupBy("lang").agg(F.sum("words").alias("n")), "phrase-totals")
    one = F.array("f")
    levels = [stage(ranked.select("lang", "id", F.col("key").alias("phrase"), F.col("key").alias("last"), one.alias("pre"), one.alias("suf"), "f"), "phrase-level")]
    out = None
    for k in range(2, max_words + 1):
        ids = stage(relabel(blocks, ranked, kind, n), "phrase-blocks")
        unstage(blocks, ranked)
        blocks = stage(ids.mapInArrow(_pair_blocks, _BLOCK_DDL), "phrase-pairs")
        unstage(ids)
        kind, n = Pairs, n_buckets(blocks)
        ranked = stage(frequent(blocks, kind, n, least), "phrase-ids")
        below = levels[-1]
        left, right = halves(F.col("key"))
        pairs = ranked.select("lang", "id", "f", left.alias("left"), right.alias("right"))
        a = below.select("lang", F.col("id").alias("left"), F.col("phrase").alias("head"), F.col("pre").alias("before"))
        b = below.select("lang", F.col("id").alias("right"), F.col("last"), F.col("suf").alias("after"))
        whole = pairs.join(a, ["lang", "left"]).join(b, ["lang", "right"])
        whole = whole.select(
            "lang", "id", F.concat_ws(" ", "head", "last").alias("phrase"), "last", F.concat("before", one).alias("pre"), F.concat("after", one).alias("suf"), "f", "left", "right"
        )
        level = stage(whole, "phrase-level")
        longer = level.select("lang", F.col("left").alias("id"), "f").union(level.select("lang", F.col("right").alias("id"), "f")).groupBy("lang", "id").agg(F.max("f").alias("longer"))
        if k > 2:
            out = _add(out, _open(below, longer, totals, k - 1, closed))
        levels.append(level)
    out = _add(out, _open(levels[-1], None, totals, max_words, closed))
    out = stage(out, "phrase-scores")
    unstage(blocks, ranked, totals, *levels)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:  # first within salted parts: a language may hold most phrases
        part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(TOP_SALT))).orderBy(*order)
        out = out.withColumn("place", F.row_number().over(part)).filter(F.col("place") <= top)
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return (out if top is None else out.filter(F.col("rank") <= top)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _add(out: DataFrame | None, more: DataFrame) -> DataFrame:
    return more if out is None else out.unionByName(more)


def _open(level: DataFrame, longer: DataFrame | None, totals: DataFrame, k: int, closed: int) -> DataFrame:
    """Scores of the phrases of ``k`` words that no longer one replaces. A
    phrase of more words that fills the places of this one holds a phrase of
    one more word that does, so the next level tells."""
    if longer is not None:
        level = level.join(longer, ["lang", "id"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < closed * F.col("f")))
    cuts = [F.struct(_score(F.col("f"), F.col("n"), F.col("pre")[j - 1], F.col("suf")[k - j - 1]).alias("score"), F.lit(j).alias("cut"), F.col("pre")[j - 1].alias("l"), F.col("suf")[k - j - 1].alias("r")) for j in range(1, k)]
    best = level.join(totals, "lang").select("lang", "phrase", F.col("f").alias("a"), "n", F.least(*cuts).alias("best") if len(cuts) > 1 else cuts[0].alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
