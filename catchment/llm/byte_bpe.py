"""Byte-level BPE encoding and decoding with segment trees.

A pre-token starts as one token per byte. A segment tree over its byte
positions keeps, at the root, the leftmost pair of the least rank; a merge
changes the leaves of three live positions (the merged token, its left
neighbour and the byte that ceases to start a token) and repairs their paths
to the root, so n bytes take O(n log n) steps whatever the text.

Inside a task the distinct pre-tokens of a batch are encoded together: those
of like length form one matrix with one tree per row, and every numpy step
makes one merge in each row. Long pre-tokens take the same steps one by one.
Workers keep what they have encoded in a bounded cache.

Defined cases: a null or empty text gives no ids; a text decodes to its own
UTF-8 bytes; rows are encoded one by one, so repeated rows, null ids and extra
columns change nothing; ids outside the vocabulary raise an error.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .common import give_back, worker_state

CACHE_ENTRIES = 250_000  # a worker's cache is emptied beyond this
ROW_BYTES = 256  # longer pre-tokens are encoded one by one
ROWS_AT_ONCE = 8_192
NEVER = np.iinfo(np.int64).max


def parse_ranks(rank_file: bytes) -> dict[bytes, int]:
    """Token bytes and rank of each line of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in rank_file.splitlines() if x)}


def tokens_of(ranks: dict[bytes, int]) -> list[bytes]:
    """Token bytes by id."""
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


class Vocabulary:
    """Ids of single bytes, and the rank of every pair of tokens that join to
    a token."""

    def __init__(self, rank_file: bytes):
        ranks = parse_ranks(rank_file)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs = {
            (ranks[t[:i]], ranks[t[i:]]): rank
            for t, rank in ranks.items()
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        }
        keys = np.array([a << 32 | b for a, b in self.pairs], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array(list(self.pairs.values()), np.int64)[order]

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NEVER where the two don't join."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)

    def encode_one(self, piece: bytes) -> list[int]:
        """Ids of one pre-token; a scalar segment tree."""
        n = len(piece)
        size = 1 << max(0, n - 1).bit_length()
        ids, after, before = [int(self.byte_id[b]) for b in piece], list(range(1, n + 1)), list(range(-1, n - 1))
        none = (NEVER, size)
        tree = [none] * (2 * size)
        for i in range(n - 1):
            rank = self.pairs.get((ids[i], ids[i + 1]))
            tree[size + i] = none if rank is None else (rank, i)
        for k in range(size - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(i: int, rank: int | None) -> None:
            k = size + i
            tree[k] = none if rank is None else (rank, i)
            while k > 1:
                k >>= 1
                tree[k] = min(tree[2 * k], tree[2 * k + 1])

        live = [True] * n
        while n and tree[1] is not none and tree[1][0] != NEVER:
            rank, i = tree[1]
            gone = after[i]
            ids[i], after[i], live[gone] = rank, after[gone], False
            put(gone, None)
            if after[i] < n:
                before[after[i]] = i
                put(i, self.pairs.get((rank, ids[after[i]])))
            else:
                put(i, None)
            if before[i] >= 0:
                put(before[i], self.pairs.get((ids[before[i]], rank)))
        return [x for x, k in zip(ids, live, strict=True) if k]

    def _encode_rows(self, pieces: list[bytes], size: int) -> list[bytes]:
        """Packed ids of pre-tokens of 1 to ``size`` bytes (a power of two),
        one segment tree per row, one merge per row at each step."""
        n = len(pieces)
        length = np.fromiter(map(len, pieces), np.int64, n)
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(n, size)
        ids = self.byte_id[raw]
        live = np.arange(size) < length[:, None]
        after = np.tile(np.arange(1, size + 1), (n, 1))
        before = np.tile(np.arange(-1, size - 1), (n, 1))
        tree = np.full((n, 2 * size), NEVER, np.int64)  # rank * size + position

        def leaf(rank: np.ndarray, at: np.ndarray) -> np.ndarray:
            return np.where(rank == NEVER, NEVER, np.where(rank == NEVER, 0, rank) * size + at)

        if size > 1:
            rank = np.where(live[:, 1:], self.rank_of(ids[:, :-1], ids[:, 1:]), NEVER)
            tree[:, size : 2 * size - 1] = leaf(rank, np.arange(size - 1))
        k = size // 2
        while k:
            tree[:, k : 2 * k] = np.minimum(tree[:, 2 * k : 4 * k : 2], tree[:, 2 * k + 1 : 4 * k : 2])
            k //= 2
        row = np.flatnonzero(tree[:, 1] != NEVER) if size > 1 else np.zeros(0, np.int64)
        while len(row):
            rank, at = np.divmod(tree[row, 1], size)
            gone = after[row, at]
            then = after[row, gone]
            prior = before[row, at]
            ids[row, at] = rank
            after[row, at] = then
            live[row, gone] = False
            more, has = then < length[row], prior >= 0
            nxt, prv = np.where(more, then, 0), np.where(has, prior, 0)
            before[row[more], then[more]] = at[more]
            tree[row, size + gone] = NEVER
            tree[row, size + at] = leaf(np.where(more, self.rank_of(rank, ids[row, nxt]), NEVER), at)
            left = leaf(self.rank_of(ids[row, prv], rank), prv)
            tree[row[has], size + prior[has]] = left[has]
            prior = np.where(has, prior, at)
            nodes = [size + gone, size + at, size + prior]
            for _ in range(size.bit_length() - 1):
                for j in range(3):
                    nodes[j] = nodes[j] >> 1
                    tree[row, nodes[j]] = np.minimum(tree[row, 2 * nodes[j]], tree[row, 2 * nodes[j] + 1])
            row = row[tree[row, 1] != NEVER]
        packed = ids[live].astype("<u4").tobytes()
        ends = np.cumsum(live.sum(axis=1)) * 4
        return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Packed little-endian ids of each pre-token."""
        out: list[bytes] = [b""] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if len(p) > ROW_BYTES:
                out[i] = np.array(self.encode_one(p), "<u4").tobytes()
            elif p:
                by_size.setdefault(1 << (len(p) - 1).bit_length(), []).append(i)
        for size, at in by_size.items():
            for a in range(0, len(at), ROWS_AT_ONCE):
                some = at[a : a + ROWS_AT_ONCE]
                for i, packed in zip(some, self._encode_rows([pieces[i] for i in some], size), strict=True):
                    out[i] = packed
        return out


def _vocabulary(ranks: Broadcast) -> tuple[Vocabulary, dict]:
    """This worker's vocabulary and cache, built once."""
    kept, key = worker_state("byte_bpe"), ("encode", hash(ranks.value))
    if key not in kept:
        kept[key] = Vocabulary(ranks.value), {}
    return kept[key]


def _tokens(ranks: Broadcast) -> list[bytes]:
    """This worker's tokens by id, built once."""
    kept, key = worker_state("byte_bpe"), ("decode", hash(ranks.value))
    if key not in kept:
        kept[key] = tokens_of(parse_ranks(ranks.value))
    return kept[key]


def load_ranks(spark: SparkSession, path: str) -> Broadcast:
    """The rank file (a fixed vocabulary, under 1 MB) for all workers."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(text: Column, ranks: Broadcast, pattern: str) -> Column:
    """Token ids (array of int) of a text column."""

    @F.arrow_udf("array<int>")
    def ids(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        (vocab, cache), pat = _vocabulary(ranks), regex.compile(pattern)
        for part in parts:
            blobs = []
            for a in range(0, len(part), 500):
                found = [pat.findall(t or "") for t in part.slice(a, 500).to_pylist()]
                if len(cache) > CACHE_ENTRIES:
                    cache.clear()
                new = list({p for ps in found for p in ps if p not in cache})
                cache.update(zip(new, vocab.encode_pieces([p.encode() for p in new]), strict=True))
                blobs += [b"".join([cache[p] for p in ps]) for ps in found]
            ends = np.cumsum([0, *(len(b) // 4 for b in blobs)])
            values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(blobs))])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        give_back()

    return ids(text)


def _lists(ids: pa.Array) -> Iterator[np.ndarray]:
    values = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
    at = ids.offsets.to_numpy()
    return (values[a:b] for a, b in zip(at[:-1], at[1:], strict=True))


def decode(ids: Column, ranks: Broadcast) -> Column:
    """Bytes of token ids."""

    @F.arrow_udf("binary")
    def text(part: pa.Array) -> pa.Array:
        tokens = _tokens(ranks)
        return pa.array([b"".join([tokens[i] for i in x.tolist()]) for x in _lists(part)], pa.binary())

    return text(ids)


def pack(ids: Column) -> Column:
    """Token ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("binary")
    def packed(part: pa.Array) -> pa.Array:
        return pa.array([x.tobytes() for x in _lists(part)], pa.binary())

    return packed(ids)
