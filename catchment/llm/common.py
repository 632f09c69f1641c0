"""Shared helpers: staged tables, text batches as flat bytes, word tables.

Words are runs of bytes between ASCII white space (0x20, 0x09-0x0D); inside a
task a batch of texts is handled as one flat byte buffer, so no Python object
is made per word.
"""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

CHUNK_BYTES = 1 << 20  # text handled at once inside a task
BATCH_ROWS = 1000  # rows of an Arrow batch: texts are long

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that
    they need no copy of the repository on their path."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="catchment-py-"), f"{package.name}-py.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared scratch folder (``spark.checkpoint.dir``). Only a
    local session without that setting gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="catchment-shared-")
        spark.sparkContext.setCheckpointDir(root)
    return root


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage,
    so a lost executor never repeats what came before. The write's shuffle
    files, which nothing reads again, are dropped when it is done."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/stage-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    for scope in _scopes:
        scope[path] = out
    return out


def unstage(*staged: DataFrame) -> None:
    """Delete staged tables that nothing will read again."""
    for df in staged:
        for scope in _scopes:
            scope.pop(df.staged_path, None)
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


_scopes: list[dict[str, DataFrame]] = []


def staged_result(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns, staged; the tables that it staged on the way are
    deleted once the result is written, since nothing reads them again."""
    scope: dict[str, DataFrame] = {}
    _scopes.append(scope)
    try:
        out = stage(make(), name)
        scope.pop(out.staged_path)
    finally:
        _scopes.remove(scope)
        unstage(*scope.values())
    return out


_state: dict = {}


def worker_state(owner: str) -> dict:
    """What a Python worker keeps between tasks (models, caches) for one
    operator; another operator's turn drops it."""
    if _state.get("owner") != owner:
        _state.clear()
        _state.update(owner=owner, kept={})
    return _state["kept"]


def give_back() -> None:
    """Return a worker's freed memory to the system: workers live on between
    tasks, and an executor's limit counts what they hold."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc can
        ctypes.CDLL(None).malloc_trim(0)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (null: none) and the offsets of each text."""
    arr = pc.fill_null(texts, "").cast(pa.large_binary())
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES):
    """Slices of ``texts`` of about ``limit`` bytes (one text at least)."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(size) // limit if len(size) else np.zeros(0, np.int64)
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)], strict=True):
        if b > a:
            yield texts.slice(a, b - a)


def per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text are marked."""
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


@dataclass
class Words:
    """All words of a batch: ``code`` indexes ``distinct``; ``bounds[d]`` to
    ``bounds[d + 1]`` are the words of text ``d``."""

    code: np.ndarray
    doc: np.ndarray
    bounds: np.ndarray
    distinct: pa.Array
    begin: np.ndarray  # byte range of each word in the batch
    end: np.ndarray

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word (each distinct word is hashed once)."""
        h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.distinct.to_pylist()), np.uint64, len(self.distinct))
        return h[self.code] if len(h) else np.zeros(0, np.uint64)


def words(raw: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Words of a batch from its flat bytes; ``lower`` folds A-Z only."""
    if lower:
        raw = _LOWER[raw]
    inside = ~_SPACE[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(raw)]
    first[edges] = inside[edges]  # a text's first byte never continues a word
    begin = np.flatnonzero(first)
    length = np.add.reduceat(inside, begin, dtype=np.int64) if len(begin) else np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.cumsum(length)])
    arr = pa.Array.from_buffers(
        pa.large_binary(), len(begin), [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(raw[inside].tobytes())]
    ).dictionary_encode()
    bounds = np.searchsorted(begin, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    return Words(arr.indices.to_numpy().astype(np.int64), doc, bounds, arr.dictionary, begin, begin + length)


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every window of ``n`` consecutive words of one text."""
    if len(h) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1 :])
    out = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - n + 1 + j]
    return at, mix(out[at])
