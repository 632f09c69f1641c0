"""Runs of chosen bytes in a batch of texts, for operators whose words are not
those between white space."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def byte_class(chars: bytes) -> np.ndarray:
    """Membership table of some bytes."""
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


# ASCII letters and all bytes of other characters.
LETTERS = byte_class(bytes([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))


@dataclass
class Runs:
    """``code`` indexes ``distinct``; ``doc`` is the text of each run and
    ``begin`` its first byte in the batch."""

    code: np.ndarray
    doc: np.ndarray
    begin: np.ndarray
    distinct: pa.Array


def cut(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Runs:
    """Longest runs of bytes of the class ``inside``, none across two texts."""
    at = inside[raw]
    first = at.copy()
    first[1:] &= ~at[:-1]
    edges = offsets[:-1][offsets[:-1] < len(raw)]
    first[edges] = at[edges]
    begin = np.flatnonzero(first)
    length = np.add.reduceat(at, begin, dtype=np.int64) if len(begin) else np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.cumsum(length)])
    found = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(starts), pa.py_buffer(raw[at].tobytes())]).dictionary_encode()
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(begin, offsets)))
    return Runs(found.indices.to_numpy().astype(np.int64), doc, begin, found.dictionary)
