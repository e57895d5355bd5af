"""Words of many texts at once: numpy over the bytes of an Arrow string column.

A record batch is handled in slices of a few megabytes, so the working
arrays stay small whatever the batch holds; one text longer than a slice
is cut at a byte that is no part of a word. Word hashes are 64-bit
(a random byte table, a polynomial over the word, a final mix).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

# Word classes. Bytes from 0x80 up belong to multi-byte characters, which are word characters.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True
NONBLANK = np.ones(256, dtype=bool)
NONBLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

_FOLD = np.arange(256)
_FOLD[0x41:0x5B] += 32
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _TABLE[_FOLD]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, dtype=np.uint64)

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = 1 << max(10, (n - 1).bit_length())
        p = np.full(size, _BASE, dtype=np.uint64)
        p[0] = 1
        _powers = np.multiply.accumulate(p)
    return _powers[:n]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of each text and the end, all bytes) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    return off, np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes each (one text at least)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def _words(data: np.ndarray, cuts: np.ndarray, is_word: np.ndarray, table: np.ndarray):
    mask = is_word[data]
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = mask[cuts]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, starts
    body = data[mask]
    first = np.cumsum(mask)[starts] - 1  # where each word begins within body
    lens = np.diff(first, append=len(body))
    pos = np.arange(len(body)) - np.repeat(first, lens)
    values = table[body] * powers(int(lens.max()))[pos]
    return mix(np.add.reduceat(values, first) + lens.astype(np.uint64)), starts, lens


def hash_words(data: np.ndarray, cuts: np.ndarray, is_word: np.ndarray, fold_case: bool = False,
               limit: int = 4 * SLICE_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, byte length) of every word; ``cuts``: bytes at which a text begins."""
    table = _FOLDED if fold_case else _TABLE
    if len(data) <= limit:
        return _words(data, cuts, is_word, table)
    parts, lo = [], 0
    while lo < len(data):
        hi = min(len(data), lo + limit)
        while hi < len(data) and is_word[data[hi - 1]] and is_word[data[hi]]:
            hi += 1
        h, s, n = _words(data[lo:hi], cuts - lo, is_word, table)
        parts.append((h, s + lo, n))
        lo = hi
    return tuple(np.concatenate(x) for x in zip(*parts))


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive word hashes."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.zeros(n, dtype=np.uint64)
    for k in range(length):
        acc = acc * _BASE + hashes[k:k + n]
    return mix(acc)


def covered(starts: np.ndarray, length, n: int) -> np.ndarray:
    """Which of n positions lie in [start, start + length) of some start."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + length, -1)
    return np.cumsum(step[:n]) > 0


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between consecutive ``bounds``."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(total[bounds])
