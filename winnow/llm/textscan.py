"""Vectorised scanning of UTF-8 text columns inside Arrow tasks.

A batch of texts is viewed as one byte array.  Word and line borders come from
byte masks, and 64-bit polynomial hashes of any byte range come from one prefix
sum, so no Python code runs per word.  Chunks are bounded in bytes, so that the
temporaries of a task stay small whatever the batch holds; one text longer than
a chunk makes a chunk of its own and is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_rng = np.random.Generator(np.random.PCG64(20240607))
#: A random value per byte, so that sums over different bytes do not cancel.
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_powers: dict[str, np.ndarray] = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Of the separator classes: anything but white space, or letters, digits and non-ASCII.
NOT_SPACE = ~SPACE
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@dataclass
class Chunk:
    """Rows ``first`` to ``first + n`` of a batch: their bytes and n + 1 borders."""

    first: int
    n: int
    data: np.ndarray
    border: np.ndarray


def column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row borders of a string column; a null is an empty text."""
    a = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_large_string(a.type):
        a = a.cast(pa.large_string())
    if a.null_count:
        a = a.fill_null("")
    _, offsets, data = a.buffers()
    border = np.frombuffer(offsets, np.int64, len(a) + 1 + a.offset)[a.offset :]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, border


def chunks(batch: pa.RecordBatch, name: str = "text", limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    raw, border = column(batch, name)
    i, n = 0, len(border) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(border, border[i] + limit, "right")) - 1)
        yield Chunk(i, j - i, raw[border[i] : border[j]], border[i : j + 1] - border[i])
        i = j


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE to the power 0 .. n, and the inverses modulo 2**64."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, CHUNK_BYTES + 2)
        inverse = pow(int(_BASE), -1, 1 << 64)
        for key, base in (("up", _BASE), ("down", U64(inverse))):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            with np.errstate(over="ignore"):
                _powers[key] = np.multiply.accumulate(a)
    return _powers["up"], _powers["down"]


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end]; equal bytes give equal hashes."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _power(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
        return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
        return h ^ (h >> U64(31))


def words(c: Chunk, inside: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and n + 1 borders of the rows in that list."""
    is_word = inside[c.data]
    cut = np.zeros(len(c.data) + 1, bool)
    cut[c.border] = True
    before = np.zeros(len(c.data) + 1, bool)
    before[1:] = is_word
    before[cut] = False
    start = np.flatnonzero(is_word & ~before[:-1])
    after = np.zeros(len(c.data) + 1, bool)
    after[:-1] = is_word
    after[cut] = False
    end = np.flatnonzero(is_word & ~after[1:]) + 1
    return start, end, np.searchsorted(start, c.border)


def per_row(flags: np.ndarray, border: np.ndarray) -> np.ndarray:
    """Sum of flags (bool or small ints) of each row."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:], dtype=np.int64)
    return total[border[1:]] - total[border[:-1]]


def row_of(border: np.ndarray) -> np.ndarray:
    """The row number of each element."""
    return np.repeat(np.arange(len(border) - 1), np.diff(border))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more in the array."""
    if len(keys) < 2:
        return np.zeros(len(keys), bool)
    s = np.sort(keys)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(twice, keys)
    at[at == len(twice)] = 0
    return twice[at] == keys


def windows_of(border: np.ndarray, width: int) -> np.ndarray:
    """Index of the first word of each window of that width within a row."""
    row = row_of(border)
    return np.flatnonzero(row[: len(row) - width + 1] == row[width - 1 :]) if len(row) >= width else np.zeros(0, np.int64)
