"""Byte kernels over Arrow text columns: words and their 64-bit hashes, without Python strings.

A text column is seen as one byte array with row offsets. Hashes are polynomials modulo
2**64 over a random value per byte, taken from a running product, so that the hash of a
word does not depend on where it stands.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21
SPACES = [9, 10, 11, 12, 13, 32]

SPACE = np.zeros(256, dtype=bool)
SPACE[SPACES] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_TABLE = LOWER.tobytes()

_random = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WORD_VALUE = np.where(SPACE, np.uint64(0), BYTE_VALUE)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES)
        _powers[:] = []
        for base in (BASE, BASE_INVERSE):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers[0][:n], _powers[1][:n]


def mix(z: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; a null row is empty."""
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, dtype=width)[column.offset:column.offset + len(column) + 1]
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[at[0]:at[-1]], (at - at[0]).astype(np.int64)


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def row_flags(offsets: np.ndarray, n: int) -> np.ndarray:
    """True where a row starts."""
    flags = np.zeros(n, dtype=bool)
    starts = offsets[:-1]
    flags[starts[starts < n]] = True
    return flags


def words(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without ASCII white space), and each row's first word."""
    n = len(body)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~SPACE[body]
    first = row_flags(offsets, n)
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | first[1:]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | first[1:]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def segment_hashes(body: np.ndarray, starts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Hash of every stretch from one start to the next; bytes of value 0 do not count."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    up, down = powers(len(body))
    return mix(np.add.reduceat(values[body] * up, starts) * down[starts])
