"""Vectorised hashing of words and character n-grams over Arrow text batches (numpy, inside tasks)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LONG_SPAN = 256  # bytes; the sums of longer spans can be made to collide whatever the table of bytes
SLICE_BYTES = 1 << 20  # text handled at a time; a byte takes up to some 80 bytes of arrays meanwhile
PART_BYTES = 1 << 18  # the same where a worker's memory goes on to later steps: it keeps much of what it once took

# Bytes that separate words, and A-Z to a-z.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32

_random = np.random.default_rng(20260728)
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_STEPS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # powers of the base and of its inverse


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_STEPS[0]) >= n:
        return _STEPS[0], _STEPS[1]
    made = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    if n <= 2 * SLICE_BYTES:  # a worker does not keep those of a very long text
        _STEPS[:] = made
    return made[0], made[1]


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows of at most ``limit`` bytes of text (or one row)."""
    sizes = np.diff(offsets(batch.column(column)))
    ends = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        base = ends[first] - sizes[first]
        last = max(first + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(first, last - first)
        first = last


def offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    at = np.frombuffer(texts.buffers()[1] or bytes(8), kind)[texts.offset:texts.offset + len(texts) + 1]
    return at.astype(np.int64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (none null) in a row and where each text starts, with the end."""
    at = offsets(texts)
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[at[0]:at[-1]], at - at[0]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, limit: int = SLICE_BYTES) -> np.ndarray:
    """64-bit hashes of ``data[start:end]`` for spans in order, in blocks of about ``limit`` bytes.

    Spans of more than ``LONG_SPAN`` bytes, which are few, are hashed one by one with BLAKE2.
    """
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + limit, "right")))
        sums = prefix_sums(data[base:ends[last - 1]])
        out[first:last] = hash_of(sums, starts[first:last] - base, ends[first:last] - base)
        first = last
    for i in np.flatnonzero(ends - starts > LONG_SPAN):
        digest = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest()
        out[i] = np.frombuffer(digest, np.uint64)[0]
    return out


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """What :func:`hash_of` needs to hash any span of ``data``."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(len(data) + 1)[0][:len(data)], out=sums[1:])
    return sums


def hash_of(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans, in any order; they may overlap."""
    return mix((sums[ends] - sums[starts]) * _powers(len(sums))[1][starts])


def characters(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each character (its UTF-8 bytes), and the index of each text's first character (with the end)."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    values = data[starts].astype(np.uint64)
    if len(starts) == len(data):
        return values, at
    ends = np.append(starts[1:], len(data))
    for i in range(1, 4):
        longer = np.flatnonzero(ends - starts > i)
        values[longer] = values[longer] * np.uint64(256) + data[starts[longer] + i]
    return values, np.searchsorted(starts, at)


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of each text's first word (with the end)."""
    inside = ~SEPARATOR[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cut = at[:-1][at[:-1] < len(data)]
    opens[cut] |= inside[cut]  # a text's first byte opens a word though the text before it ended in one
    before = cut[cut > 0] - 1
    closes[before] |= inside[before]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, at)


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the index of each text's first word (with the end)."""
    data, at = text_bytes(texts)
    if lower:
        data = LOWERED[data]
    starts, ends, first = words(data, at)
    return hash_spans(data, starts, ends), first


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every ``width`` neighbours of ``values`` (``len(values) - width + 1`` of them)."""
    n = max(0, len(values) - width + 1)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = out * np.uint64(_BASE) + values[i:i + n]
    return mix(out)
