"""Vectorised words of Arrow text columns.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. These bytes
never occur inside a multi-byte UTF-8 sequence, so words of the encoded bytes
are the words of the text. Null and empty texts have no words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Bytes hashed at once; the arrays of one block take about 40 times as much.
BLOCK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser on an array of uint64."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """The first n values of SplitMix64 from a seed."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _GOLDEN + np.uint64(seed))


_BYTE = stream(256, 7)
_BASE = int(_GOLDEN) | 1


def _powers(base: int) -> np.ndarray:
    out = np.full(BLOCK + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, made at first use in a worker."""
    if not _POWER:
        _POWER.extend([_powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))])
    return _POWER


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of n + 1 texts, their bytes) of a string column; nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if len(column) == 0:
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return offs - offs[0], raw[offs[0] : offs[-1]]


def spans(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, index of the first word of each text and the total) of the words of a batch.
    A text's border ends a word."""
    if not len(raw):
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(len(offsets), dtype=np.int64)
    word = ~_SPACE[raw]
    cut = np.zeros(len(raw) + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    starts = np.flatnonzero(word & (~before | cut[:-1]))
    after = np.empty_like(word)
    after[-1], after[:-1] = False, word[1:]
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words of a batch, whose starts and ends ascend.

    A polynomial over random byte values, from prefix sums of one block at a
    time; words longer than a block use xxHash.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    up, down = _tables()
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i, int(np.searchsorted(ends, base + BLOCK, side="right")))
        if j == i:
            out[i] = xxhash.xxh64_intdigest(raw[base : ends[i]].tobytes())
            i += 1
            continue
        part = raw[base : ends[j - 1]]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[part] * up[: len(part)], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _GOLDEN)
        i = j
    return out


def word_hashes(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word of a batch, index of the first word of each text
    and the total). ``lower`` lowers A-Z."""
    offsets, raw = buffers(column)
    if lower:
        raw = _LOWER[raw]
    starts, ends, first = spans(offsets, raw)
    return hash_spans(raw, starts, ends), first


def word_counts(column: pa.Array) -> np.ndarray:
    """Words of each text."""
    return np.diff(spans(*buffers(column))[2])


def release() -> None:
    """Give freed memory back to the system: Spark keeps idle Python workers for later stages."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def by_bytes(batches: Iterator[pa.RecordBatch], text: str, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds texts of at most ``most`` bytes, or one longer text."""
    for batch in batches:
        offsets, _ = buffers(batch.column(text))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
            yield batch.slice(i, j - i)
            i = j
    release()


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of ``width`` words of one text; of the whole sequence if it is shorter."""
    n = len(hashes)
    if not n:
        return hashes
    w = min(width, n)
    h = np.full(n - w + 1, np.uint64(w), dtype=np.uint64)
    for k in range(w):
        h = mix(h * _GOLDEN + hashes[k : n - w + 1 + k])
    return h
