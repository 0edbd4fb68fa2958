"""Bytes, words and fingerprints of many texts at once, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: a fixed 64-bit value for each byte
_BYTES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.int64).astype(U) * U(2) + U(1)


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches between rows into pieces of about ``size`` bytes of text; a longer text is a piece of its own."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of UTF-8 bytes, and where each begins and the last ends; a null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def ascii_lower(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and how many words come before each text (and after the last)."""
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = (data != 32) & ((data < 9) | (data > 13))
    cut = np.zeros(len(data) + 1, bool)  # a text begins at this byte
    cut[bounds] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    return starts, ends, np.searchsorted(starts, bounds)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


_powers = np.ones(1, U), np.ones(1, U)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 21)
        up, down = np.full(size, _BASE), np.full(size, _BASE_INVERSE)
        up[0] = down[0] = 1
        _powers = np.cumprod(up), np.cumprod(down)
    return _powers[0][:n], _powers[1][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums that give the fingerprint of any stretch of bytes."""
    return value_sums(_BYTES[data])


def value_sums(values: np.ndarray) -> np.ndarray:
    """The same for a sequence of well spread 64-bit values."""
    up, _ = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, U)
    np.cumsum(values * up[:-1], out=sums[1:])
    return sums


def hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of the bytes from each start to its end."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def rolling(sums: np.ndarray, k: int) -> np.ndarray:
    """The same fingerprints of all stretches of k bytes, in order."""
    n = max(0, len(sums) - k)
    _, down = powers(len(sums))
    return mix((sums[k:] - sums[:n]) * down[:n] + U(k * 0xD6E8FEB86659FD93 % 2**64))


def joined(h: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Fingerprints of k neighbours in a row, in order."""
    n = max(0, len(h) - k + 1)
    out = np.full(n, U(seed * 0xA24BAED4963EE407 % 2**64))
    for i in range(k):
        out = mix((out + h[i : i + n]) * U(0x9FB21C651E98DF25))
    return out


def sorted_each(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The values in stretches of so many, each stretch sorted by itself."""
    out, ends = values.copy(), np.cumsum(counts).tolist()
    for start, end in zip([0, *ends], ends):
        out[start:end].sort()
    return out


def spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of true values."""
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def within(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the intervals."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0
