"""Pairs of words in cells: words are dealt into groups, and a cell counts the pairs of two groups, or of one.

What is sent are the words that lines have of a group, not their pairs. A cell keeps what it was sent packed, and
goes through it once for each range of its words, so that the pairs of a range and the lines of a parcel are all it
has in memory besides.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pairs that a task makes at a time, pairs of a range of words, if no word has more, and rows that it gives back at a time.
PIECE, RANGE, ROWS = 1 << 20, 1 << 21, 1 << 17
#: Bytes of text whose lines make a parcel.
PART = 1 << 22
_LOW = (1 << 32) - 1


class Lines(NamedTuple):
    """Words that lines have of a group, in order of line and word: number of the line, of the word, and how often."""

    line: np.ndarray
    word: np.ndarray
    n: np.ndarray


def pack(lines: Lines, words: list[str]) -> bytes:
    """The words, which are to be in order, and the lines."""
    arrays = np.stack([np.diff(lines.line, prepend=0), lines.word, lines.n]).astype(np.int32)
    text, plain = " ".join(words).encode(), arrays.tobytes()
    packed = pa.compress(text, "zstd", asbytes=True)
    return np.array([len(text), len(packed), len(lines.line)], np.int64).tobytes() + packed + pa.compress(plain, "zstd", asbytes=True)


def unpack_words(blob: bytes) -> list[str]:
    size, packed, _ = np.frombuffer(blob, np.int64, 3)
    text = pa.decompress(blob[24 : 24 + int(packed)], int(size), "zstd", asbytes=True).decode()
    return text.split(" ") if text else []


def unpack_lines(blob: bytes) -> Lines:
    _, packed, n = (int(x) for x in np.frombuffer(blob, np.int64, 3))
    plain = pa.decompress(memoryview(blob)[24 + packed :], 12 * n, "zstd", asbytes=True)
    line, word, times = np.frombuffer(plain, np.int32, 3 * n).reshape(3, -1).astype(np.int64)
    return Lines(np.cumsum(line), word, times)


def cell_of(low: int, high: int) -> int:
    return high * (high + 1) // 2 + low


def send_lines(groups: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(cell, low, high) from texts: the lines of a batch by group, for every cell; high is null where both are one."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, start = np.cumsum(pc.binary_length(batch["value"]).to_numpy().astype(np.int64)), 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PART, "right")))
                yield batch.slice(start, stop - start)
                start = stop

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            split = pc.split_pattern(batch["value"], " ")
            line = np.repeat(np.arange(len(split)), np.diff(split.offsets.to_numpy()))
            coded = pc.dictionary_encode(split.flatten())
            order = pc.sort_indices(coded.dictionary).to_numpy()
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            words, codes = coded.dictionary.take(pa.array(order)).to_pylist(), rank[coded.indices.to_numpy()]
            group = np.array([zlib.crc32(w.encode()) % groups if w else groups for w in words], np.int64)
            keys, n = np.unique(line << 32 | codes, return_counts=True)
            line, codes = keys >> 32, keys & _LOW
            blobs = {}
            for g in range(groups):
                mine = group[codes] == g
                if mine.any():
                    own, places = np.unique(codes[mine], return_inverse=True)
                    blobs[g] = pack(Lines(line[mine], places, n[mine]), [words[i] for i in own])
            pairs = [(low, high) for low in blobs for high in blobs if low <= high]
            for at in range(0, len(pairs), 64):
                some = pairs[at : at + 64]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([cell_of(*p) for p in some], pa.int32()),
                        pa.array([blobs[low] for low, _ in some], pa.binary()),
                        pa.array([blobs[high] if low < high else None for low, high in some], pa.binary()),
                    ],
                    ["cell", "low", "high"],
                )

    return send


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, n
    if n.max() == 1 == n.min():
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[starts], np.add.reduceat(n, starts)


def pair_sums(
    low: Lines, high: Lines | None, piece: int = PIECE, first: int = 0, last: int = _LOW
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(word of the one, of the other, sum) over all lines, each pair once; a group is paired with itself if ``high`` is None.

    The word of the one is from ``first`` on, and less than ``last``. Pairs are made in its order, so that only those
    of one word are kept from one piece to the next.
    """
    other = high or low
    order = np.flatnonzero((low.word >= first) & (low.word < last))
    order = order[np.argsort(low.word[order], kind="stable")]
    stop = np.searchsorted(other.line, low.line[order], "right")
    start = np.searchsorted(other.line, low.line[order], "left") if high else order + 1
    counts = stop - start
    before = np.append(0, np.cumsum(counts))
    at, keys, n = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
    while at < len(order):
        to = max(at + 1, int(np.searchsorted(before, before[at] + piece, "right")) - 1)
        mine, size = order[at:to], counts[at:to]
        place = np.repeat(start[at:to] - (before[at:to] - before[at]), size) + np.arange(before[to] - before[at])
        made = np.repeat(low.word[mine], size) << 32 | other.word[place]
        keys, n = _sums(np.append(keys, made), np.append(n, np.repeat(low.n[mine], size) * other.n[place]))
        # the last word may go on
        done = int(np.searchsorted(keys, low.word[mine[-1]] << 32)) if to < len(order) else len(keys)
        if done:
            yield keys[:done] >> 32, keys[:done] & _LOW, n[:done]
        keys, n, at = keys[done:], n[done:], to


class Cell:
    """The parcels of a cell, packed; its words in order, and the number in them of each parcel's words."""

    def __init__(self, parcels: list[tuple[bytes, bytes | None]]) -> None:
        self.parcels = parcels
        own = [[pa.array(unpack_words(b), pa.string()) for b in p if b is not None] for p in parcels]
        every = pa.chunked_array([words for p in own for words in p], pa.string())
        words = pc.unique(every)
        self.words = words.take(pc.sort_indices(words))
        ends = np.cumsum([len(words) for p in own for words in p])
        numbers = iter(np.split(pc.index_in(every, self.words).to_numpy().astype(np.int32), ends[:-1]))
        self.numbers = [[next(numbers) for _ in p] for p in own]

    def ranges(self, piece: int) -> Iterator[tuple[int, int]]:
        """Ranges of numbers of words that have about so many pairs as the one, or of one word."""
        pairs = np.zeros(len(self.words), np.int64)
        for (low, high), numbers in zip(self.parcels, self.numbers, strict=True):
            lines = unpack_lines(low)
            other = lines if high is None else unpack_lines(high)
            counts = np.searchsorted(other.line, lines.line, "right")
            counts -= np.arange(1, len(counts) + 1) if high is None else np.searchsorted(other.line, lines.line, "left")
            np.add.at(pairs, numbers[0][lines.word], counts)
        before, at = np.append(0, np.cumsum(pairs)), 0
        while at < len(pairs):
            to = max(at + 1, int(np.searchsorted(before, before[at] + piece, "right")) - 1)
            if before[to] > before[at]:
                yield at, to
            at = to

    def sums(self, first: int, last: int, piece: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs whose one word is in the range, by the words' numbers, and their sums.

        What is held are the different pairs of the range, and ``piece`` pairs that are not yet put together.
        """
        keys, n, held, left = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0
        for (low, high), numbers in zip(self.parcels, self.numbers, strict=True):
            begin, end = (int(x) for x in np.searchsorted(numbers[0], (first, last)))
            if begin == end:
                continue
            of, to = numbers[0], numbers[-1]
            for a, b, m in pair_sums(unpack_lines(low), unpack_lines(high) if high is not None else None, piece, begin, end):
                held.append((of[a].astype(np.int64) << 32 | to[b], m))
                left += len(m)
                if left >= piece:
                    keys, n = _sums(*(np.concatenate(c) for c in zip((keys, n), *held, strict=True)))
                    held, left = [], 0
        return _sums(*(np.concatenate(c) for c in zip((keys, n), *held, strict=True)))

    def own(self, include_self: bool) -> np.ndarray:
        """For every word how many pairs it has with itself."""
        sums = np.zeros(len(self.words), np.int64)
        for (low, _), numbers in zip(self.parcels, self.numbers, strict=True):
            lines = unpack_lines(low)
            np.add.at(sums, numbers[0][lines.word], lines.n * (lines.n + (1 if include_self else -1)) // 2)
        return sums


def count_cells(include_self: bool, piece: int = RANGE) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(word_a, word_b, n) of the cells that a task is given."""

    def sums(cell: Cell) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for first, last in cell.ranges(piece):
            keys, n = cell.sums(first, last, PIECE)
            yield np.minimum(keys >> 32, keys & _LOW), np.maximum(keys >> 32, keys & _LOW), n
        if all(high is None for _, high in cell.parcels):
            own = cell.own(include_self)
            word = np.flatnonzero(own > 0)
            yield word, word, own[word]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = defaultdict(list)
        for batch in batches:
            for cell, *pair in zip(*(batch[c].to_pylist() for c in ("cell", "low", "high")), strict=True):
                cells[cell].append(tuple(pair))
        while cells:
            cell = Cell(cells.popitem()[1])
            for a, b, n in sums(cell):
                for at in range(0, len(n), ROWS):
                    some = slice(at, at + ROWS)
                    names = [cell.words.take(pa.array(x[some])) for x in (a, b)]
                    yield pa.RecordBatch.from_arrays([*names, pa.array(n[some])], ["word_a", "word_b", "n"])

    return count
