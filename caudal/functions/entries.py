"""Terms of documents, counted inside tasks: rows of one id meet sorted, and are summed as they come."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class Counted(NamedTuple):
    """Documents with their terms: place of the document in ``ids``, of the term in ``terms``, and how often."""

    ids: list
    #: rows that have the id
    copies: np.ndarray
    terms: pa.Array
    document: np.ndarray
    term: np.ndarray
    n: np.ndarray

    def cut(self, first: int, stop: int) -> Counted:
        mine = (self.document >= first) & (self.document < stop)
        return Counted(self.ids[first:stop], self.copies[first:stop], self.terms, self.document[mine] - first, self.term[mine], self.n[mine])


def _count(ids: list, words: pa.Array, before: Counted | None, dropped: pa.Array) -> Counted:
    """Count the words of rows in order of the id; ``before`` has what is known of the first id. Rows without an id stay apart."""
    split = pc.split_pattern(words, " ")
    tokens, row = split.flatten(), np.repeat(np.arange(len(words)), np.diff(split.offsets.to_numpy()))
    weights, copies = np.ones(len(tokens), np.int64), np.ones(len(ids), np.int64)
    if before is not None:
        ids, copies, row = before.ids + ids, np.append(before.copies, copies), np.append(before.document, row + 1)
        tokens = pa.concat_arrays([before.terms.take(pa.array(before.term)), tokens])
        weights = np.append(before.n, weights)
    new = np.array([at == 0 or i is None or i != ids[at - 1] for at, i in enumerate(ids)], bool)
    document = np.cumsum(new) - 1
    coded = pc.dictionary_encode(tokens)
    terms, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    mine = ~pc.is_in(terms, dropped).to_numpy(zero_copy_only=False)[codes]
    keys, weights = (document[row] << 32 | codes)[mine], weights[mine]
    keys, place = np.unique(keys, return_inverse=True)
    n = np.bincount(place, weights, len(keys)).astype(np.int64)
    starts = np.flatnonzero(new)
    return Counted([ids[i] for i in starts], np.add.reduceat(copies, starts), terms, keys >> 32, keys & (1 << 32) - 1, n)


def counted(rows: Iterator[tuple[list, pa.Array]], dropped: list[str]) -> Iterator[Counted]:
    """Documents of batches (ids, words between spaces) that come in order of the id; each in one piece."""
    left, held = pa.array([*dropped, ""], pa.string()), None
    for ids, words in rows:
        if ids:
            whole = _count(ids, words, held, left)
            last = len(whole.ids) - 1
            held = whole.cut(last, last + 1)
            if last:
                yield whole.cut(0, last)
    if held is not None:
        yield held


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The batches, cut where the part changes."""
    for batch in batches:
        part = batch["part"].to_numpy()
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)] if len(part) else []
        for low, high in zip(cuts, cuts[1:], strict=False):
            yield int(part[low]), batch.slice(low, high - low)


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Each part with its batches, which are read before the next part is asked for."""
    pieces = _parts(batches)
    ahead = [next(pieces, None)]

    def own(part: int) -> Iterator[pa.RecordBatch]:
        while ahead[0] is not None and ahead[0][0] == part:
            yield ahead[0][1]
            ahead[0] = next(pieces, None)

    while ahead[0] is not None:
        part = ahead[0][0]
        yield part, own(part)


def document_frequencies(dropped: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(part, term, df, unnamed): documents that have the term, and whether one without an id has it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in _by_part(batches):
            for c in counted(((b["id"].to_pylist(), b["words"]) for b in own), dropped):
                named = np.array([i is not None for i in c.ids], bool)[c.document]
                df, without = (np.bincount(c.term[at], minlength=len(c.terms)) for at in (named, ~named))
                some = np.flatnonzero(df + without)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), part), pa.int32()), c.terms.take(pa.array(some)), pa.array(df[some], pa.int64()), pa.array((without[some] > 0).astype(np.int64))],
                    ["part", "term", "df", "unnamed"],
                )

    return count


def terms_of_parts(dropped: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(part, term) for the terms of each part, once."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = pa.array([*dropped, ""], pa.string())
        for part, own in _by_part(batches):
            known = pa.array([], pa.string())
            for b in own:
                known = pc.unique(pa.concat_arrays([known, pc.unique(pc.split_pattern(b["words"], " ").flatten())]))
            known = known.filter(pc.invert(pc.is_in(known, left)))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(known), part), pa.int32()), known], ["part", "term"])

    return ask


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def vectors(dropped: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, indices, tf, tf_idf) of each document row; of a part, the terms with index and idf come first."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in _by_part(batches):
            held: list[pa.RecordBatch] = []

            def documents(own=own, held=held) -> Iterator[tuple[list, pa.Array]]:
                for b in own:
                    named = b["index"].is_valid()
                    held.append(b.filter(named).select(["words", "index", "idf"]))
                    b = b.filter(pc.invert(named))
                    kind.append(b["id"].type)
                    yield b["id"].to_pylist(), b["words"]

            kind: list[pa.DataType] = []
            dictionary = None
            for c in counted(documents(), dropped):
                if dictionary is None:  # documents come after all terms
                    dictionary = pa.Table.from_batches(held).combine_chunks()
                    words, indices, idf = (dictionary[n].combine_chunks() for n in ("words", "index", "idf"))
                    indices, idf = (x.to_numpy(zero_copy_only=False) for x in (indices, idf))
                at = pc.fill_null(pc.index_in(c.terms, words), -1).to_numpy(zero_copy_only=False)[c.term]
                nameless = np.array([i is None for i in c.ids], bool)
                mine = (at >= 0) & ~nameless[c.document]
                document, at, n = c.document[mine], at[mine], c.n[mine]
                order = np.lexsort((indices[at], document))
                document, at, n = document[order], at[order], n[order]
                offsets = np.searchsorted(document, np.arange(len(c.ids) + 1))
                lists = [_lists(offsets, v) for v in (indices[at], n, n * idf[at])]
                rows = pa.RecordBatch.from_arrays([pa.array(c.ids, kind[0]), *lists], ["id", "indices", "tf", "tf_idf"])
                if (c.copies > 1).any():
                    for low in range(len(c.ids)):
                        for _ in range(c.copies[low]):
                            yield rows.slice(low, 1)
                else:
                    yield rows

    return place


def distinct_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches without the rows that stand in the same batch before."""
    for batch in batches:
        yield from pa.Table.from_batches([batch]).group_by(batch.schema.names).aggregate([]).select(batch.schema.names).to_batches()
