"""Substring deduplication by fixed-block anchors.

Every window of 13 words holds one whole block of 7 words that begins at a multiple of 7. So the
non-overlapping blocks of all documents are the index, every rolling window of 7 words probes it, and only
the 13-word windows around a hit are compared, each with the smallest document that has it. Runs of such
windows are the maximal repeats.

A task sends a block or window once however many of its documents share it: what several documents of a
task have in common is settled within the task. So a passage in a third of all documents is one entry a
task. Probes are compared by 32 bits inside their bucket
(a chance hit costs a few more windows to compare), windows by 96 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm import arrays as A
from caudal.llm import parcels as P
from caudal.llm.arrays import U
from caudal.llm.stage import Stage

#: Entries that a task holds before it sends them.
FLUSH = 1 << 20
_LOW, _HIGH = U((1 << 32) - 1), U(32)


def _word_hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words, and how many come before each text and after the last."""
    data, bounds = A.text_bytes(batch["text"])
    starts, ends, before = A.words(data, bounds)
    return A.hashes(A.prefix_sums(data), starts, ends), before


def _windows(hashes: np.ndarray, before: np.ndarray, k: int, seed: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the k-word windows inside texts of ``least`` words or more, and their number per text."""
    n = np.diff(before)
    counts = np.where(n >= least, n - k + 1, 0)
    if not len(hashes) or not counts.any():
        return np.zeros(0, U), counts
    all_windows = A.joined(hashes, k, seed)
    starts = np.repeat(before[:-1], counts)
    nth = np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts)
    return all_windows[starts + nth], counts


def _documents(batch: pa.RecordBatch, counts: np.ndarray) -> P.Documents:
    return P.Documents(
        batch["doc_id"].to_numpy(zero_copy_only=False).astype(np.int64),
        batch["digest"].to_numpy(zero_copy_only=False).astype(np.int64),
        counts.astype(np.int64),
    )


def _order(docs: P.Documents) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each entry: its place in its text, its document, and the document's rank by id."""
    doc = np.repeat(np.arange(len(docs.ids)), docs.counts)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(docs.counts) - docs.counts, docs.counts)
    return place, doc, np.unique(docs.ids, return_inverse=True)[1][doc]


def _held(batches: Iterator[tuple[P.Documents, tuple[np.ndarray, ...]]]) -> Iterator[tuple[P.Documents, list[np.ndarray]]]:
    """Gather entries until there are enough to send."""
    docs, columns, n = [], [], 0
    for own, entries in batches:
        if n and n + len(entries[0]) > FLUSH:
            yield P.merge(docs), [np.concatenate(c) for c in zip(*columns, strict=True)]
            docs, columns, n = [], [], 0
        docs.append(own)
        columns.append(entries)
        n += len(entries[0])
    if n:
        yield P.merge(docs), [np.concatenate(c) for c in zip(*columns, strict=True)]


def _probes(block: int, window: int, parts: int):
    """Sends blocks and probes; what documents of the task share is known at once."""

    def entries(batches):
        for batch in A.chunks(batches):
            hashes, before = _word_hashes(batch)
            keys, counts = _windows(hashes, before, block, 1, window)
            yield _documents(batch, counts), (keys,)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, (keys,) in _held(entries(batches)):
            place, doc, rank = _order(docs)
            order = np.lexsort((rank, keys))
            key, rank, fixed = keys[order], rank[order], place[order] % block == 0
            starts = P.groups(key)
            sizes = np.diff(np.append(starts, len(key)))
            least, most = rank[starts], rank[starts + sizes - 1]
            has_fixed = np.logical_or.reduceat(fixed, starts)
            first = rank == np.repeat(least, sizes)
            fixed_first = np.repeat(np.logical_or.reduceat(fixed & first, starts), sizes)
            nth_fixed = np.cumsum(fixed) - np.repeat((np.cumsum(fixed) - fixed)[starts], sizes)
            sent = first | (fixed & ~fixed_first & (nth_fixed == 1))
            shared = np.repeat((least != most) & has_fixed, sizes)
            short = (key[sent] >> _HIGH).astype(np.uint32) & ~np.uint32(1) | fixed[sent]
            yield P.parcels(docs, ((key[sent] & _LOW) % U(parts)).astype(np.int32), order[sent], [short], (order[shared],), parts)

    return send


def _hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places whose words some other document has too, one of them as a fixed block."""
    answers: list[tuple[int, int, bytes]] = []
    hit = [np.zeros(0, np.int64)] * 2
    values = P.received(batches, answers, np.uint32)
    if values is not None:
        senders, numbers, keys = values
        order = np.lexsort((senders, keys >> 1))
        key, sender, fixed = keys[order] >> 1, senders[order], (keys[order] & 1).astype(bool)
        starts = P.groups(key)
        sizes = np.diff(np.append(starts, len(key)))
        found = order[np.repeat((sender[starts] != sender[starts + sizes - 1]) & np.logical_or.reduceat(fixed, starts), sizes)]
        hit = [senders[found], numbers[found]]
    yield from P.answer_rows(answers, P.FOUND, *hit)


def _compare(block: int, window: int, parts: int):
    """Sends the windows around hits; of a window that several documents of the task have, the smallest's only."""

    def entries(batches):
        for batch in A.chunks(batches):
            hashes, before = _word_hashes(batch)
            keys, counts = _windows(hashes, before, window, 2, window)
            checks, _ = _windows(hashes, before, window, 3, window)
            asked = np.zeros(len(keys), bool)
            begins = np.cumsum(counts) - counts
            for blob, begin, count in zip(batch["places"].to_pylist(), begins, counts, strict=True):
                at = P.place_array(blob)
                # a window holds the block at p if it begins at p - (window - block) .. p
                asked[begin : begin + count] = A.within(np.maximum(at - (window - block), 0), np.minimum(at + 1, count), count) if count else False
            yield _documents(batch, counts), (keys, checks, asked)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, (keys, checks, asked) in _held(entries(batches)):
            _, doc, rank = _order(docs)
            at = np.flatnonzero(asked)
            order = at[np.lexsort((rank[at], checks[at], keys[at]))]
            key, check, rank = keys[order], checks[order], rank[order]
            starts = P.groups(key, check)
            first = rank == np.repeat(rank[starts], np.diff(np.append(starts, len(key))))
            sent = order[first]
            columns = [key[first], (check[first] >> _HIGH).astype(np.uint32), docs.ids[doc[sent]]]
            yield P.parcels(docs, ((key[first] & _LOW) % U(parts)).astype(np.int32), sent, columns, (order[~first],), parts)

    return send


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that a smaller document has too."""
    answers: list[tuple[int, int, bytes]] = []
    late = [np.zeros(0, np.int64)] * 2
    values = P.received(batches, answers, np.uint64, np.uint32, np.int64)
    if values is not None:
        senders, numbers, keys, checks, ids = values
        order = np.lexsort((ids, checks, keys))
        key, check, doc = keys[order], checks[order], ids[order]
        starts = P.groups(key, check)
        found = order[doc != np.repeat(doc[starts], np.diff(np.append(starts, len(key))))]
        late = [senders[found], numbers[found]]
    yield from P.answer_rows(answers, P.FOUND, *late)


def _cut(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.chunks(batches):
            texts, n_words, n_removed, spans = [], [], [], []
            for text, blob in zip(batch["text"].to_pylist(), batch["places"].to_pylist(), strict=True):
                words = (text or "").encode().split()
                at = P.place_array(blob)
                gone = A.within(at, at + window, len(words)) if len(at) else np.zeros(len(words), bool)
                begins, ends = A.spans(gone) if len(at) else ((), ())
                texts.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if len(at) else words).decode())
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                spans.append([[int(a), int(b)] for a, b in zip(begins, ends, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(texts, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64())))],
                ["doc_id", "text", "n_words", "n_removed", "spans"],
            )

    return cut


def remove_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text, n_words, n_removed, spans.

    Every word goes that lies in a window whose words also begin somewhere in a document with a smaller id;
    ``text`` is the other words joined by one space, ``spans`` the maximal runs removed, in words. Windows
    are judged on the input. A null text has no words. Documents of one id don't count as smaller than one
    another; a row with a null id takes no part and keeps its words. Ids are whole numbers. Other columns
    are not carried.
    """
    stage = Stage(docs.sparkSession)
    block = (window + 1) // 2
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("digest", F.xxhash64("text"))
    parts = P.partitions(docs)
    some = rows.where("doc_id IS NOT NULL AND text IS NOT NULL")
    deal = lambda sent: sent.repartitionById(parts, "bucket")
    hits = stage.put(deal(some.mapInArrow(_probes(block, window, parts), P.PARCELS)).mapInArrow(_hits, P.ANSWERS), "hits")
    asked = stage.put(some.join(P.by_document(hits), ["doc_id", "digest"]), "asked")
    stage.drop("hits")
    late = stage.put(deal(asked.mapInArrow(_compare(block, window, parts), P.PARCELS)).mapInArrow(_later, P.ANSWERS), "late")
    stage.drop("asked")
    judged = rows.join(P.by_document(late), ["doc_id", "digest"], "left").select("doc_id", "text", "places")
    return judged.mapInArrow(_cut(window), "doc_id long, text string, n_words long, n_removed long, spans array<array<long>>")
