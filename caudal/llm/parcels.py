"""Many small facts about places in documents, sent between tasks as few binary rows.

A task numbers the places in the documents it holds at a time, and sends such numbers with columns of values
to buckets. Which document and place a number means is sent once, as the sender's table; answers come back
under the sender's name and are joined with it. The name is a digest of the documents, so a task that is run
again has the same one; an answer without its table is an error, never a lost place.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.arrays import U, mix

PARCELS = "bucket int, kind int, parcel binary"
ANSWERS = "sender long, kind int, parcel binary"
PLACES = "doc_id long, digest long, places binary"
#: values to compare; the sender's table; places that are found, and places to ask about again
VALUES, TABLE, FOUND, AGAIN = range(4)


class Documents(NamedTuple):
    """What a task holds of its documents: ids, digests of the texts, and how many places each has."""

    ids: np.ndarray
    digests: np.ndarray
    counts: np.ndarray

    @property
    def sender(self) -> int:
        order = np.arange(len(self.ids), dtype=np.uint64)
        return int(mix(mix(self.ids.astype(U) ^ mix(self.digests.astype(U))) + order).sum(dtype=U).astype(np.int64))


def merge(parts: list[Documents]) -> Documents:
    return Documents(*(np.concatenate(c) for c in zip(*parts, strict=True)))


def _planes(numbers: np.ndarray) -> np.ndarray:
    """Steps from number to number, all their first bytes before all their second ones: steps are small, and compress so."""
    steps = numbers.astype(np.uint32)
    steps[1:] -= steps[:-1].copy()
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T)


def _from_planes(planes: np.ndarray) -> np.ndarray:
    steps = np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).ravel()
    return np.cumsum(steps, dtype=np.uint32)


def seal(sender: int, numbers: np.ndarray, *columns: np.ndarray) -> bytes:
    return b"".join(x.tobytes() for x in (np.array([sender, len(numbers)]), _planes(numbers), *columns))


def unseal(parcel: bytes, *kinds: type) -> tuple[int, list[np.ndarray]]:
    """The sender; the numbers and the columns, of the named kinds."""
    sender, n = np.frombuffer(parcel, np.int64, 2)
    columns, at = [_from_planes(np.frombuffer(parcel, np.uint8, 4 * n, 16))], 16 + 4 * int(n)
    for kind in kinds:
        columns.append(np.frombuffer(parcel, kind, n, at))
        at += columns[-1].nbytes
    return int(sender), columns


def rows_of(rows: list[tuple[int, int, bytes]], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    first, kinds, blobs = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(first, kind), pa.array(kinds, pa.int32()), pa.array(blobs, pa.binary())], names)


def parcels(
    docs: Documents, bucket: np.ndarray, numbers: np.ndarray, columns: list[np.ndarray], found: tuple[np.ndarray, ...], parts: int
) -> pa.RecordBatch:
    """Rows with the values for each bucket, what is found already, and the table."""
    sender = docs.sender
    order = np.lexsort((numbers, bucket))
    bucket, numbers, columns = bucket[order], numbers[order], [c[order] for c in columns]
    starts = groups(bucket)
    rows = [
        (int(bucket[a]), VALUES, seal(sender, numbers[a:b], *[c[a:b] for c in columns]))
        for a, b in zip(starts, np.append(starts, len(bucket))[1:], strict=True)
    ]
    return parcel_rows(rows + own_rows(docs, found, parts))


def own_rows(docs: Documents, found: tuple[np.ndarray, ...], parts: int) -> list[tuple[int, int, bytes]]:
    sender = docs.sender
    rows = [(sender % parts, TABLE, seal(sender, docs.counts, docs.ids, docs.digests))]
    return rows + [(sender % parts, FOUND, seal(sender, *found))] * bool(len(found[0]))


def parcel_rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return rows_of(rows, pa.int32(), ["bucket", "kind", "parcel"])


def received(batches: Iterator[pa.RecordBatch], answers: list[tuple[int, int, bytes]], *kinds: type) -> list[np.ndarray] | None:
    """Sender, number and columns of all values; what is known already is put to ``answers``."""
    values = []
    for batch in batches:
        for kind, parcel in zip(batch["kind"].to_pylist(), batch["parcel"].to_pylist(), strict=True):
            if kind == VALUES:
                sender, columns = unseal(parcel, *kinds)
                values.append((np.full(len(columns[0]), sender), *columns))
            else:
                answers.append((unseal(parcel)[0], kind, parcel))
    return [np.concatenate(c) for c in zip(*values, strict=True)] if values else None


def answer_rows(answers: list[tuple[int, int, bytes]], kind: int, senders: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The answers there are and those now found, by sender; numbers first, then the ends of stretches if there are any."""
    order = np.lexsort((columns[0], senders))
    senders, columns = senders[order], [c[order] for c in columns]
    starts = groups(senders)
    found = [
        (int(senders[a]), kind, seal(int(senders[a]), *[c[a:b].astype(np.uint32) for c in columns]))
        for a, b in zip(starts, np.append(starts, len(senders))[1:], strict=True)
    ]
    for row in answers + found:
        yield rows_of([row], pa.int64(), ["sender", "kind", "parcel"])


def _expand(kind: int, stretches: bool):
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in batch["rows"].to_pylist():
                tables = [r["parcel"] for r in rows if r["kind"] == TABLE]
                found = [unseal(r["parcel"], *[np.uint32] * stretches)[1] for r in rows if r["kind"] == kind]
                if not found:
                    continue
                if not tables:
                    raise RuntimeError("places without the table of their sender: the input's rows were not dealt alike twice")
                columns = np.unique(np.stack([np.concatenate(c) for c in zip(*found, strict=True)], 1), axis=0).astype(np.int64)
                counts, ids, digests = unseal(tables[0], np.int64, np.int64)[1]
                ends = np.cumsum(counts.astype(np.int64))
                cuts = np.searchsorted(columns[:, 0], np.append(0, ends))
                used = np.flatnonzero(np.diff(cuts))
                blobs = [(columns[cuts[i] : cuts[i + 1]] - (ends[i] - counts[i])).astype(np.int32).tobytes() for i in used]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[used]), pa.array(digests[used]), pa.array(blobs, pa.binary())], ["doc_id", "digest", "places"]
                )

    return expand


def by_document(answers: DataFrame, kind: int = FOUND, stretches: bool = False) -> DataFrame:
    """doc_id, digest, places of the documents that have any, from the answers to their senders.

    Places are 32-bit numbers, stretches pairs of begin and end. What a sender gets is bounded by what it sent
    at a time. Rows that repeat a document give one.
    """
    held = answers.groupBy("sender").agg(F.collect_list(F.struct("kind", "parcel")).alias("rows"))
    return held.select("rows").mapInArrow(_expand(kind, stretches), PLACES).dropDuplicates(["doc_id", "digest"])


def place_array(blob: bytes | None) -> np.ndarray:
    return np.frombuffer(blob or b"", np.int32)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def groups(*keys: np.ndarray) -> np.ndarray:
    """Where a new group begins in arrays sorted alike."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)
