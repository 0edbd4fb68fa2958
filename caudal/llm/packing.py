"""Best-fit packing of tokenised documents into sequences.

Best fit decreasing looks at lengths only, and lengths are bounded by the capacity. So the fit is decided
once on the counts of the lengths, many equal documents at a time, and every document finds its place by
its rank among those of its length.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.arrays import chunks
from caudal.llm.parcels import groups
from caudal.llm.stage import Stage


class Placed(NamedTuple):
    """``count`` documents of one length, from rank ``first`` on, go into bins from ``bin`` on, ``each`` per bin."""

    length: int
    first: int
    count: int
    bin: int
    each: int
    offset: int


class Capacities:
    """Segment tree over remaining capacities: which ones have an open bin."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.size)

    def add(self, remaining: int, bins: int) -> None:
        at = self.size + remaining
        while at:
            self.open[at] += bins
            at //= 2

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of an open bin that still holds ``length``."""
        at = self.size + length
        if self.open[at]:
            return length
        while at > 1 and (at % 2 or not self.open[at + 1]):
            at //= 2
        if at <= 1:
            return None
        at += 1
        while at < self.size:
            at = 2 * at if self.open[2 * at] else 2 * at + 1
        return at - self.size


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[Placed]:
    """Where best fit decreasing puts ``counts[length]`` documents of each length.

    Equal documents take the same way: into a bin as many as it holds, then into the next bin with as much
    room left. Time and result depend on the number of lengths, not of documents.
    """
    tree, groups, placed, bins = Capacities(capacity), {}, [], 0

    def put(remaining: int, start: int, n: int) -> None:
        groups.setdefault(remaining, []).append((start, n))
        tree.add(remaining, n)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining, new = capacity, -(-left // (capacity // length))
                put(capacity, bins, new)
                bins += new
            start, n = groups[remaining].pop()
            tree.add(remaining, -n)
            each = min(remaining // length, left)
            used = min(n, left // each)
            placed.append(Placed(length, rank, used * each, start, each, capacity - remaining))
            put(remaining - each * length, start, used)
            if n > used:
                put(remaining, start + used, n - used)
            rank += used * each
            left -= used * each
    return placed


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], list[int]]:
    """Ids of a text without special tokens added, as the ``tokenizers`` library gives them for this file.

    Byte-level merges of a file are run by ``tiktoken``, which gives the same ids several times faster;
    texts with the string of a special token, and files of another kind, go to ``tokenizers`` itself.
    """
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    slow = lambda text: own.encode(text, add_special_tokens=False).ids
    before, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or spec.get("normalizer") or model.get("dropout"):
        return slow
    import public_tokenizers
    import tiktoken

    # printable characters stand for themselves, the other bytes for characters from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    special = [t["content"] for t in spec.get("added_tokens", [])]
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("merges", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        return slow(text) if any(s in text for s in special) else fast.encode_ordinary(text)

    return encode


def tokenised_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", numbers: tuple[str, ...] = ()
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: id, piece, start, length, ids_crc32, and the document's long columns ``numbers``.

    A document is its ids and ``end_id``. A longer one is cut so that only its first piece may be shorter.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in chunks(batches, "text"):
            rows = []
            for number, text in enumerate(batch["text"].to_pylist()):
                ids = np.array([*encode(text or ""), end_id], "<u4")
                stop = len(ids) % capacity or capacity
                start = piece = 0
                while start < len(ids):
                    rows.append((number, piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes())))
                    start, stop, piece = stop, stop + capacity, piece + 1
            columns = np.array(rows, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].take(pa.array(columns[0])),
                    pa.array(columns[1].astype(np.int32)),
                    *[pa.array(c) for c in columns[2:]],
                    *[batch[c].take(pa.array(columns[0])) for c in numbers],
                ],
                ["id", "piece", "start", "length", "ids_crc32", *numbers],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *numbers)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(cut, ", ".join([f"id {kind}, piece int, start long, length long, ids_crc32 long", *[f"{c} long" for c in numbers]]))


def ranked(pieces: DataFrame, buckets: int) -> DataFrame:
    """Adds the rank of each piece among those of its length, from 0; a length's pieces are ranked in many parts."""
    rows = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "piece"), F.lit(buckets)))
    counts = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("id", "piece"))
    return (
        rows.withColumn("place", within)
        .join(starts, ["length", "bucket"])
        .select(*pieces.columns, (F.col("first") + F.col("place") - 1).alias("rank"))
    )


Places = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def places(counts: dict[int, int], capacity: int) -> Places:
    """Gives the bin and the offset for lengths and ranks among the pieces of that length."""
    plan = np.array(sorted(best_fit_decreasing(counts, capacity)), np.int64).reshape(-1, len(Placed._fields)).T
    lengths, firsts, _, bins, each, offsets = plan
    keys = (lengths << 44) + firsts

    def place(length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(keys, (length << 44) + rank, "right") - 1
        nth = rank - firsts[at]
        return bins[at] + nth // each[at], offsets[at] + nth % each[at] * length

    return place


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone. Repeated rows are packed each. Other columns are not carried.
    An empty table gives no rows. The driver sees one count per length and the plan made of them, whose
    size is bounded by the capacity and not by the documents.
    """
    spark = docs.sparkSession
    stage = Stage(spark)
    pieces = stage.put(tokenised_pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    find = places(counts, capacity)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = find(*(batch[c].to_numpy(zero_copy_only=False) for c in ("length", "rank")))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:-1], "sequence_id", "offset"]
            )

    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = pieces.schema["id"].dataType.simpleString()
    placed = ranked(pieces, buckets).mapInArrow(
        place, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return placed.withColumnRenamed("id", id_col)


#: Documents of a window that is packed by itself, where the order is to be kept.
WINDOW = 8192


def _with_place(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    at = docs.metadataColumn("_metadata")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), at["file_name"].alias("name"), at["row_index"].alias("row"))


def in_order(docs: DataFrame, stage: Stage, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """id, text, file and row of the documents; file and first, the number of documents in the files before.

    Files are numbers made of their names, and ordered by name, which begins with the number of the task that wrote
    them. Documents that no Parquet files are behind are written first, as they stand. One row a file is summed up in
    one task.
    """
    try:
        rows = _with_place(docs, id_col, text_col)
    except AnalysisException:
        rows = _with_place(stage.put(docs.select(id_col, text_col), "documents"), id_col, text_col)
    file = F.xxhash64("name").alias("file")
    before = Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("name").agg(F.count("*").alias("n"))
    starts = stage.put(sizes.select(file, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "files")
    return rows.select("id", "text", file, "row"), starts


def pack_in_order(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The same rows as ``pack``, with the order of the documents kept from window to window.

    Every ``window`` documents that follow one another are packed by themselves, by best fit decreasing, in one task;
    what it holds is 48 bytes a piece. Sequence numbers rise with the windows and leave gaps, so sequences that are
    read in their order have a mix of sources as the documents had it, to within a window. Nulls, empty texts,
    repeated rows and empty tables as in ``pack``.
    """
    stage = Stage(docs.sparkSession)
    rows, starts = in_order(docs, stage, id_col, text_col)
    pieces = tokenised_pieces(rows, tokenizer, capacity, end_id, "id", "text", numbers=("file", "row")).join(starts, "file")
    kind = pieces.schema["id"].dataType.simpleString()

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("nth", "ascending"), ("piece", "ascending")])
        length = table["length"].to_numpy()
        order = np.argsort(length, kind="stable")
        starts = groups(length[order])
        sizes = np.diff(np.append(starts, len(order)))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - np.repeat(starts, sizes)
        sequence, offset = places(dict(zip(length[order[starts]].tolist(), sizes.tolist(), strict=True)), capacity)(length, rank)
        sequence = sequence + (int(table["window"][0].as_py()) << 32)
        columns = ["id", "piece", "start", "length", "ids_crc32"]
        return table.select(columns).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    placed = (
        pieces.withColumn("nth", F.col("first") + F.col("row"))
        .withColumn("window", F.expr(f"nth div {window}"))
        .groupBy("window")
        .applyInArrow(place, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    )
    return placed.withColumnRenamed("id", id_col)
