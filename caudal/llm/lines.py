"""Fuzzy line deduplication by MinHash.

Lines are sets of character shingles. The signature of a long line has the least hash of each of a number of
bins, that of a short one the least of as many hash functions; bands of the signature are the keys under which
lines meet. Lines that share a band are compared by their exact Jaccard similarity, and one line of each
connected component stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm import arrays as A
from caudal.llm import parcels as P
from caudal.llm.arrays import U
from caudal.llm.components import connected
from caudal.llm.pairs import distinct_regions, in_blocks, linked_pairs
from caudal.llm.regions import SMALL, Entries, join_regions, meet, node_bytes, sketch
from caudal.llm.stage import Stage

#: Characters of a shingle, and the similarity from which on lines are alike. With seven characters, lines that
#: have nothing to do with each other share a few in a thousand shingles only.
SHINGLE, PERCENT = 7, 80
#: Lines alike in 80 % of their shingles share one of ten bands of four with a probability of 0.995.
BANDS, ROWS = 10, 4
#: Lines of at most so many shingles have a hash function for each value of their signature, those of at least
#: so many have a bin; lines of sizes between have both, so that two lines that are alike have one kind in common.
SHORT, LONG = 100, 80
#: Regions of up to so many times the nodes of a small one are compared by blocks; pivots divide larger ones.
BLOCKS = 8
#: Bytes of text whose shingles are worked out at a time: their fingerprints stay near the processor.
PIECE = 1 << 18


class Lines(NamedTuple):
    """Lines that hold a word: begin and end as code points, number of the text, number in the text."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    number: np.ndarray


def code_points(texts: list[str | None]) -> np.ndarray:
    """All texts, joined by line feeds."""
    return np.frombuffer("\n".join(t or "" for t in texts).encode("utf-32-le"), np.uint32)


def split_lines(points: np.ndarray, texts: list[str | None]) -> Lines:
    cuts = np.flatnonzero(points == 10)
    starts, ends = np.concatenate(([0], cuts + 1)), np.append(cuts, len(points))
    lengths = np.array([len(t or "") for t in texts], np.int64)
    begins = np.cumsum(lengths + 1) - lengths - 1
    text = np.searchsorted(begins, starts, "right") - 1
    number = np.arange(len(starts)) - np.searchsorted(starts, begins)[text]
    ink = np.concatenate(([0], np.cumsum((points != 32) & ((points < 9) | (points > 13)))))
    kept = ink[ends] > ink[starts]
    return Lines(*(c[kept] for c in (starts, ends, text, number)))


def line_names(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of each line."""
    a = A.hashes(sums, starts, ends)
    _, down = A.powers(len(sums))
    return a, (A.mix((sums[ends] - sums[starts]) * down[starts] ^ U(0xA5A5A5A5A5A5A5A5)) >> U(32)).astype(np.uint32)


def _sums(points: np.ndarray) -> np.ndarray:
    return A.value_sums(A.mix(points.astype(U) + U(0x51ED270B7A1F3C6D)))


def _shingles(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int, every: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all shingles, and the line of each; a line shorter than a shingle is one."""
    counts = np.maximum(ends - starts - k, 0) + 1
    before = np.cumsum(counts) - counts
    line = np.repeat(np.arange(len(starts)), counts)
    at = np.arange(len(line)) + np.repeat(starts - before, counts)
    every = A.rolling(sums, k) if every is None else every
    values = every.take(at, mode="clip") if len(every) else np.zeros(len(at), U)
    short = ends - starts < k
    values[before[short]] = A.hashes(sums, starts[short], ends[short])
    return values, line


def one_line(text: str, k: int) -> np.ndarray:
    points = code_points([text])
    return np.unique(_shingles(_sums(points), np.array([0]), np.array([len(points)]), k)[0])


def line_sets(lines: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of several lines, sorted and each once, one line after another, and how many each has."""
    points = code_points(lines)
    cuts = np.append(np.flatnonzero(points == 10), len(points)) if lines else np.zeros(0, np.int64)
    values, line = _shingles(_sums(points), np.append(0, cuts[:-1] + 1) if lines else cuts, cuts, k)
    values = A.sorted_each(values, np.bincount(line, minlength=len(lines)))
    once = P.groups(line, values)
    return values[once], np.bincount(line[once], minlength=len(lines))


def hashed_signatures(values: np.ndarray, line: np.ndarray, n: int, size: int) -> np.ndarray:
    """A row of ``size`` values for each of n lines, in order, each of which has a shingle: the least of as many hashes."""
    starts = np.searchsorted(line, np.arange(n))
    factors = np.random.default_rng(7).integers(1, 2**63, size, dtype=np.int64).astype(U) * U(2) + U(1)
    return np.stack([np.minimum.reduceat((values * f) >> U(32), starts) for f in factors], 1)


def binned_signatures(values: np.ndarray, line: np.ndarray, n: int, bins: int) -> np.ndarray:
    """A row of ``bins`` values for each of n lines: the least hash of each bin, empty bins borrowing from others."""
    empty = np.uint64(1 << 32)
    least = np.full(n * bins, empty)
    np.minimum.at(least, line * bins + ((values >> U(32)) * U(bins) >> U(32)).astype(np.int64), values & U(0xFFFFFFFF))
    least = least.reshape(n, bins)
    rows = np.flatnonzero((least == empty).any(1))
    own, filled = least[rows], least[rows].copy()
    draw = np.random.default_rng(8)
    while (missing := filled == empty).any():
        # another place for every bin, drawn anew until it is a full one
        borrowed = own[:, draw.integers(0, bins, bins)]
        usable = missing & (borrowed != empty)
        filled[usable] = borrowed[usable]
    least[rows] = filled
    return least


def band_keys(
    sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int, bands: int, rows: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of lines, and their key for a band."""
    counts = np.maximum(ends - starts - k, 0) + 1
    every = A.rolling(sums, k)
    factors = np.random.default_rng(9).integers(1, 2**63, rows, dtype=np.int64).astype(U) * U(2) + U(1)
    for kind, (chosen, sign) in enumerate(((counts <= SHORT, hashed_signatures), (counts >= LONG, binned_signatures))):
        own = np.flatnonzero(chosen)
        if not len(own):
            continue
        least = sign(*_shingles(sums, starts[own], ends[own], k, every), len(own), bands * rows)
        keys = (least.reshape(-1, bands, rows) * factors).sum(2, dtype=U)
        keys = A.mix(keys + A.mix(2 * np.arange(bands).astype(U) + U(kind + 1)))
        yield np.repeat(own, bands), keys.ravel()


def _band_entries(k: int, bands: int, rows: int):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[Entries]:
        for batch in A.chunks(batches, size=PIECE):
            texts = batch["text"].to_pylist()
            points = code_points(texts)
            lines, sums = split_lines(points, texts), _sums(points)
            a, b = line_names(sums, lines.starts, lines.ends)
            once = np.sort(np.unique(a, return_index=True)[1])
            a, b, starts, ends = a[once], b[once], lines.starts[once], lines.ends[once]
            if not len(a):
                continue
            for own, keys in band_keys(sums, starts, ends, k, bands, rows):
                yield keys, a[own], b[own]

    return entries


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in A.chunks(batches, size=PIECE):
        texts = batch["text"].to_pylist()
        points = code_points(texts)
        lines = split_lines(points, texts)
        text = pa.array(lines.text)
        yield pa.RecordBatch.from_arrays(
            [batch["id"].take(text), batch["digest"].take(text), pa.array(lines.number.astype(np.int32)), node_bytes(*line_names(_sums(points), lines.starts, lines.ends))],
            ["id", "digest", "line", "node"],
        )


def _pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The asked lines of each text."""
    for batch in A.chunks(batches):
        nodes, shapes = [], []
        for text, asked in zip(batch["text"].to_pylist(), batch["asked"].to_pylist(), strict=True):
            lines = text.split("\n")
            nodes += [x["node"] for x in asked]
            shapes += [lines[x["line"]] for x in asked]
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(shapes, pa.string())], ["node", "shape"])


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in A.chunks(batches, "shape"):
        values, counts = line_sets(batch["shape"].to_pylist(), SHINGLE)
        sketches = [sketch(own) for own in np.split(values, np.cumsum(counts)[:-1])]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sketches, pa.binary())], ["node", "shape", "sketch"])


def linked_lines(regions: DataFrame, shapes: DataFrame, stage: Stage, small: int = SMALL) -> DataFrame:
    """node, component: lines connected by links inside some region. ``regions`` has a node once a region.

    The pairs of a region of up to ``small`` nodes are compared in its task, those of one of up to BLOCKS times as
    many in a task for every two of its blocks. Larger regions are divided by pivots: a pivot that many nodes of a
    region are unlike sends each of them to a region for every few of its shingles, dozens in a line of prose.
    """
    sets = partial(line_sets, k=SHINGLE)
    rows = stage.put(distinct_regions(regions, stage, "several"), "several")
    few = in_blocks(rows.where(F.col("n") <= BLOCKS * small), small).join(shapes, "node")
    links = stage.put(linked_pairs(few, sets, PERCENT), "links")
    large = rows.where(F.col("n") > BLOCKS * small).select("region", "node")
    if not large.isEmpty():
        asked = shapes.join(large.select("node").distinct(), "node").select("node", "shape")
        sketched = stage.put(asked.mapInArrow(_sketched, "node binary, shape string, sketch binary"), "sketched")
        divided = join_regions(large, sketched, sets, PERCENT, stage, small)
        links = links.union(divided.select("node", F.col("component").alias("pivot")))
    return connected(links, stage, "components")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in A.chunks(batches):
        texts, counts, removed = [], [], []
        for text, gone in zip(batch["text"].to_pylist(), batch["gone"].to_pylist(), strict=True):
            lines, gone = [] if text is None else text.split("\n"), set(gone or ())
            kept = [line for n, line in enumerate(lines) if n not in gone]
            texts.append(text if not gone else "\n".join(kept))
            counts.append(len(lines))
            removed.append(len(lines) - len(kept))
        yield pa.RecordBatch.from_arrays(
            [batch["id"], pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())],
            ["id", "text", "n_lines", "n_removed"],
        )


def repeated_lines(rows: DataFrame, stage: Stage, small: int = SMALL) -> DataFrame:
    """id, digest, gone: the numbers of the lines that go, for texts that lose any. ``rows``: id, text, digest."""
    kind = rows.schema["id"].dataType.simpleString()
    regions = stage.put(meet(rows.select("text"), _band_entries(SHINGLE, BANDS, ROWS)), "regions")
    found = stage.put(rows.mapInArrow(_occurrences, f"id {kind}, digest long, line int, node binary"), "occurrences")
    # occurrences are summed up by line once: all that follows sees lines that stand twice or share a region
    place = F.struct("id", "digest", "line")
    met = regions.select("node").distinct().withColumn("met", F.lit(True))
    nodes = found.groupBy("node").agg(F.min(place).alias("first"), F.count("*").alias("n")).join(met, "node", "left").where("n > 1 OR met")
    nodes = stage.put(nodes, "nodes")
    # the text of each line in a region, from one of the documents that have it
    source = nodes.where("met").groupBy("first.id", "first.digest").agg(F.collect_list(F.struct("node", "first.line")).alias("asked"))
    held = rows.join(source.withColumnRenamed("id", "_id").withColumnRenamed("digest", "_digest"), F.expr("id <=> _id AND digest = _digest"))
    shapes = stage.put(held.select("text", "asked").mapInArrow(_pick, "node binary, shape string").dropDuplicates(["node"]), "shapes")
    linked = stage.put(linked_lines(regions, shapes, stage, small), "linked")
    named = nodes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # rows that repeat a document hold each of its lines as often; only the place tells lines apart
    first = named.groupBy("component").agg(F.min("first").alias("first"), F.sum("n").alias("n")).where("n > 1")
    first = stage.put(first.select("component", "first"), "first")
    repeated = stage.put(named.select("node", "component").join(first, "component").select("node", "first"), "repeated")
    later = found.join(repeated, "node").where(~place.eqNullSafe(F.col("first")))
    return later.groupBy("id", "digest").agg(F.collect_set("line").alias("gone"))


def remove_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", small: int = SMALL) -> DataFrame:
    """One row per document: id, text, n_lines, n_removed.

    Of the lines that are alike, over all documents and connected through others, the first by id and place
    stays and the others go with their line feed. Lines without a word are no copies of anything and stay. A
    null text stays null, an empty one empty; a text that loses all its lines becomes empty. Rows that repeat a
    document are treated alike: what goes in one goes in all. A null id comes first. Other columns are not carried.
    """
    stage = Stage(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("digest", F.xxhash64("text"))
    gone = repeated_lines(rows, stage, small).withColumnRenamed("id", "_id").withColumnRenamed("digest", "_digest")
    kind = rows.schema["id"].dataType.simpleString()
    judged = rows.join(gone, F.expr("id <=> _id AND digest = _digest"), "left").select("id", "text", "gone")
    return judged.mapInArrow(_cut, f"id {kind}, text string, n_lines long, n_removed long").withColumnRenamed("id", id_col)


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents with all their columns, less the repeated lines; ``length_col``, if there is one, is the new length."""
    stage = Stage(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("digest", F.xxhash64("text"))
    gone = repeated_lines(rows, stage).select(*[F.col(c).alias(f"_caudal_{c}") for c in ("id", "digest", "gone")])
    lost = F.col("_caudal_gone")
    kept = F.filter(F.split(text_col, "\n", -1), lambda _, n: ~F.array_contains(lost, n))
    text = F.when(lost.isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    same = docs[id_col].eqNullSafe(F.col("_caudal_id")) & (F.xxhash64(docs[text_col]) == F.col("_caudal_digest"))
    out = docs.join(gone, same, "left").withColumn(text_col, text)
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    return out.select(*docs.columns)
