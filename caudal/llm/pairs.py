"""Pairs of short sets in regions: a task takes many whole regions at a time and compares their nodes by the array.

Each node meets those that stand one place further in its region, then two places, and so on, in all regions at
once. Of each pair in different components, sketches say whether the two can be similar at all, and their sets
whether they are; similar ones are put into one component at once, which saves the comparisons it settles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm import parcels as P
from caudal.llm.arrays import U
from caudal.llm.regions import Sets, in_blocks, similar, stretches  # noqa: F401
from caudal.llm.stage import Stage

#: Bytes of text that a task compares at a time, if no single region has more.
BLOCK = 1 << 20
#: Classes of a sketch, pairs whose sketches are compared at a time, and shingles whose sets are.
CLASSES, PAIRS, VALUES = 256, 1 << 12, 1 << 20


def distinct_regions(regions: DataFrame, stage: Stage, name: str) -> DataFrame:
    """region, n, node of the regions with several nodes; those of the same nodes once. ``regions`` has a node once a region."""
    marks = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"mark{i}") for i in range(2)]
    sizes = regions.groupBy("region").agg(F.count("*").alias("n"), *marks).where("n > 1")
    kept = sizes.groupBy("n", "mark0", "mark1").agg(F.min("region").alias("region")).select("region", "n")
    kept = stage.put(kept, f"{name}-kept", free=False)  # from a table, so that the join can be split for a large region
    return regions.join(kept, "region").select("region", "n", "node")


def _whole_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by region, in tables of whole regions with about BLOCK bytes of text."""

    def cut(table: pa.Table, last: bool) -> Iterator[pa.Table]:
        starts = np.append(P.groups(table["region"].to_numpy()), table.num_rows)
        before = np.append(0, np.cumsum(pc.binary_length(table["shape"]).to_numpy().astype(np.int64)))[starts]
        at, end = 0, len(starts) - (1 if last else 2)  # the last region may go on in the next batch
        while at < end:
            to = min(end, max(at + 1, int(np.searchsorted(before, before[at] + BLOCK, "right")) - 1))
            yield table.slice(starts[at], starts[to] - starts[at])
            at = to
        if not last:
            held.append(table.slice(starts[end]))

    held: list[pa.Table] = []
    for batch in batches:
        if batch.num_rows:
            table = pa.concat_tables([*held, pa.Table.from_batches([batch])]).combine_chunks()
            held.clear()
            yield from cut(table, False)
    if held:
        yield from cut(held[0], True)


def _alike(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sets are similar; so many pairs at a time that their sets have VALUES shingles, or one pair."""
    out, at = np.zeros(len(x), bool), 0
    ends = np.cumsum(sizes[x] + sizes[y])
    while at < len(x):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + VALUES, "right")))
        own, other = x[at:to], y[at:to]
        out[at:to] = similar(
            (stretches(values, starts[own], sizes[own]), sizes[own]), (stretches(values, starts[other], sizes[other]), sizes[other]), percent
        )
        at = to
    return out


def block_links(region: np.ndarray, values: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows whose links connect what all similar pairs of each region would connect.

    ``region`` is sorted; ``values`` are the rows' sets one after another, each sorted, with the given sizes.
    """
    n = len(region)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(n), sizes)
    counts = np.bincount(owner * CLASSES + (values & U(CLASSES - 1)).astype(np.int64), minlength=n * CLASSES)
    counts = counts.reshape(n, CLASSES).astype(np.int32)
    bounds = np.append(P.groups(region), n)
    number = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    component, found = np.arange(n), []
    left = np.arange(n)
    for step in range(1, int(np.diff(bounds).max(initial=0))):
        left = left[left + step < bounds[number[left] + 1]]
        both = np.minimum(sizes[left], sizes[left + step]), np.maximum(sizes[left], sizes[left + step])
        x = left[(component[left] != component[left + step]) & (100 * both[0] >= percent * both[1])]
        near = np.zeros(len(x), bool)
        for at in range(0, len(x), PAIRS):
            own = x[at : at + PAIRS]
            # what counts by class differ in is never more than what the sets differ in
            apart = np.abs(counts[own] - counts[own + step]).sum(1)
            near[at : at + PAIRS] = apart * (100 + percent) <= (100 - percent) * (sizes[own] + sizes[own + step])
        x = x[near]
        for i in x[_alike(values, starts, sizes, x, x + step, percent)].tolist():
            j = i + step
            if component[i] != component[j]:
                found.append((i, j))
                mine = component[bounds[number[i]] : bounds[number[i] + 1]]
                mine[mine == component[j]] = component[i]
    first, second = zip(*found, strict=True) if found else ((), ())
    return np.array(first, np.int64), np.array(second, np.int64)


def linked_pairs(rows: DataFrame, sets: Sets, percent: int) -> DataFrame:
    """node, pivot: links that connect what all pairs of each region would connect. ``rows``: region, node, shape.

    A region is in one task, so its nodes are to be bounded in number by the caller.
    """

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_regions(batches):
            values, sizes = sets(table["shape"].to_pylist())
            x, y = block_links(table["region"].to_numpy(), values, sizes, percent)
            if len(x):
                nodes = table["node"].combine_chunks()
                yield pa.RecordBatch.from_arrays([nodes.take(pa.array(x)), nodes.take(pa.array(y))], ["node", "pivot"])

    rows = rows.select("region", "node", "shape").repartition("region").sortWithinPartitions("region")
    return rows.mapInArrow(links, "node binary, pivot binary")
