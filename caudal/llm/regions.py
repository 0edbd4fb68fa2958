"""Regions: sets that share a key, joined exactly by their Jaccard distance.

``meet`` finds the nodes that share a key with another node. ``join_regions`` links the nodes of each region
that are similar enough and gives connected components. In each round the most central node of a region is its
pivot, and every other one is measured against it and against nothing else, first by its sketch: texts are sent for
the pairs only that sketches let be similar. Nodes within the threshold are the pivot's cell and linked with it.
A link between two others, one of them outside the cell, is left to find. By the triangle inequality what x and y differ in from the pivot, dx and dy, must then largely agree: they have
at least (|dx| + |dy| - |xy|) / 2 shingles in common, |xy| being the most that similar sets differ in. So each
node goes on to the regions of the first shingles of its difference, as many as make sure that two such nodes
meet, those that the pivot doesn't have first. A cell's nodes near the pivot go to few regions or none. The new
regions are joined in the same way, until all nodes of each are in one component. What the pivot leaves open in a
region of a few blocks of nodes is found by the pairs whose sketches, counts of shingles by class, don't differ too
much. Near copies share very many regions with one pivot; these are then united, so that a pair is compared once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm import arrays as A
from caudal.llm import parcels as P
from caudal.llm.arrays import U
from caudal.llm.components import connected
from caudal.llm.stage import Stage

#: Entries that a task holds before it sends them.
FLUSH = 1 << 20
#: A region of at most so many nodes is finished by pairs in one task.
SMALL = 1024
#: Regions of up to so many times the nodes of a small one are finished by the pairs of their blocks.
BLOCKS = 8
#: Shingles that a node's set is compared with at a time.
VALUES = 1 << 20
_HIGH = U(32)

#: keys, and the nodes that have them as 64 and 32 bits
Entries = tuple[np.ndarray, np.ndarray, np.ndarray]


def node_bytes(a: np.ndarray, b: np.ndarray) -> pa.Array:
    """Nodes as twelve bytes each."""
    raw = np.zeros(len(a), [("a", ">u8"), ("b", ">u4")])
    raw["a"], raw["b"] = a, b
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(12), len(a), [None, pa.py_buffer(raw.tobytes())]).cast(pa.binary())


def _held(entries: Iterator[Entries]) -> Iterator[list[np.ndarray]]:
    held, n = [], 0
    for own in entries:
        if n and n + len(own[0]) > FLUSH:
            yield [np.concatenate(c) for c in zip(*held, strict=True)]
            held, n = [], 0
        held.append(own)
        n += len(own[0])
    if n:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _in_order(key: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """The entries by key and node, each once. Most keys have one node, so nodes are sorted where keys are equal only."""
    order = np.argsort(key)
    key, a, b = key[order], a[order], b[order]
    same = np.concatenate(([False], key[1:] == key[:-1], [False]))
    at = np.flatnonzero(same[1:] | same[:-1])
    inner = at[np.lexsort((b[at], a[at], key[at]))]
    a[at], b[at] = a[inner], b[inner]
    once = P.groups(key, a, b)
    return [c[once] for c in (key, a, b)]


def _cut(bucket: np.ndarray, kind: int, *columns: np.ndarray) -> list[tuple[int, int, bytes]]:
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    starts = P.groups(bucket)
    ends = np.append(starts, len(bucket))[1:]
    return [(int(bucket[i]), kind, b"".join(c[i:j].tobytes() for c in columns)) for i, j in zip(starts, ends, strict=True)]


def _columns(parcel: bytes, *kinds: type) -> list[np.ndarray]:
    n = len(parcel) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for kind in kinds:
        out.append(np.frombuffer(parcel, kind, n, at))
        at += out[-1].nbytes
    return out


def in_blocks(regions: DataFrame, small: int, *keep: str) -> DataFrame:
    """region, node and the columns to keep: regions of more than ``small`` nodes as regions of two blocks each, in which any two nodes meet.

    Of a region's n nodes a block has about ``small``, so each node goes on n / ``small`` times at most.
    ``regions`` has n and a node once a region.
    """
    blocks, own = F.ceil(F.col("n") / small).cast("int"), F.col("own")
    others = F.filter(F.sequence(F.lit(0), blocks - 1), lambda b: b != own)
    met = F.transform(others, lambda b: F.xxhash64("region", F.least(own, b), F.greatest(own, b)))
    placed = regions.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    return placed.select(F.explode(F.when(F.col("n") <= small, F.array("region")).otherwise(met)).alias("region"), "node", *keep)


def meet(docs: DataFrame, entries: Callable[[Iterator[pa.RecordBatch]], Iterator[Entries]]) -> DataFrame:
    """region, node: all nodes that have a key in common with a different node, each once a region.

    A task sends a key once, with one node; if several of its nodes have the key, they are known to share it
    and go their own ways, so a key that a third of all nodes has is one entry a task. Inside a bucket keys
    are compared by 32 bits: two keys that agree by chance make one region, which costs time, not results.
    """
    parts = P.partitions(docs)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, a, b in _held(entries(batches)):
            key, a, b = _in_order(key, a, b)
            starts = P.groups(key)
            sizes = np.diff(np.append(starts, len(key)))
            bucket, short = ((key >> U(8)) % U(parts)).astype(np.int64), (key >> _HIGH).astype(np.uint32)
            rows = _cut(bucket[starts], 0, a[starts], short[starts], b[starts])
            shared = np.repeat(sizes > 1, sizes)
            if shared.any():
                region = (bucket << 32 | short.astype(np.int64))[shared]
                rows += _cut((a[shared] % U(parts)).astype(np.int64), 1, region, a[shared], b[shared])
            yield P.parcel_rows(rows)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent, known = [], []
        for batch in batches:
            for bucket, kind, parcel in zip(*(batch[c].to_pylist() for c in ("bucket", "kind", "parcel")), strict=True):
                if kind:
                    known.append(_columns(parcel, np.int64, np.uint64, np.uint32))
                else:
                    a, short, b = _columns(parcel, np.uint64, np.uint32, np.uint32)
                    sent.append((np.int64(bucket) << 32 | short.astype(np.int64), a, b))
        if sent:
            region, a, b = _in_order(*(np.concatenate(c) for c in zip(*sent, strict=True)))
            starts = P.groups(region)
            sizes = np.diff(np.append(starts, len(region)))
            many = np.repeat(sizes > 1, sizes)
            known.append((region[many], a[many], b[many]))
        for region, a, b in known:
            if len(region):
                yield pa.RecordBatch.from_arrays([pa.array(region), node_bytes(a, b)], ["region", "node"])

    # a node comes from every task that knows it to share the key
    return docs.mapInArrow(send, P.PARCELS).repartitionById(parts, "bucket").mapInArrow(found, "region long, node binary").distinct()


def first_differences(own: np.ndarray, pivot: np.ndarray, percent: int) -> tuple[bool, np.ndarray]:
    """Whether the sets are similar enough, and the shingles under which ``own`` goes on.

    With c = (1 - t) / (1 + t), similar sets x and y differ in at most c (|x| + |y|) shingles, and in at most
    |x| (1 - t) / t. In the cell, a node meets nodes outside it, which differ from the pivot in more than
    c (|y| + |pivot|). Outside, it meets any node with a difference of its own. Either bound below is at least 1.
    """
    added, removed = np.setdiff1d(own, pivot, True), np.setdiff1d(pivot, own, True)
    n, common = len(added) + len(removed), len(own) - len(added)
    linked = 100 * common >= percent * (common + n)
    if linked:
        # floor((n + c (|pivot| - |own|)) / 2) + 1, in whole numbers
        least = ((100 + percent) * n + (100 - percent) * (len(pivot) - len(own))) // (2 * (100 + percent)) + 1
    else:
        most = len(own) * (100 - percent) // percent
        least = -(-(n + max(1, n - most) - most) // 2)
    return linked, np.concatenate((added, removed))[: n - max(1, least) + 1]


Sets = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def stretches(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    before = np.cumsum(sizes) - sizes
    return values[np.repeat(starts - before, sizes) + np.arange(sizes.sum())]


def similar(first: tuple[np.ndarray, np.ndarray], second: tuple[np.ndarray, np.ndarray], percent: int) -> np.ndarray:
    """Which of several pairs of sets are similar enough; the values of all sets one after another, and their sizes."""
    (x, n), (y, m) = first, second
    pair = np.repeat(np.arange(len(n)), n + m)
    first = np.repeat(np.arange(2 * len(n)) % 2 == 0, np.stack((n, m), 1).ravel())
    values = np.empty(len(pair), x.dtype)
    values[first], values[~first] = x, y
    values = A.sorted_each(values, n + m)
    twice = (values[1:] == values[:-1]) & (pair[1:] == pair[:-1])
    common = np.bincount(pair[1:][twice], minlength=len(n))
    return 100 * common >= percent * (n + m - common)


def _with(column: str, pairs: DataFrame, shapes: DataFrame) -> DataFrame:
    """The pairs with the column of ``shapes`` for the node and for the pivot."""
    pivots = shapes.select(F.col("node").alias("pivot"), F.col(column).alias(f"pivot_{column}"))
    return pairs.join(shapes.select("node", column), "node").join(pivots, "pivot")


def may_be_similar(first: list[bytes], second: list[bytes], percent: int) -> np.ndarray:
    """Which of several pairs of sketches let their sets be similar enough."""
    lengths = np.array([list(map(len, first)), list(map(len, second))]).T
    out = np.zeros(len(first), bool)
    for pair in np.unique(lengths, axis=0):
        rows = np.flatnonzero((lengths == pair).all(1))
        classes = int(pair.min()) // 4
        own, other = (
            np.frombuffer(b"".join([sketches[i] for i in rows]), np.uint32).reshape(len(rows), -1, classes).sum(1, dtype=np.int64)
            for sketches in (first, second)
        )
        out[rows] = np.abs(own - other).sum(1) * (100 + percent) <= (100 - percent) * (own.sum(1) + other.sum(1))
    return out


def _near(pairs: DataFrame, shapes: DataFrame, percent: int) -> DataFrame:
    """node, pivot of the pairs that their sketches let be similar. Only sketches are sent here, and texts of these pairs afterwards."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(A.chunks(iter([batch]), "sketch"), "pivot_sketch"):
                kept = may_be_similar(part["sketch"].to_pylist(), part["pivot_sketch"].to_pylist(), percent)
                yield part.select(["node", "pivot"]).filter(pa.array(kept))

    return _with("sketch", pairs.select("node", "pivot"), shapes).mapInArrow(near, "node binary, pivot binary")


def _measure(pairs: DataFrame, shapes: DataFrame, sets: Sets, percent: int) -> DataFrame:
    """node, pivot of the pairs that are similar enough."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(A.chunks(iter([batch]), "shape", 1 << 19), "pivot_shape", 1 << 19):
                linked = similar(sets(part["shape"].to_pylist()), sets(part["pivot_shape"].to_pylist()), percent)
                yield part.select(["node", "pivot"]).filter(pa.array(linked))

    return _with("shape", pairs, shapes).mapInArrow(measure, "node binary, pivot binary")


def _onward(pairs: DataFrame, shapes: DataFrame, sets: Sets, percent: int) -> DataFrame:
    """node, pivot, firsts: the shingles under which each node goes on."""

    def onward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.chunks(A.chunks(iter([batch]), "shape", 1 << 19), "pivot_shape", 1 << 19):
                own, n = sets(part["shape"].to_pylist())
                other, m = sets(part["pivot_shape"].to_pylist())
                own, other = np.split(own, np.cumsum(n)[:-1]), np.split(other, np.cumsum(m)[:-1])
                firsts = [first_differences(x, y, percent)[1].astype(np.int64) for x, y in zip(own, other, strict=True)]
                yield pa.RecordBatch.from_arrays([part["node"], part["pivot"], pa.array(firsts, pa.list_(pa.int64()))], ["node", "pivot", "firsts"])

    return _with("shape", pairs, shapes).mapInArrow(onward, "node binary, pivot binary, firsts array<long>")


def sketch(values: np.ndarray) -> bytes:
    """How many of a set's shingles fall into each of some classes, about four to a class.

    What two sets' counts differ in, summed over the classes, is never more than what the sets differ in.
    """
    classes = max(8, 1 << max(0, (len(values) // 4).bit_length() - 1))
    return np.bincount((values & U(classes - 1)).astype(np.int64), minlength=classes).astype(np.uint32).tobytes()


def _may_link(counts: np.ndarray, sizes: np.ndarray, component: np.ndarray, percent: int, i: int) -> np.ndarray:
    """Rows before row i of another component that the sketches let be similar to it. Rows of a region have one number of classes."""
    rows = np.flatnonzero(component[:i] != component[i])
    # sketches differ by what the sizes do, at least
    rows = rows[np.abs(sizes[rows] - sizes[i]) * (100 + percent) <= (100 - percent) * (sizes[rows] + sizes[i])]
    apart = np.abs(counts[rows] - counts[i]).sum(axis=1, dtype=np.int64)
    return rows[apart * (100 + percent) <= (100 - percent) * (sizes[rows] + sizes[i])]


def _sketched(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The counts of a region's nodes in one number of classes, their sums, and their components as numbers."""
    sketches = [np.frombuffer(s, np.int32) for s in table["sketch"].to_pylist()]
    classes = min(map(len, sketches))
    number: dict[bytes, int] = {}
    component = np.array([number.setdefault(c, len(number)) for c in table["component"].to_pylist()])
    counts = np.stack([s.reshape(-1, classes).sum(0, dtype=np.int32) for s in sketches])
    return counts, counts.sum(1, dtype=np.int64), component


def _candidates(regions: DataFrame, shapes: DataFrame, percent: int) -> DataFrame:
    """region, node, component of the nodes that their sketches let be similar to one of another component.

    Only sketches are sent here; most regions end with this, and the texts of the others are sent afterwards.
    """

    def candidates(table: pa.Table) -> pa.Table:
        counts, sizes, component = _sketched(table)
        kept = np.zeros(len(counts), bool)
        for i in range(1, len(counts)):
            near = _may_link(counts, sizes, component, percent, i)
            kept[near] = True
            kept[i] |= bool(len(near))
        return table.select(["region", "node", "component"]).filter(pa.array(kept))

    rows = regions.join(shapes.select("node", "sketch"), "node").select("region", "node", "component", "sketch")
    return rows.groupBy("region").applyInArrow(candidates, "region long, node binary, component binary")


def _small_links(regions: DataFrame, shapes: DataFrame, sets: Sets, percent: int) -> DataFrame:
    """node, pivot of links that connect what all pairs of a small region would connect, at most one less than nodes.

    Pairs in different components that their sketches let be similar are compared here, by union-find.
    """

    def links(table: pa.Table) -> pa.Table:
        nodes = table["node"].to_pylist()
        counts, total, component = _sketched(table)
        values, sizes = sets(table["shape"].to_pylist())
        number, values = np.unique(values, return_inverse=True)
        starts, own, found = np.cumsum(sizes) - sizes, np.zeros(len(number), bool), []
        for i in range(1, len(nodes)):
            near = _may_link(counts, total, component, percent, i)
            mine = values[starts[i] : starts[i] + sizes[i]]
            own[mine] = True
            while len(near):
                # so many at a time that their sets have VALUES shingles, or one
                to = max(1, int(np.searchsorted(np.cumsum(sizes[near]), VALUES, "right")))
                some, near = near[:to], near[to:]
                shared = own[stretches(values, starts[some], sizes[some])]
                common = np.bincount(np.repeat(np.arange(len(some)), sizes[some])[shared], minlength=len(some))
                for j in some[100 * common >= percent * (sizes[some] + sizes[i] - common)].tolist():
                    if component[j] != component[i]:
                        found.append((max(nodes[i], nodes[j]), min(nodes[i], nodes[j])))
                        component[component == component[j]] = component[i]
                near = near[component[near] != component[i]]  # others are linked with this node through another one by now
            own[mine] = False
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["node", "pivot"])

    rows = regions.join(shapes, "node").select("region", "node", "component", "shape", "sketch")
    return rows.groupBy("region").applyInArrow(links, "node binary, pivot binary").distinct()


def _open(regions: DataFrame, components: DataFrame, stage: Stage, name: str) -> DataFrame:
    """region, n, node, component, degree of the regions that may still join components; regions of the same nodes once.

    ``regions`` has a node once a region: n and the marks are those of the set of nodes.
    """
    rows = regions.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    marks = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"mark{i}") for i in range(2)]
    several = rows.groupBy("region").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"), *marks)
    kept = several.where("low <> high").groupBy("n", "mark0", "mark1").agg(F.min("region").alias("region")).select("region", "n")
    kept = stage.put(kept, f"{name}-kept", free=False)  # from a table, so that the join can be split for a large region
    degrees = regions.groupBy("node").agg(F.count("*").alias("degree"))
    return rows.join(kept, "region").join(degrees, "node").select("region", "n", "node", "component", "degree")


def _united(regions: DataFrame, tops: DataFrame, stage: Stage, name: str) -> DataFrame:
    """region, pivot, n, node, component: regions of one pivot as one, if that has no more pairs than they have together."""
    rows = regions.join(tops, "region")
    held = rows.groupBy("pivot", "node").agg(F.sum("n").alias("pairs"))  # a region of n nodes has n rows of n
    sizes = held.groupBy("pivot").agg(F.count("*").alias("together"), F.sum("pairs").alias("pairs"))
    sizes = sizes.where(F.col("together") * F.col("together") <= F.col("pairs")).select("pivot", "together")
    sizes = stage.put(sizes, f"{name}-sizes", free=False)  # from a table, so that the join can be split for a large crowd
    rows = rows.join(sizes, "pivot", "left")
    region = F.when(F.col("together").isNull(), F.col("region")).otherwise(F.xxhash64("pivot", F.lit("together")))
    rows = rows.select(region.alias("region"), "pivot", F.coalesce("together", "n").alias("n"), "node", "component")
    return rows.dropDuplicates(["region", "node"])


def join_regions(regions: DataFrame, shapes: DataFrame, sets: Sets, percent: int, stage: Stage, small: int = SMALL) -> DataFrame:
    """node, component: nodes connected by links of at least ``percent`` similarity inside some region.

    ``shapes`` has a node's text and sketch, once, and ``sets`` makes texts arrays of distinct numbers, each sorted,
    one after another, with their sizes. Nodes without a link may be left out.
    """
    components = regions.limit(0).select("node", F.col("node").alias("component"))
    step = 0

    def link(links: DataFrame, name: str) -> None:
        nonlocal components
        new = stage.put(links, f"links-{name}")
        if not new.isEmpty():
            components = connected(new.union(components), stage, f"stars-{name}")

    rows = regions
    while True:
        rows = stage.put(_open(rows, components, stage, f"open-{step}"), f"open-{step}", free=not step)
        if rows.isEmpty():
            return components
        top = rows.groupBy("region").agg(F.max(F.struct("degree", "node")).alias("top")).select("region", F.col("top.node").alias("pivot"))
        top = stage.put(top, f"pivots-{step}", free=False)
        met = rows.join(top, "region").where(F.col("node") != F.col("pivot"))
        met = stage.put(met.select("node", "pivot").distinct(), f"met-{step}", free=False)
        near = stage.put(_near(met, shapes, percent), f"measured-{step}", free=False)
        link(_measure(near, shapes, sets, percent), f"cells-{step}")
        # of two nodes all is known; what else a pivot leaves open in a region of a few blocks is found by pairs
        left = _open(rows.where("n > 2").select("region", "node"), components, stage, f"left-{step}")
        left = stage.put(_united(left, top, stage, f"left-{step}"), f"left-{step}", free=False)
        few = in_blocks(left.where(F.col("n") <= BLOCKS * small), small, "component")
        few = stage.put(_candidates(few, shapes, percent), f"near-{step}", free=False)
        if not few.isEmpty():
            link(_small_links(few, shapes, sets, percent), f"few-{step}")
        large = left.where((F.col("n") > BLOCKS * small) & (F.col("node") != F.col("pivot"))).select("node", "pivot").distinct()
        if large.isEmpty():
            return components
        firsts = _onward(large, shapes, sets, percent).select("node", "pivot", F.explode("firsts").alias("first"))
        rows = stage.put(firsts.select(F.xxhash64("pivot", "first").alias("region"), "node").distinct(), f"regions-{step}", free=False)
        step += 1
