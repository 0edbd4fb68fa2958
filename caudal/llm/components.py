"""Connected components of a graph given by its edges, as joins and minima."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.stage import Stage

#: Nodes that a task's union-find holds before it gives its trees away, and links that one task finishes.
HELD, FINISHED = 1 << 20, 1 << 20


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over links: each node but the smallest of its tree with that one."""
    parents: dict = {}

    def root(x):
        top = x
        while (up := parents.get(top, top)) != top:
            top = up
        while (up := parents.get(x, x)) != top:
            parents[x], x = top, up
        return top

    def stars() -> pa.RecordBatch:
        nodes = list(parents)
        return pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([root(x) for x in nodes], kind)], ["u", "v"])

    kind = None
    for batch in batches:
        kind = batch.column(0).type
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                parents[max(a, b)] = min(a, b)
        if len(parents) >= HELD:
            yield stars()
            parents.clear()
    if parents:
        yield stars()


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected(edges: DataFrame, stage: Stage, name: str, finished: int = FINISHED) -> DataFrame:
    """node, component for every node of ``edges`` (its first two columns); the component is its smallest node.

    Each task runs union-find over the links it has and sends trees only. At most ``finished`` links that are left
    are united in one task, a bound that doesn't grow. More go through large and small stars: each node points its
    larger neighbours, then its smaller ones, at the least of all of them, until every component is a star around
    its smallest node. A node's neighbours are never gathered; they are met by a join. What each node points to is
    written first, so that both sides of the join come from tables and Spark can split it for a node with very many
    neighbours.
    """
    a, b = edges.columns[:2]
    kind = edges.schema[a].dataType.simpleString()
    united = edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v")).mapInArrow(contract, f"u {kind}, v {kind}")
    united = stage.put(united, f"{name}-united", free=False)
    if united.count() <= finished:
        whole = stage.put(united.coalesce(1).mapInArrow(contract, united.schema), f"{name}-whole", free=False)
        stage.drop(f"{name}-united")
        return _members(whole)
    pairs = united.distinct()
    before, step = None, 0
    while True:
        pairs = stage.put(pairs, f"{name}-{step}", free=False)
        if step:
            stage.drop(*(f"{name}-{n}" for n in (step - 1, f"{step}-large", f"{step}-turned", f"{step}-small")))
        now = _state(pairs)
        if now == before or not now[0]:
            break
        before, step = now, step + 1
        both = pairs.union(pairs.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = stage.put(least, f"{name}-{step}-large", free=False)
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage.put(large, f"{name}-{step}-turned", free=False)
        least = stage.put(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-{step}-small", free=False)
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = small.union(least).distinct()
    return _members(pairs)


def _members(stars: DataFrame) -> DataFrame:
    members = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
