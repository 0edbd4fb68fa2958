"""Key/value jobs: sums by key over several collections, types joined to triples, friends in common."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.operators.blocks import block_pairs, item_pairs


def sum_by_key(*collections: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Total of each key over the union of the collections."""
    whole = reduce(DataFrame.unionByName, [c.select(key, value) for c in collections])
    return whole.groupBy(key).agg(F.sum(value).alias("total"))


def cogroup_sum(*collections: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """Total of each key, with its share from each collection as ``total_0``, ``total_1``, ...

    All collections meet in one shuffle of sums; a collection without the key gives 0.
    """
    tagged = [c.select(key, value, F.lit(i).alias("part")) for i, c in enumerate(collections)]
    whole = reduce(DataFrame.unionByName, tagged)
    return whole.groupBy(key).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("part") == i, F.col(value))), F.lit(0)).alias(f"total_{i}")
            for i in range(len(collections))
        ],
        F.sum(value).alias("total"),
    )


def enrich_triples(properties: DataFrame, types: DataFrame, *, repeat: bool = True) -> DataFrame:
    """Each property with the list of its subject's types: (subject, types, relation, object).

    ``types`` are triples whose object is the type; a type that is stated twice stands in
    the list twice, and the list is sorted. Types are counted before they are gathered, so
    a subject's group holds its distinct types only, and they meet the properties as pairs
    of type and number. Without ``repeat`` they stay so: ``types`` is then a list of
    (type, n). A subject without a type has an empty list.
    """
    counted = types.groupBy("subject", F.col("object").alias("type")).agg(F.count(F.lit(1)).alias("n"))
    listed = counted.groupBy("subject").agg(F.array_sort(F.collect_list(F.struct("type", "n"))).alias("types"))
    none = F.array().cast("array<struct<type:string,n:bigint>>")
    joined = properties.join(listed, "subject", "left").withColumn("types", F.coalesce("types", none))
    if repeat:
        stated = F.flatten(F.transform("types", lambda t: F.array_repeat(t["type"], t["n"].cast("int"))))
        joined = joined.withColumn("types", stated)
    return joined.select("subject", "types", "relation", "object")


def friendships(adjacency: DataFrame) -> DataFrame:
    """Undirected edges (a, b) with a < b from symmetric adjacency lists (person, friends)."""
    said = adjacency.select("person", F.explode("friends").alias("friend")).where(F.col("person") != F.col("friend"))
    return said.select(
        F.least("person", "friend").alias("a"), F.greatest("person", "friend").alias("b")
    ).distinct()


def friends_in_common(edges: DataFrame) -> DataFrame:
    """For each pair of friends (a, b), one row per friend they share; null where they share none.

    ``edges`` are distinct pairs with a < b. A shared friend closes a triangle, so the
    triangles are found once and each is told to its three pairs. To find them, every
    edge points from its end with fewer friends to the end with more; then nobody points
    to more than sqrt(2 * edges) others, and a person with very many friends is looked up
    by them rather than sending the whole list to each. The list a person points to is cut
    into blocks, and the pairs of two blocks are made where the two meet.
    """
    ends = edges.select(F.explode(F.array("a", "b")).alias("person"))
    degrees = ends.groupBy("person").agg(F.count(F.lit(1)).alias("degree"))

    def degree_of(end: str) -> DataFrame:
        return degrees.select(F.col("person").alias(end), F.col("degree").alias(f"{end}_degree"))

    def rank(degree: str, person: str) -> Column:
        return F.struct(F.col(degree).alias("degree"), F.col(person).alias("person"))

    ranked = (
        edges.join(degree_of("a"), "a")
        .join(degree_of("b"), "b")
        .select(rank("a_degree", "a").alias("x"), rank("b_degree", "b").alias("y"))
    )
    pointed = ranked.select(F.least("x", "y").alias("low"), F.greatest("x", "y").alias("high"))
    lists = pointed.groupBy(F.col("low.person").alias("u")).agg(F.array_sort(F.collect_list("high")).alias("items"))
    corner = item_pairs(block_pairs(lists, "u")).select("u", F.col("a.person").alias("v"), F.col("b.person").alias("w"))
    closing = pointed.select(F.col("low.person").alias("v"), F.col("high.person").alias("w"))
    triangles = corner.join(closing, ["v", "w"])

    def told(first: str, second: str, shared: str) -> Column:
        return F.struct(
            F.least(first, second).alias("a"), F.greatest(first, second).alias("b"), F.col(shared).alias("friend")
        )

    shared = triangles.select(
        F.inline(F.array(told("u", "v", "w"), told("u", "w", "v"), told("v", "w", "u")))
    )
    return edges.join(shared, ["a", "b"], "left")


def shared_lists(edges: DataFrame) -> DataFrame:
    """For each pair of friends (a, b) the sorted list of the friends both have."""
    return friends_in_common(edges).groupBy("a", "b").agg(F.array_sort(F.collect_list("friend")).alias("friends"))


def common_friends(adjacency: DataFrame) -> DataFrame:
    """The same from symmetric adjacency lists (person, friends).

    A list is never longer than the shorter of the pair's two lists in the input.
    """
    return shared_lists(friendships(adjacency))
