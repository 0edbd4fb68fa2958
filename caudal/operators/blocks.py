"""All pairs of the items of a list, made in blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block_pairs(lists: DataFrame, key: str, block: int = 64) -> DataFrame:
    """Pairs of blocks of a list: (key, left, right), right null where a block meets itself.

    ``lists`` has a row per key and an array ``items``. A list of one block is a row as it stands.
    The blocks of longer lists are first dealt out by themselves; then each goes to the cells it
    takes part in, where it meets the other block. So no task makes all pairs of a long list, and
    a row is bounded work.
    """
    cut = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("items") - 1) / block).cast("int")),
        lambda i: F.slice(F.col("items"), i * block + 1, F.lit(block)),
    )
    full = lists.where(F.size("items") > 0)
    short = full.where(F.size("items") <= block).select(key, F.col("items").alias("left"))
    long = full.where(F.size("items") > block).select(key, cut.alias("blocks"))
    dealt = long.select(key, F.size("blocks").alias("n"), F.posexplode("blocks").alias("i", "items")).repartition(key, "i")
    lefts = dealt.where("i < n - 1").select(
        key, F.col("i").alias("low"), F.explode(F.sequence(F.col("i") + 1, F.col("n") - 1)).alias("high"), F.col("items").alias("left")
    )
    rights = dealt.where("i > 0").select(
        key, F.explode(F.sequence(F.lit(0), F.col("i") - 1)).alias("low"), F.col("i").alias("high"), F.col("items").alias("right")
    )
    apart = lefts.join(rights, [key, "low", "high"]).select(key, "left", "right")
    alone = short.unionByName(dealt.select(key, F.col("items").alias("left")))
    return apart.unionByName(alone.withColumn("right", F.lit(None).cast(lists.schema["items"].dataType)))


def item_pairs(blocks: DataFrame) -> DataFrame:
    """The pairs of items (a, b) of each pair of blocks, beside its other columns; a stands before b."""
    keep = [c for c in blocks.columns if c not in ("left", "right")]
    firsts = blocks.select(*keep, "left", "right", F.posexplode("left").alias("at", "a"))
    others = F.coalesce("right", F.slice("left", F.col("at") + 2, F.size("left")))
    return firsts.select(*keep, "a", F.explode(others).alias("b"))
