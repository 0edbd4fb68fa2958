"""Mixing sources to target weights by Pfair scheduling: DataFrame functions only.

Each source is cut into blocks of documents. Time goes in periods; in a period a source has as many blocks
as its share says, and the j-th of b blocks among A in all is released at floor((j-1) A / b) and due at
ceil(j A / b). The earliest deadline goes first among the released ones. The blocks of a period fill its
slots exactly, so every deadline is met and no source is ever a whole block away from its part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.stage import Stage

_JOB = "struct<deadline:bigint,source:string,k:bigint,release:bigint>"

_JOBS = """flatten(transform(parts, p -> transform(sequence(1L, p.b), k -> named_struct(
  'deadline', (k * slots + p.b - 1) div p.b, 'source', p.source, 'k', k, 'release', ((k - 1) * slots) div p.b))))"""

_SCHEDULE = f"""aggregate(sequence(0L, slots - 1),
  named_struct('waiting', cast(jobs AS array<{_JOB}>), 'done', cast(array() AS array<{_JOB}>)),
  (s, t) -> transform(array(array_min(filter(s.waiting, j -> j.release <= t))), next -> named_struct(
    'waiting', cast(filter(s.waiting, j -> j <> next) AS array<{_JOB}>),
    'done', cast(concat(s.done, array(next)) AS array<{_JOB}>)))[0],
  s -> s.done)"""


def ranked(docs: DataFrame, id_col: str, source_col: str) -> DataFrame:
    """id, source and the document's rank in its source, from 0, in the order of a digest of the id.

    A source is ranked in 4,096 parts, so a source of any size is nobody's single task.
    """
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(source_col), F.lit("")).alias("source"), digest.alias("digest"))
    rows = rows.withColumn("part", F.substring("digest", 1, 3))
    counts = rows.groupBy("source", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("source", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("source", "part").orderBy("digest"))
    return (
        rows.withColumn("nth", within)
        .join(starts, ["source", "part"])
        .select("id", "source", (F.col("first") + F.col("nth") - 1).alias("rank"))
    )


def target_shares(docs: DataFrame, stage: Stage, source_col: str, power: float, resolution: int, block: int) -> DataFrame:
    """Per source: blocks in all, and blocks per period, in proportion to a power of its size and one at least."""
    sizes = stage.put(
        docs.groupBy(F.coalesce(F.col(source_col), F.lit("")).alias("source")).agg(F.count("*").alias("n")), "sizes"
    )
    total = sizes.agg(F.sum(F.pow("n", F.lit(power)))).first()[0]
    share = F.greatest(F.lit(1), F.round(resolution * F.pow("n", F.lit(power)) / F.lit(total or 1.0))).cast("long")
    return sizes.select("source", F.ceil(F.col("n") / block).cast("long").alias("blocks"), share.alias("share"))


def mix(
    docs: DataFrame,
    power: float = 0.5,
    resolution: int = 100,
    block: int = 16,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: id, source, block, slot, place. ``place`` orders the mix.

    Weights are the sources' sizes to ``power``, rounded to whole blocks in a period of about ``resolution``
    blocks. Every document comes once: a source that has run out leaves its slots to the others, in
    proportion to their shares. Slots count full periods, so numbers are left out once sources have run out.
    A null source counts as an empty name, a null id as an empty one; repeated rows follow one another. Other
    columns are not carried. An empty table gives no rows.
    """
    stage = Stage(docs.sparkSession)
    shares = stage.put(target_shares(docs, stage, source_col, power, resolution, block), "shares")
    length = shares.agg(F.sum("share")).first()[0] or 1
    parts = shares.select(
        "source", "blocks", "share", F.explode(F.expr("sequence(0L, (blocks + share - 1) div share - 1)")).alias("period")
    ).select("period", F.struct("source", F.expr("least(share, blocks - period * share)").alias("b")).alias("part"))
    periods = parts.groupBy("period").agg(F.sort_array(F.collect_list("part")).alias("parts"), F.sum("part.b").alias("slots"))
    order = (
        periods.withColumn("jobs", F.expr(_JOBS))
        .select("period", F.posexplode(F.expr(_SCHEDULE)).alias("slot", "job"))
        .select("period", "job.source", F.col("job.k").alias("k"), (F.col("period") * length + F.col("slot")).alias("slot"))
    )
    blocks = (
        ranked(docs, id_col, source_col)
        .join(shares.select("source", "share"), "source")
        .withColumn("block", F.expr(f"rank div {block}"))
        .withColumn("period", F.expr("block div share"))
        .withColumn("k", F.expr("block % share + 1"))
    )
    return blocks.join(order, ["period", "source", "k"]).select(
        F.col("id").alias(id_col), "source", "block", "slot", (F.col("slot") * block + F.expr(f"rank % {block}")).alias("place")
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The documents with all their columns, sorted into the mix; rows of one id stay together."""
    places = mix(docs, id_col=id_col, **how).groupBy(F.col(id_col).alias("_caudal_id")).agg(F.min("place").alias("_caudal_place"))
    joined = docs.join(places, docs[id_col].eqNullSafe(places["_caudal_id"]))
    return joined.repartitionByRange("_caudal_place").sortWithinPartitions("_caudal_place").select(*docs.columns)
