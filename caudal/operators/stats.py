"""Rankings and descriptive statistics of projects per person, party, district or commission."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def project_counts(
    members: DataFrame,
    results: DataFrame,
    column: str = "congressman",
    sanctioned: str = "SANCIONADO",
    half: str = "MEDIA SANCION",
) -> DataFrame:
    """(column, presented, sanctioned, half_sanctioned): distinct projects of each value.

    Results are reduced to one row per project before they are joined.
    """
    outcome = results.groupBy("id").agg(
        F.max((F.col("result") == sanctioned).cast("int")).alias("sanctioned"),
        F.max((F.col("result") == half).cast("int")).alias("half"),
    )
    return (
        members.select("id", column)
        .distinct()
        .join(outcome, "id", "left")
        .groupBy(column)
        .agg(
            F.count("id").alias("presented"),
            F.coalesce(F.sum("sanctioned"), F.lit(0)).alias("sanctioned"),
            F.coalesce(F.sum("half"), F.lit(0)).alias("half_sanctioned"),
        )
    )


def project_ranking(counts: DataFrame, column: str = "congressman", k: int = 10) -> DataFrame:
    """The first ``k`` by projects presented, sanctioned and half-sanctioned: (ranking, column, projects).

    Ties are in order of the value; values without a project of the kind are not ranked.
    """

    def first(ranking: str) -> DataFrame:
        return (
            counts.where(F.col(ranking) > 0)
            .orderBy(F.desc(ranking), column)
            .limit(k)
            .select(F.lit(ranking).alias("ranking"), column, F.col(ranking).alias("projects"))
        )

    return first("presented").unionByName(first("sanctioned")).unionByName(first("half_sanctioned"))


def project_stats(counts: DataFrame, measure: str = "presented") -> DataFrame:
    """Number of values, and mean, deviation, least, median and most projects of one, in one row.

    Values are counted per number of projects first, so that the median sees the distinct
    numbers only.
    """
    n = F.col("n")
    numbers = counts.groupBy(F.col(measure).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    total, squares = F.sum(F.col("x") * n), F.sum(F.col("x") * F.col("x") * n)
    return numbers.agg(
        F.sum(n).alias("count"),
        (total / F.sum(n)).alias("mean"),
        F.sqrt(
            F.try_divide(F.greatest(squares - total * total / F.sum(n), F.lit(0.0)), F.sum(n) - 1)
        ).alias("deviation"),
        F.min("x").alias("least"),
        F.percentile("x", F.lit(0.5), n).alias("median"),
        F.max("x").alias("most"),
    )
