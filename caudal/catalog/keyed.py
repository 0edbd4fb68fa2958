"""Key/value jobs on ``lineitem``, ``orders`` and ``customer``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.catalog import Catalog, table
from caudal.operators import keyed as K
from caudal.sources.readers import parse_triples

catalog = Catalog()


def _collections(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Quantities per supplier in three collections, one per return flag."""
    items = table(spark, sf_dir, "lineitem")
    return [
        items.where(F.col("l_returnflag") == flag).select(
            F.col("l_suppkey").alias("key"), F.col("l_quantity").cast("long").alias("value")
        )
        for flag in ("A", "N", "R")
    ]


catalog.add(
    "sum_by_key",
    lambda spark, sf: K.sum_by_key(*_collections(spark, sf)),
    """SELECT l_suppkey AS key, sum(l_quantity::BIGINT)::BIGINT AS total FROM lineitem
       WHERE l_returnflag IN ('A', 'N', 'R') GROUP BY 1""",
)

catalog.add(
    "cogroup_sum",
    lambda spark, sf: K.cogroup_sum(*_collections(spark, sf)),
    """SELECT l_suppkey AS key,
              coalesce(sum(l_quantity::BIGINT) FILTER (l_returnflag = 'A'), 0)::BIGINT AS total_0,
              coalesce(sum(l_quantity::BIGINT) FILTER (l_returnflag = 'N'), 0)::BIGINT AS total_1,
              coalesce(sum(l_quantity::BIGINT) FILTER (l_returnflag = 'R'), 0)::BIGINT AS total_2,
              sum(l_quantity::BIGINT)::BIGINT AS total
       FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R') GROUP BY 1""",
)


def _property_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two statements per order about its customer; partly filled orders give a junk line beside them."""
    subject = F.concat(F.lit("<c"), F.col("o_custkey").cast("string"), F.lit("> "))
    lines = F.array(
        F.concat(subject, F.lit('<status> "'), "o_orderstatus", F.lit('" .')),
        F.concat(subject, F.lit('<priority>  "'), "o_orderpriority", F.lit('"@en  . ')),
        F.when(F.col("o_orderstatus") == "P", F.lit("# partial")).otherwise(""),
    )
    return table(spark, sf_dir, "orders").select(F.explode(lines).alias("value"))


def _type_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's segment as a type, said twice when the balance is positive; machinery's are said of others."""
    line = F.concat(
        F.when(F.col("c_mktsegment") == "MACHINERY", "<m").otherwise("<c"), F.col("c_custkey").cast("string"), F.lit("> <type> <"), F.col("c_mktsegment"), F.lit("> .")
    )
    times = F.when(F.col("c_acctbal") > 0, 2).otherwise(1)
    return table(spark, sf_dir, "customer").select(F.explode(F.array_repeat(line, times)).alias("value"))


catalog.add(
    "triple_enrich",
    lambda spark, sf: K.enrich_triples(
        parse_triples(_property_lines(spark, sf)), parse_triples(_type_lines(spark, sf))
    ).withColumn("types", F.array_join("types", " ")),
    """WITH properties AS (
      SELECT o_custkey, '<status>' AS relation, '"' || o_orderstatus || '"' AS object FROM orders
      UNION ALL
      SELECT o_custkey, '<priority>', '"' || o_orderpriority || '"@en' FROM orders),
    types AS (
      SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN '<' || c_mktsegment || '> <' || c_mktsegment || '>'
                             ELSE '<' || c_mktsegment || '>' END AS types
      FROM customer WHERE c_mktsegment <> 'MACHINERY')
    SELECT '<c' || o_custkey || '>' AS subject, coalesce(types, '') AS types, relation, object
    FROM properties LEFT JOIN types ON o_custkey = c_custkey""",
)


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part and supplier numbers that meet in a line item are friends."""
    pairs = table(spark, sf_dir, "lineitem").where(F.col("l_partkey") != F.col("l_suppkey"))
    return pairs.select(
        F.least("l_partkey", "l_suppkey").alias("a"), F.greatest("l_partkey", "l_suppkey").alias("b")
    ).distinct()


catalog.add(
    "common_friends",
    lambda spark, sf: K.shared_lists(_edges(spark, sf)).select(
        "a", "b", F.concat_ws(",", F.transform("friends", lambda f: f.cast("string"))).alias("friends")
    ),
    """WITH edges AS (
      SELECT DISTINCT least(l_partkey, l_suppkey) AS a, greatest(l_partkey, l_suppkey) AS b
      FROM lineitem WHERE l_partkey <> l_suppkey),
    friends AS (SELECT a AS person, b AS friend FROM edges UNION ALL SELECT b, a FROM edges),
    shared AS (
      SELECT e.a, e.b, x.friend FROM edges e JOIN friends x ON x.person = e.a
      JOIN friends y ON y.person = e.b AND y.friend = x.friend)
    SELECT e.a, e.b, coalesce(string_agg(s.friend::VARCHAR, ',' ORDER BY s.friend), '') AS friends
    FROM edges e LEFT JOIN shared s ON s.a = e.a AND s.b = e.b GROUP BY e.a, e.b""",
)
