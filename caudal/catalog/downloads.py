"""Download-log jobs. A line item is a download, its part the article, part numbers by twenties a publisher."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.catalog import Catalog, table
from caudal.operators import downloads as D

catalog = Catalog()


def _doi(part: str) -> Column:
    prefix = F.floor(F.col(part) / 20).cast("string")
    return F.concat(F.lit("10."), prefix, F.lit("/part/"), F.col(part).cast("string"))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log in its six text columns; every fifth nation's place is unknown, another fifth's off the globe."""
    lat = F.round(F.col("s_acctbal") / 200, 1).cast("string")
    lon = (F.col("n_nationkey") * 9).cast("string")
    coords = (
        F.when(F.col("n_regionkey") == 0, F.lit("N/A"))
        .when(F.col("n_regionkey") == 1, F.concat(F.lit("95.5,"), lon))
        .otherwise(F.concat(lat, F.lit(", "), lon))
    )
    places = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("s_name").alias("city"), F.col("n_name").alias("country"), coords.alias("coords"))
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(places, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("date"),
            _doi("l_partkey").alias("doi"),
            F.col("l_suppkey").cast("string").alias("ip_code"),
            "country",
            "city",
            "coords",
        )
    )


def _prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in credit publish under their number, the others under one that no article has."""
    registrant = F.when(F.col("s_acctbal") > 0, "10.").otherwise("11.")
    return table(spark, sf_dir, "supplier").select(
        F.concat(registrant, F.col("s_suppkey").cast("string")).alias("prefix"), F.col("s_name").alias("publisher")
    )


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with a title, year, publisher, book and subject; small parts' entries stand under another name."""
    return (
        table(spark, sf_dir, "part")
        .select(
            F.when(F.col("p_size") > 5, _doi("p_partkey")).otherwise(F.concat(F.lit("old/"), _doi("p_partkey"))).alias("doi"),
            F.col("p_name").alias("title"),
            (F.col("p_size") + 1960).alias("year"),
            F.col("p_brand").alias("publisher"),
            F.col("p_type").alias("book"),
            F.lower("p_type").alias("subject"),
        )
    )


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.downloads_by_day(_log(spark, sf_dir))


def _by_doi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.downloads_by_doi(_log(spark, sf_dir))


_LOG_SQL = """
    log AS (
      SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, l_shipdate, l_partkey, n_name AS country, n_nationkey, n_regionkey,
             s_acctbal, '10.' || (l_partkey // 20) AS prefix, '10.' || (l_partkey // 20) || '/part/' || l_partkey AS doi
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
    prefixes AS (SELECT CASE WHEN s_acctbal > 0 THEN '10.' ELSE '11.' END || s_suppkey AS prefix, s_name AS publisher FROM supplier)"""

catalog.add(
    "downloads_by_day",
    lambda spark, sf: _daily(spark, sf).withColumn("day", F.col("day").cast("string")),
    f"WITH {_LOG_SQL} SELECT day, count(*) AS downloads FROM log GROUP BY day",
)
catalog.add(
    "downloads_by_month",
    lambda spark, sf: D.downloads_by_month(_daily(spark, sf)),
    f"WITH {_LOG_SQL} SELECT left(day, 7) AS month, count(*) AS downloads FROM log GROUP BY 1",
)
catalog.add(
    "downloads_by_weekday",
    lambda spark, sf: D.downloads_by_weekday(_daily(spark, sf)),
    f"WITH {_LOG_SQL} SELECT isodow(l_shipdate)::INTEGER AS weekday, count(*) AS downloads FROM log GROUP BY 1",
)
catalog.add(
    "downloads_by_doi",
    _by_doi,
    f"WITH {_LOG_SQL} SELECT doi, count(*) AS downloads FROM log GROUP BY doi",
)
catalog.add(
    "downloads_by_prefix",
    lambda spark, sf: D.downloads_by_prefix(_by_doi(spark, sf), _prefixes(spark, sf)),
    f"""WITH {_LOG_SQL}
    SELECT log.prefix, publisher, count(*) AS downloads FROM log LEFT JOIN prefixes USING (prefix) GROUP BY ALL""",
)
catalog.add(
    "downloads_by_publisher",
    lambda spark, sf: D.downloads_by_publisher(_by_doi(spark, sf), _prefixes(spark, sf)),
    f"""WITH {_LOG_SQL}
    SELECT publisher, count(*) AS downloads FROM log LEFT JOIN prefixes USING (prefix) GROUP BY ALL""",
)
catalog.add(
    "downloads_by_country",
    lambda spark, sf: D.downloads_by_country(_log(spark, sf)),
    f"WITH {_LOG_SQL} SELECT country, count(*) AS downloads FROM log GROUP BY country",
)
catalog.add(
    "article_meta",
    lambda spark, sf: D.top_articles(_by_doi(spark, sf), _metadata(spark, sf)),
    f"""WITH {_LOG_SQL},
    top AS (SELECT doi, l_partkey, count(*) AS downloads FROM log GROUP BY ALL ORDER BY downloads DESC, doi LIMIT 10)
    SELECT doi, downloads, p_name AS title, p_size + 1960 AS year, p_brand AS publisher, p_type AS book,
           lower(p_type) AS subject
    FROM top LEFT JOIN (SELECT * FROM part WHERE p_size > 5) ON l_partkey = p_partkey ORDER BY downloads DESC, doi""",
)
catalog.add(
    "geo_downloads",
    lambda spark, sf: D.downloads_by_place(_log(spark, sf), decimals=1),
    f"""WITH {_LOG_SQL}
    SELECT round(round(s_acctbal / 200, 1), 1) AS lat, (n_nationkey * 9)::DOUBLE AS lon, count(*) AS downloads
    FROM log WHERE n_regionkey NOT IN (0, 1) AND abs(round(s_acctbal / 200, 1)) <= 90 AND n_nationkey * 9 <= 180
    GROUP BY 1, 2""",
)
