"""Download-log analytics: frequencies by time, publisher, article, country and place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def downloads_by_day(log: DataFrame, date: str = "date") -> DataFrame:
    """Downloads per calendar day; those without a readable date, such as a header line, add up under a null day."""
    return log.groupBy(F.col(date).try_cast("date").alias("day")).agg(F.count(F.lit(1)).alias("downloads"))


def downloads_by_month(daily: DataFrame) -> DataFrame:
    """Downloads per month ``yyyy-MM``, added up from the days."""
    return daily.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(F.sum("downloads").alias("downloads"))


def downloads_by_weekday(daily: DataFrame) -> DataFrame:
    """Downloads per day of the week, Monday 1 to Sunday 7, added up from the days."""
    return daily.groupBy((F.weekday("day") + 1).alias("weekday")).agg(F.sum("downloads").alias("downloads"))


def downloads_by_doi(log: DataFrame, doi: str = "doi") -> DataFrame:
    return log.groupBy(F.col(doi).alias("doi")).agg(F.count(F.lit(1)).alias("downloads"))


def doi_prefix(doi: Column) -> Column:
    """What stands before the first slash."""
    return F.substring_index(doi, "/", 1)


def downloads_by_prefix(by_doi: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Downloads per publisher prefix, added up from the articles, with the publisher's name or null."""
    by_prefix = by_doi.groupBy(doi_prefix(F.col("doi")).alias("prefix")).agg(F.sum("downloads").alias("downloads"))
    return by_prefix.join(prefixes, "prefix", "left").select("prefix", "publisher", "downloads")


def downloads_by_publisher(by_doi: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Downloads per publisher; prefixes without a name add up under null."""
    return downloads_by_prefix(by_doi, prefixes).groupBy("publisher").agg(F.sum("downloads").alias("downloads"))


def downloads_by_country(log: DataFrame, country: str = "country") -> DataFrame:
    return log.groupBy(F.col(country).alias("country")).agg(F.count(F.lit(1)).alias("downloads"))


def top_articles(by_doi: DataFrame, metadata: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most downloaded articles with their metadata, ties in order of the DOI.

    ``metadata`` has a row per article and a column ``doi``. The few articles go to the
    metadata rather than the other way round, so the metadata is scanned but not shuffled.
    """
    top = by_doi.orderBy(F.desc("downloads"), "doi").limit(k)
    known = metadata.join(F.broadcast(top.select("doi")), "doi", "left_semi")
    return top.join(known, "doi", "left").orderBy(F.desc("downloads"), "doi")


def downloads_by_place(log: DataFrame, coords: str = "coords", decimals: int = 2) -> DataFrame:
    """Downloads per coordinate, rounded so that one place written in two ways counts as one.

    Coordinates are text ``latitude,longitude``. Those that do not read as two numbers or
    lie off the globe are left out.
    """
    parts = F.split(F.col(coords), ",")
    number = [F.trim(parts[i]).try_cast("double") for i in (0, 1)]
    placed = log.where(F.size(parts) == 2).select(number[0].alias("lat"), number[1].alias("lon"))
    on_globe = placed.where(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180))
    return on_globe.groupBy(
        F.round("lat", decimals).alias("lat"), F.round("lon", decimals).alias("lon")
    ).agg(F.count(F.lit(1)).alias("downloads"))
