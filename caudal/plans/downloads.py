"""Download logs to the frequency tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from caudal.operators import downloads as D
from caudal.sources.readers import read_downloads, read_prefixes
from caudal.sources.writers import write_parquet


def download_report(
    spark: SparkSession, files: Iterable[str], prefixes: str, metadata: DataFrame, out: str
) -> dict[str, DataFrame]:
    """Frequencies by time, publisher, article, country and place.

    The text log is read once and written as columns below ``out``; the days, articles,
    countries and places are counted from there, each from the one column it needs. Months,
    weekdays, prefixes and publishers add up the counts per day and per article.
    """
    write_parquet(read_downloads(spark, files), f"{out}/log.parquet")
    log = spark.read.parquet(f"{out}/log.parquet")
    write_parquet(D.downloads_by_day(log), f"{out}/by_day.parquet")
    write_parquet(D.downloads_by_doi(log), f"{out}/by_doi.parquet")
    daily, by_doi = spark.read.parquet(f"{out}/by_day.parquet"), spark.read.parquet(f"{out}/by_doi.parquet")
    names = read_prefixes(spark, prefixes)
    return {
        "by_day": daily,
        "by_month": D.downloads_by_month(daily),
        "by_weekday": D.downloads_by_weekday(daily),
        "by_doi": by_doi,
        "by_prefix": D.downloads_by_prefix(by_doi, names),
        "by_publisher": D.downloads_by_publisher(by_doi, names),
        "by_country": D.downloads_by_country(log),
        "by_place": D.downloads_by_place(log),
        "top_articles": D.top_articles(by_doi, metadata),
    }
