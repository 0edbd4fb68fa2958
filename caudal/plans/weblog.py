"""Hit log to hits and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caudal.operators import sessions as S
from caudal.sources.readers import read_hits
from caudal.sources.writers import write_parquet


def run_sessionization(spark: SparkSession, log: str, out: str, minutes: int) -> DataFrame:
    """Write ``hitsDataset.parquet`` and ``sessionsDataset.parquet`` below ``out``; return the sessions.

    The sessions are made from the written hits, so the text is read and parsed once.
    """
    hits_path, sessions_path = f"{out}/hitsDataset.parquet", f"{out}/sessionsDataset.parquet"
    write_parquet(read_hits(spark, log), hits_path)
    write_parquet(S.sessionize(spark.read.parquet(hits_path), minutes), sessions_path)
    return spark.read.parquet(sessions_path)


def session_report(hits: DataFrame, sessions: DataFrame) -> dict[str, DataFrame]:
    """All measures by name, not yet computed."""
    return {
        "daily_users": S.daily_users(hits),
        "returning_users": S.returning_users(sessions),
        "mean_duration": S.mean_duration(sessions),
        "median_events": S.median_events(sessions),
        "visits_per_hour": S.visits_per_hour(sessions),
        "mean_checkout": S.mean_checkout(sessions),
        "funnel": S.funnel(hits),
        "conversion_rate": S.conversion_rate(hits),
    }
