"""Sessions of hits that arrive over time."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from caudal.functions.time import instant
from caudal.operators.sessions import EVENT_IDS

SESSION = ("userid", "start", "end", "renders", "plays", "checkouts", "amount")
#: Sessions that grow are put together inside a task before they are shuffled, so a busy user is a few rows a task.
LOCAL_MERGE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def session_stream(
    hits: DataFrame,
    minutes: int = 30,
    lateness: str = "1 day",
    *,
    user: str = "userid",
    timestamp: str = "timestamp",
    event: str = "event",
    amount: str = "amount",
    events: Mapping[str, str] = EVENT_IDS,
) -> DataFrame:
    """Sessions (userid, start, end, renders, plays, checkouts, amount) of a stream of hits, each once it is closed.

    The rule is that of ``sessionize``: more than ``minutes`` whole minutes after the last hit a new session opens.
    Hits are put on their minute, and the gap is half a minute longer than ``minutes``, so whether windows that
    touch are merged doesn't matter. A session is closed, and what is held of it given up, when the latest time seen,
    less ``lateness``, has passed its end and the gap; hits that come later than that are dropped and counted in
    the query's progress. Hits without a readable time or without a user belong to no session. A time without zone is
    taken in the session's zone, which should have no summer time: an hour that is skipped would shorten gaps.
    """
    if minutes <= 0:
        raise ValueError("minutes must be positive")

    def hits_of(letter: str) -> Column:
        return F.count_if(F.col("_event") == events[letter])

    timed = hits.select(
        F.col(user).alias("userid"), instant(hits, timestamp).alias("_at"), F.col(event).alias("_event"), F.col(amount).alias("_amount")
    ).where("userid IS NOT NULL AND _at IS NOT NULL")
    on_minute = timed.withColumn("_minute", F.date_trunc("minute", "_at").cast("timestamp"))
    return (
        on_minute.withWatermark("_minute", lateness)
        .groupBy("userid", F.session_window("_minute", f"{60 * minutes + 30} seconds").alias("window"))
        .agg(
            F.min("_at").alias("start"),
            F.max("_at").alias("end"),
            hits_of("R").alias("renders"),
            hits_of("P").alias("plays"),
            hits_of("C").alias("checkouts"),
            F.sum("_amount").alias("amount"),
        )
        .select(*SESSION)
    )


class SessionRun(NamedTuple):
    """What one run over the files that were there took in."""

    #: rows read
    rows: int
    #: rows (after those of one task are put together) that came too late
    late: int


def update_sessions(
    spark: SparkSession, folder: str, schema: StructType, out: str, checkpoint: str, minutes: int = 30, lateness: str = "1 day", files: int | None = None, **columns
) -> SessionRun:
    """Take in the Parquet files of ``folder`` that are new since the last run, and append closed sessions to ``out``.

    ``files`` limits how many are read at a time. Both what has been read and the sessions still open are kept under
    ``checkpoint``: a run that is broken off goes on from there, and no session is written twice.
    """
    reader = spark.readStream.schema(schema)
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    before = spark.conf.get(LOCAL_MERGE)
    spark.conf.set(LOCAL_MERGE, "true")
    try:
        sessions = session_stream(reader.parquet(folder), minutes, lateness, **columns)
        query = sessions.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(LOCAL_MERGE, before)
    progress = query.recentProgress
    return SessionRun(
        sum(p["numInputRows"] for p in progress), sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])
    )


def open_sessions(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The sessions that the last run left open, read from what is kept of them."""
    state = spark.read.format("statestore").load(checkpoint)
    # what is kept ends in the aggregates, in their order; three of them have one name, so they are named anew by place
    kept = state.schema["value"].dataType.fields
    names = [f"_{i}" for i in range(len(kept) - len(SESSION) + 1)] + list(SESSION[1:])
    renamed = StructType([StructField(name, f.dataType) for name, f in zip(names, kept, strict=True)])
    return state.select(F.col("key.userid").alias("userid"), F.col("value").cast(renamed).alias("v")).select("userid", *[f"v.{n}" for n in SESSION[1:]])


def all_sessions(spark: SparkSession, out: str, checkpoint: str) -> DataFrame:
    """Closed and open sessions together: those of all hits taken in, less the late ones."""
    return spark.read.parquet(out).select(*SESSION).unionByName(open_sessions(spark, checkpoint))
