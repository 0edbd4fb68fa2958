"""Web analytics: sessions rebuilt from hits, and the measures drawn from them.

One user may own a large part of all hits. No step therefore gathers the hits of a
user: hits are first summed per user and minute, which cannot change a session
because the gap is measured in whole minutes. What a user contributes after that is
bounded by the minutes of the period, however many hits there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudal.functions.time import day_text, epoch_minute, hour_text, instant

# Event ids of the hit log. R renders the page, P plays a video, C is a checkout.
EVENT_IDS = {
    "R": "12c6fc06c99a462375eeb3f43dfd832b08ca9e17",
    "P": "bd307a3ec329e10a2cff8fb87480823da114f8f4",
    "C": "7b52009b64fd0a2a49e6d8a939753077792b0554",
}


def event_step(event: Column, events: Mapping[str, str] = EVENT_IDS) -> Column:
    """The step letter of an event id; empty text for events outside the mapping."""
    step = F.lit("")
    for letter, event_id in events.items():
        step = F.when(event == event_id, letter).otherwise(step)
    return step


def sessionize(
    hits: DataFrame,
    minutes: int = 30,
    *,
    user: str = "userid",
    timestamp: str = "timestamp",
    event: str = "event",
    amount: str = "amount",
    events: Mapping[str, str] = EVENT_IDS,
) -> DataFrame:
    """Sessions (userid, start, end, renders, plays, checkouts, amount).

    A hit opens a new session when it comes more than ``minutes`` whole minutes after
    the user's previous hit. Hits without a readable time belong to no session.
    """
    if minutes <= 0:
        raise ValueError("minutes must be positive")

    def hits_of(letter: str) -> Column:
        return F.count_if(F.col(event) == events[letter])

    at = instant(hits, timestamp)
    per_minute = (
        hits.where(at.isNotNull())
        .groupBy(F.col(user).alias("userid"), epoch_minute(hits, timestamp).alias("minute"))
        .agg(
            F.min(at).alias("start"),
            F.max(at).alias("end"),
            hits_of("R").alias("renders"),
            hits_of("P").alias("plays"),
            hits_of("C").alias("checkouts"),
            F.sum(amount).alias("amount"),
        )
    )
    by_time = Window.partitionBy("userid").orderBy("minute")
    gap = F.coalesce(F.col("minute") - F.lag("minute").over(by_time), F.lit(0))
    numbered = per_minute.withColumn("opens", (gap > minutes).cast("int")).withColumn(
        "session", F.sum("opens").over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return (
        numbered.groupBy("userid", "session")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.sum("renders").alias("renders"),
            F.sum("plays").alias("plays"),
            F.sum("checkouts").alias("checkouts"),
            F.sum("amount").alias("amount"),
        )
        .drop("session")
    )


def daily_users(hits: DataFrame, *, user: str = "userid", timestamp: str = "timestamp") -> DataFrame:
    """Distinct users per day."""
    return hits.groupBy(day_text(instant(hits, timestamp)).alias("day")).agg(
        F.count_distinct(user).alias("users")
    )


def returning_users(sessions: DataFrame) -> DataFrame:
    """Per day, the users with more than one session that began on it."""
    per_user = sessions.groupBy(day_text(instant(sessions, "start")).alias("day"), "userid").agg(
        F.count("userid").alias("sessions")
    )
    return per_user.where(F.col("sessions") > 1).groupBy("day").agg(F.count("sessions").alias("users"))


def mean_duration(sessions: DataFrame) -> DataFrame:
    """Mean length of a session in whole minutes between its first and last hit."""
    length = epoch_minute(sessions, "end") - epoch_minute(sessions, "start")
    return sessions.agg(F.avg(length).alias("minutes"))


def median_events(sessions: DataFrame, columns: Sequence[str] = ("renders", "plays", "checkouts")) -> DataFrame:
    """Exact median of each counter, one column each.

    Sessions are counted per value first, so the task that finds the middle sees
    distinct values only. The counters of all sessions add up to the number of hits,
    hence there are at most about sqrt(2 * hits) distinct values of each.
    """
    values = sessions.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("counter"), F.col(c).cast("long").alias("value")) for c in columns])
        )
    )
    counted = values.groupBy("counter", "value").agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(
        *[
            F.percentile(F.when(F.col("counter") == c, F.col("value")), F.lit(0.5), F.col("n")).alias(c)
            for c in columns
        ]
    )


def visits_per_hour(sessions: DataFrame) -> DataFrame:
    """Sessions by day and hour of their start, in order of time."""
    start = instant(sessions, "start")
    return (
        sessions.groupBy(day_text(start).alias("day"), hour_text(start).alias("hour"))
        .agg(F.count("userid").alias("visits"))
        .orderBy("day", "hour")
    )


def mean_checkout(sessions: DataFrame) -> DataFrame:
    """Mean amount of a session, and amount per checkout (null without checkouts)."""
    return sessions.agg(
        F.avg("amount").alias("per_session"),
        F.try_divide(F.sum("amount"), F.sum("checkouts")).alias("per_checkout"),
    )


def funnel(
    hits: DataFrame,
    steps: Sequence[str] = ("R", "P", "C"),
    *,
    user: str = "userid",
    timestamp: str = "timestamp",
    event: str = "event",
    sequence: str | None = None,
    events: Mapping[str, str] = EVENT_IDS,
    spread: int = 16,
) -> DataFrame:
    """User-days (userid, day) on which the steps occurred one after another, other events between or not.

    ``sequence`` orders hits of equal time; without it such hits do not follow one
    another. The earliest way through the steps is followed: the first hit of step
    one, the first hit of step two after that, and so on. Each user-day is a single
    row throughout; hits of a middle step meet it in a join that spreads a user-day
    over ``spread`` groups, so that no group gathers all hits of a busy user.
    """
    if len(steps) < 2:
        raise ValueError("a funnel needs at least two steps")
    at = instant(hits, timestamp)
    key = at if sequence is None else F.struct(at.alias("time"), F.col(sequence).alias("place"))
    marked = hits.where(F.col(event).isin([events[s] for s in set(steps)]) & at.isNotNull()).select(
        F.col(user).alias("userid"), day_text(at).alias("day"), key.alias("at"), F.col(event).alias("event")
    )

    def only(step: str) -> Column:
        return F.col("event") == events[step]

    open_ = (
        marked.where(only(steps[0]) | only(steps[-1]))
        .groupBy("userid", "day")
        .agg(
            F.min(F.when(only(steps[0]), F.col("at"))).alias("reached"),
            F.max(F.when(only(steps[-1]), F.col("at"))).alias("goal"),
        )
        .where(F.col("reached") < F.col("goal"))
    )
    for step in steps[1:-1]:
        salted = marked.where(only(step)).withColumn("salt", F.pmod(F.xxhash64("at"), F.lit(spread)).cast("int"))
        copies = open_.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
        open_ = (
            salted.join(copies, ["userid", "day", "salt"])
            .where((F.col("reached") < F.col("at")) & (F.col("at") < F.col("goal")))
            .groupBy("userid", "day")
            .agg(F.min("at").alias("reached"), F.max("goal").alias("goal"))
        )
    return open_.select("userid", "day")


def conversion_rate(
    hits: DataFrame, steps: Sequence[str] = ("R", "P", "C"), *, user: str = "userid", timestamp: str = "timestamp", **options
) -> DataFrame:
    """Funnel user-days, all user-days and their ratio, in one row."""
    visitors = hits.select(F.col(user).alias("userid"), day_text(instant(hits, timestamp)).alias("day")).distinct()
    done = funnel(hits, steps, user=user, timestamp=timestamp, **options)
    conversions = done.agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = visitors.agg(F.count(F.lit(1)).alias("visitors")).select(conversions.alias("conversions"), "visitors")
    return counted.withColumn("rate", F.try_divide(F.col("conversions").cast("double"), F.col("visitors")))
