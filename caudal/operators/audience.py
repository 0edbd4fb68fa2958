"""Distinct users that roll up: bitmaps per day, joined to those of weeks and months without reading hits again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.functions.time import instant
from caudal.operators.dictionary import number_rows

# The name of each level and what a day is cut to.
LEVELS = {"day": "DAY", "week": "WEEK", "month": "MONTH", "year": "YEAR"}


def user_numbers(hits: DataFrame, user: str = "userid") -> DataFrame:
    """(userid, number): the users that hits name, numbered from 0."""
    return number_rows(hits.select(F.col(user).alias("userid")).where("userid IS NOT NULL").distinct(), "userid", "number")


def daily_bitmaps(hits: DataFrame, numbers: DataFrame, *, user: str = "userid", timestamp: str = "timestamp") -> DataFrame:
    """(day, bucket, users): a bitmap of 4 KB for each day and 32,768 user numbers that have a user on it.

    Hits are reduced to users per day before they meet the numbers. Hits without a readable time or a user don't count.
    """
    days = hits.select(F.col(user).alias("userid"), instant(hits, timestamp).cast("date").alias("day")).where("day IS NOT NULL").distinct()
    placed = days.join(numbers, "userid").select(
        "day", F.expr("bitmap_bucket_number(number)").alias("bucket"), F.expr("bitmap_bit_position(number)").alias("bit")
    )
    return placed.groupBy("day", "bucket").agg(F.bitmap_construct_agg("bit").alias("users"))


def roll_up(bitmaps: DataFrame, level: str) -> DataFrame:
    """The same for weeks (from Monday), months or years, from days or from any finer level that doesn't cross them."""
    start = F.trunc("day", LEVELS[level]) if level != "day" else F.col("day")
    return bitmaps.groupBy(start.alias("day"), "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def distinct_users(bitmaps: DataFrame) -> DataFrame:
    """(day, users): how many users there are in each bitmap's time."""
    return bitmaps.groupBy("day").agg(F.sum(F.bitmap_count("users")).alias("users"))


def audience(bitmaps: DataFrame, levels: tuple[str, ...] = ("day", "week", "month")) -> DataFrame:
    """(level, start, users) for each level, all from the daily bitmaps."""
    parts = [distinct_users(roll_up(bitmaps, level)).select(F.lit(level).alias("level"), F.col("day").cast("string").alias("start"), "users") for level in levels]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
