"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType


def instant(df: DataFrame, name: str) -> Column:
    """The column as a timestamp; text is read as a wall-clock time without zone, null if it can't be read."""
    if isinstance(df.schema[name].dataType, StringType):
        return F.col(name).try_cast(TimestampNTZType())
    return F.col(name)


def epoch_minute(df: DataFrame, name: str) -> Column:
    """Whole minutes since 1970-01-01 00:00, rounded down."""
    if isinstance(df.schema[name].dataType, TimestampType):
        return F.floor(F.unix_seconds(F.col(name)) / 60)
    since = instant(df, name) - F.lit("1970-01-01 00:00:00").cast(TimestampNTZType())
    # the parts of an interval before 1970 are negative and cut toward zero
    return (
        F.extract(F.lit("DAY"), since).cast("long") * 1440
        + F.extract(F.lit("HOUR"), since) * 60
        + F.extract(F.lit("MINUTE"), since)
        + F.floor(F.extract(F.lit("SECOND"), since) / 60).cast("long")
    )


def iso_day(text: Column) -> Column:
    """``dd/MM/yyyy`` text as ``yyyy-MM-dd`` text; anything else gives null."""
    return F.date_format(F.try_to_date(text, "dd/MM/yyyy"), "yyyy-MM-dd")


def day_text(when: Column) -> Column:
    """The day as ``yyyy-MM-dd``; a time without zone is taken as it stands."""
    return when.cast("date").cast("string")


def hour_text(when: Column) -> Column:
    """Hour of the day as two digits."""
    return F.lpad(F.hour(when).cast("string"), 2, "0")
