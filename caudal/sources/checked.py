"""Readers that keep what can't be read, with the file it stands in, instead of making records of nulls."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from caudal.functions.text import trim_blanks
from caudal.sources.readers import parse_hits
from caudal.sources.schemas import DOWNLOADS, PROJECT

_BAD = "_unreadable"


class Checked(NamedTuple):
    """Records, and (file, line) of every line that gives none."""

    good: DataFrame
    bad: DataFrame

    def counts(self) -> DataFrame:
        """(file, bad): the number of unreadable lines of each file that has any."""
        return self.bad.groupBy("file").agg(F.count(F.lit(1)).alias("bad"))

    def quarantine(self, path: str) -> None:
        """Write the unreadable lines, a folder for each file's name."""
        name = F.substring_index("file", "/", -1)
        self.bad.withColumn("name", name).write.partitionBy("name").mode("append").json(path)


def _lines(spark: SparkSession, paths: tuple[str, ...]) -> DataFrame:
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("file"))
    return lines.where(F.length(trim_blanks(F.col("value"))) > 0)


def _split(lines: DataFrame, is_bad: Column, good: DataFrame) -> Checked:
    return Checked(good, lines.where(is_bad).select("file", F.col("value").alias("line")))


def read_projects(spark: SparkSession, *paths: str) -> Checked:
    """Project records, one JSON object per line.

    A line is bad if it is no JSON object or if a value in it doesn't fit the schema. Empty lines are neither good nor
    bad. Each line is parsed once for the good and once for the bad ones.
    """
    lines = _lines(spark, paths)
    schema = StructType([*PROJECT.fields]).add(_BAD, StringType())
    record = F.from_json("value", schema, {"columnNameOfCorruptRecord": _BAD})
    # through an array of one, so that the object is parsed once
    parsed = lines.withColumn("record", F.explode(F.array(record)))
    bad = F.col("record").isNull() | F.col(f"record.{_BAD}").isNotNull()
    return _split(parsed, bad, parsed.where(~bad).select(*[f"record.{name}" for name in PROJECT.names]))


def read_hits(spark: SparkSession, *paths: str) -> Checked:
    """Hits: lines of four tab-separated fields with a readable time. A bad amount counts as 0, as in the plain reader."""
    lines = _lines(spark, paths)
    fields = F.split(trim_blanks(F.col("value")), "\t")
    bad = (F.size(fields) != 4) | fields[0].try_cast("timestamp_ntz").isNull()
    return _split(lines, bad, parse_hits(lines.where(~bad)))


def read_downloads(spark: SparkSession, *paths: str) -> Checked:
    """Downloads: lines of six tab-separated fields."""
    lines = _lines(spark, paths)
    fields = F.split("value", "\t", -1)
    bad = F.size(fields) != len(DOWNLOADS)
    # an empty field is no value, as in CSV
    named = [F.nullif(fields[i], F.lit("")).alias(name) for i, name in enumerate(DOWNLOADS.names)]
    return _split(lines, bad, lines.where(~bad).select(*named))
