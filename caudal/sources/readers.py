"""Readers: each returns a DataFrame over files, with a fixed schema."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caudal.functions.text import trim_blanks
from caudal.sources.schemas import DOWNLOADS, PREFIXES, PROJECT


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Text files as rows ``value``, one per line."""
    return spark.read.text(list(paths))


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small dataset written out in the program."""
    return spark.createDataFrame(list(rows), schema)


def read_projects(spark: SparkSession, path: str) -> DataFrame:
    """Nested project records, one JSON object per line."""
    return spark.read.schema(PROJECT).json(path)


def parse_projects(df: DataFrame, column: str = "value", fields: Iterable[str] | None = None) -> DataFrame:
    """The same records from a column that holds one JSON object per row; only the named fields are parsed.

    Going through an array of one record makes Spark parse each object once; otherwise
    every field and filter downstream would parse it anew.
    """
    schema = PROJECT if fields is None else StructType([PROJECT[name] for name in fields])
    record = F.explode(F.array(F.from_json(F.col(column), schema)))
    return df.select(record.alias("record")).select("record.*")


def parse_hits(lines: DataFrame, column: str = "value") -> DataFrame:
    """Hit-log lines with exactly four tab-separated fields; a bad amount counts as 0.

    The line is trimmed before it is split, so a line that ends in an empty amount
    has three fields and is left out.
    """
    return lines.select(F.split(trim_blanks(F.col(column)), "\t").alias("f")).where(F.size("f") == 4).select(
        F.col("f")[0].try_cast("timestamp_ntz").alias("timestamp"),
        F.col("f")[1].alias("userid"),
        F.col("f")[2].alias("event"),
        F.coalesce(F.col("f")[3].try_cast("double"), F.lit(0.0)).alias("amount"),
    )


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Hit log from one file or from the files that lie directly in a directory."""
    return parse_hits(spark.read.option("recursiveFileLookup", "false").text(path))


def read_downloads(spark: SparkSession, files: str | Iterable[str]) -> DataFrame:
    """Download log: six tab-separated fields, from one file or a list of files in one scan."""
    paths = [files] if isinstance(files, str) else list(files)
    return spark.read.schema(DOWNLOADS).option("sep", "\t").option("quote", "").csv(paths)


def read_prefixes(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Mapping from DOI prefix to publisher, CSV with quoting."""
    return spark.read.schema(PREFIXES).option("header", header).option("escape", '"').csv(path)


def parse_triples(lines: DataFrame, column: str = "value") -> DataFrame:
    """N-Triples lines as (subject, relation, object).

    Lines that do not start with ``<`` are junk. The final dot goes, and the rest is
    split on whitespace into at most three fields.
    """
    line: Column = F.col(column)
    fields = F.split(F.regexp_replace(trim_blanks(line), r"\s*\.\s*$", ""), r"\s+", 3)
    return lines.where(F.startswith(line, F.lit("<"))).select(fields.alias("f")).select(
        F.get("f", F.lit(0)).alias("subject"),
        F.get("f", F.lit(1)).alias("relation"),
        F.get("f", F.lit(2)).alias("object"),
    )


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    return parse_triples(spark.read.text(path))


def topics_path(base: str, k: int, optimizer: str) -> str:
    return f"{base}/LDA_{k}_topics_{optimizer}_optimizer.parquet"


def doc_topics_path(base: str, k: int, optimizer: str) -> str:
    return f"{base}/laws_LDA_{k}_topics_{optimizer}_optimizer.parquet"


def read_topic_runs(
    spark: SparkSession, base: str, ks: Iterable[int], optimizers: Iterable[str] = ("em", "online")
) -> tuple[DataFrame, DataFrame]:
    """Topics and document weights of several runs, each as one frame with columns ``k`` and ``optimizer``."""
    runs = [(k, optimizer) for optimizer in optimizers for k in ks]

    def gather(path_of) -> DataFrame:
        frames = [
            spark.read.parquet(path_of(base, k, optimizer)).select(
                F.lit(k).alias("k"), F.lit(optimizer).alias("optimizer"), "*"
            )
            for k, optimizer in runs
        ]
        whole = frames[0]
        for frame in frames[1:]:
            whole = whole.unionByName(frame)
        return whole

    return gather(topics_path), gather(doc_topics_path)
