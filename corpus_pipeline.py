"""The corpus pipeline: documents are judged, cleaned of repeated lines and near copies, mixed, and packed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caudal.llm import jaccard, lines, mixing, packing, quality
from caudal.llm.queries import tokenizer
from caudal.llm.stage import Stage

Step = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and lie near their language and source."""
    return quality.keep_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand, alike, further up in the corpus; n_chars is the new length."""
    return lines.without_repeated_lines(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group that is alike in five-word shingles, by 80 % or more."""
    return jaccard.keep_one_each(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix, by part file and inside each."""
    return mixing.mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences, whose numbers follow the mix."""
    return packing.pack_in_order(docs, tokenizer())


STAGES: list[tuple[str, Step]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources", mixing_sources),
    ("best-fit packing", best_fit_packing),
]

#: Fuzzy lines, robust outliers and tokenising have no SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and read again by the next."""
    stage = Stage(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, step) in enumerate(STAGES):
        docs = stage.put(step(spark, docs, sf_dir), f"{number}-{name.replace(' ', '-')}")
    return docs
