"""Topic models, clusters and topic reports, from flat tables to files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.operators import dictionary as D
from caudal.operators import features as X
from caudal.operators import topics as T
from caudal.plans.corpus import flat_tables
from caudal.session import materialise
from caudal.sources.readers import doc_topics_path, read_topic_runs, topics_path
from caudal.sources.writers import save_model, write_parquet, write_report


def run_topic_models(
    spark: SparkSession,
    laws: str,
    out: str,
    ks: Iterable[int],
    optimizers: Iterable[str] = ("em",),
    iterations: int = 10,
    seed: int = 1,
) -> None:
    """Topics and document weights for each number of topics and optimizer; words are counted once for all."""
    documents = X.law_text(spark.read.parquet(laws), sep=" ")
    dictionary = D.numbered_terms(documents)
    vectors = materialise(D.ml_vectors(D.term_vectors(documents, dictionary), max(1, dictionary.count())))
    runs = [(k, optimizer) for optimizer in optimizers for k in ks]
    for k, optimizer in runs:
        topics, doc_topics = T.lda_topics(vectors, dictionary, k, iterations, optimizer, seed)
        write_parquet(topics, topics_path(out, k, optimizer))
        write_parquet(doc_topics, doc_topics_path(out, k, optimizer))


def run_clustering(
    spark: SparkSession, laws: str, out: str, k: int, iterations: int = 10, features: str = "termFrequency", seed: int = 1
) -> None:
    """Cluster of each law, and the model. Summary and text are put together without a space."""
    documents = X.law_text(spark.read.parquet(laws), sep="")
    dictionary = D.numbered_terms(documents)
    entries = {"termFrequency": "tf", "tfIdf": "tf_idf"}[features]
    vectors = D.ml_vectors(D.term_vectors(documents, dictionary), max(1, dictionary.count()), entries, features)
    clusters, model = T.kmeans_clusters(materialise(vectors), k, iterations, features, seed)
    save_model(model, f"{out}/kmeans_{k}.model")
    write_parquet(clusters, f"{out}/laws_kmeans_{k}.parquet")


def run_expansion(
    spark: SparkSession, base: str, out: str, ks: Iterable[int], optimizers: Iterable[str] = ("em", "online")
) -> None:
    """All runs as two long tables, partitioned by number of topics and optimizer."""
    topics, doc_topics = read_topic_runs(spark, base, list(ks), list(optimizers))
    run = ("k", "optimizer")
    T.expand_topics(topics, *run).write.partitionBy(*run).parquet(f"{out}/topics_expanded.parquet")
    T.expand_doc_topics(T.as_array(doc_topics), *run).write.partitionBy(*run).parquet(f"{out}/laws_expanded.parquet")


def topic_reports(
    tables: dict[str, DataFrame], topics: DataFrame, weights: DataFrame, minimum: float = 0.1, dedupe: str = "topic"
) -> dict[str, DataFrame]:
    """The nine reports by name, with the columns of their files."""

    def with_result(result: str) -> DataFrame:
        return tables["results"].where(F.col("result") == result).select("id")

    def top(only: DataFrame | None = None) -> DataFrame:
        return T.top_topics(weights, topics, only=only).select("label", "count")

    def per_group(table: str, column: str) -> DataFrame:
        return T.top_topic_per_group(weights, tables[table], topics, column, minimum=minimum, dedupe=dedupe)

    return {
        "topTopics": top(),
        "topSanctionedTopics": top(with_result("SANCIONADO")),
        "topHalfSanctionedTopics": top(with_result("MEDIA SANCION")),
        "topRetiredTopics": top(with_result("RETIRADO")),
        "topTopicsForTopParties": per_group("signers", "party"),
        "topTopicsForTopDistricts": per_group("signers", "district"),
        "topTopicsForTopCongressmen": per_group("signers", "congressman"),
        "topTopicsForTopDeputyCommissions": per_group("deputyCommissions", "commission"),
        "topTopicsForTopSenateCommissions": per_group("senateCommissions", "commission"),
    }


def run_topic_reports(
    spark: SparkSession, tables: str, topics: str, weights: str, out: str, minimum: float = 0.1, dedupe: str = "topic"
) -> None:
    """Write each report as one CSV file; ``topics`` and ``weights`` are Parquet paths of one run."""
    reports = topic_reports(
        flat_tables(spark, tables), spark.read.parquet(topics), spark.read.parquet(weights), minimum, dedupe
    )
    for name, report in reports.items():
        write_report(report, f"{out}/{name}.csv")
