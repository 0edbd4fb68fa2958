"""Topic models and clusters of documents, and rankings of topics."""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import LDA, KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from caudal.functions.em import shares_of, step
from caudal.session import remove, ship, work_dir


def _joined(vectors: DataFrame) -> DataFrame:
    """The vectors in a few partitions a core: in each iteration every partition sends a number for each term and topic."""
    return vectors.coalesce(4 * vectors.sparkSession.sparkContext.defaultParallelism)


def lda_topics(
    vectors: DataFrame,
    vocabulary: list[str] | DataFrame,
    k: int = 10,
    iterations: int = 10,
    optimizer: str = "em",
    seed: int = 1,
    terms: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """Topics (topic, terms, termWeights) and document weights (id, topicDistribution).

    ``vocabulary`` names the vectors' places: a list, or a table (term, index).
    """
    if optimizer == "em":
        described, weights = em_topics(vectors, k, iterations, seed, terms)
        return name_terms(described, vocabulary), weights
    lda = LDA(k=k, maxIter=iterations, optimizer=optimizer, featuresCol="termFrequency", seed=seed)
    model = lda.fit(_joined(vectors))
    topics = name_terms(model.describeTopics(terms), vocabulary)
    return topics, model.transform(vectors).select("id", "topicDistribution")


def em_topics(
    vectors: DataFrame, k: int, iterations: int, seed: int, terms: int, features: str = "termFrequency"
) -> tuple[DataFrame, DataFrame]:
    """Described topics (topic, termIndices, termWeights) and document weights by expectation maximisation.

    The updates, the concentrations (50 / k + 1 and 1.1) and the inference of a document's weights are those of the
    library's optimizer "em", which keeps all entries of all documents as a graph in memory. Here documents stay in
    files, with the weights of their topics; a round reads them once. The weights of the terms, ``k`` numbers for each,
    go through the driver to the tasks in each round. The random start depends on the seed and a document's own terms.
    """
    spark = vectors.sparkSession
    context = spark.sparkContext
    alpha, eta = 50 / k + 1, 1.1
    size = (vectors.select(features).first() or [Vectors.sparse(0, {})])[0].size
    parts = F.unwrap_udt(F.col(features))
    places = F.coalesce(parts["indices"], F.when(F.size(parts["values"]) > 0, F.sequence(F.lit(0), F.size(parts["values"]) - 1)))
    rows = vectors.select("id", places.alias("indices"), parts["values"].alias("n"))
    schema = StructType([StructField("term", IntegerType()), *rows.schema.fields, StructField("weights", ArrayType(DoubleType()))])
    ship(spark)
    folder, held = work_dir(spark), None
    documents = rows
    for turn in range(iterations + 1):
        # a partition a core, as each adds a row for every term it has
        made = documents.coalesce(context.defaultParallelism).mapInArrow(step(k, size, alpha, eta, seed, (lambda h: lambda: h and h.value)(held)), schema)
        made.write.option("compression", "zstd").parquet(f"{folder}/{turn}")
        made = spark.read.schema(schema).parquet(f"{folder}/{turn}")
        sums = made.where("term is not null").groupBy("term").agg(*[F.sum(F.col("weights")[i]).alias(f"w{i}") for i in range(k)]).toArrow()
        found = np.zeros((size, k))
        found[sums["term"].to_numpy()] = np.stack([sums[f"w{i}"].to_numpy() for i in range(k)], 1)
        held = context.broadcast(found)
        documents = made.where("term is null").drop("term")
        if turn:
            remove(spark, f"{folder}/{turn - 1}")
    shares = found / found.sum(0)
    best = [np.argsort(-shares[:, i], kind="stable")[:terms] for i in range(k)]
    data = [(i, at.tolist(), shares[at, i].tolist()) for i, at in enumerate(best)]
    described = spark.createDataFrame(data, "topic int, termIndices array<int>, termWeights array<double>")
    given = StructType([rows.schema["id"], StructField("shares", ArrayType(DoubleType()))])
    weights = documents.select("id", "indices", "n").mapInArrow(shares_of(alpha, lambda: held.value), given)
    return described, weights.select("id", array_to_vector("shares").alias("topicDistribution"))


def name_terms(described: DataFrame, vocabulary: list[str] | DataFrame) -> DataFrame:
    """Topics with words in place of term numbers; numbers outside the vocabulary are skipped.

    Only the described terms are named, a few per topic, so they can go to every task; a vocabulary that is a table
    stays where it is.
    """
    placed = described.select("topic", "termWeights", F.posexplode("termIndices").alias("pos", "termIndex"))
    if isinstance(vocabulary, DataFrame):
        named = vocabulary.select(F.col("index").alias("termIndex"), "term").join(F.broadcast(placed), "termIndex")
    else:
        asked = {i for row in described.select("termIndices").collect() for i in row[0] if i < len(vocabulary)}
        words = described.sparkSession.createDataFrame([(i, vocabulary[i]) for i in sorted(asked)], "termIndex int, term string")
        named = placed.join(F.broadcast(words), "termIndex")
    return named.groupBy("topic", "termWeights").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "term"))), lambda t: t["term"]).alias("terms")
    ).select("topic", "terms", "termWeights")


def kmeans_clusters(
    vectors: DataFrame, k: int, iterations: int = 10, features: str = "termFrequency", seed: int = 1
) -> tuple[DataFrame, KMeansModel]:
    """Cluster of each document (id, cluster), and the model."""
    model = KMeans(k=k, maxIter=iterations, featuresCol=features, predictionCol="cluster", seed=seed).fit(_joined(vectors))
    return model.transform(vectors).select("id", "cluster"), model


def as_array(doc_topics: DataFrame, column: str = "topicDistribution") -> DataFrame:
    """Document weights with the vector as an array."""
    return doc_topics.withColumn(column, vector_to_array(column))


def expand_topics(topics: DataFrame, *keep: str) -> DataFrame:
    """(topic, pos, term, termWeight): the two parallel arrays unrolled together, by position."""
    return topics.select(*keep, "topic", F.posexplode(F.arrays_zip("terms", "termWeights")).alias("pos", "pair")).select(
        *keep, "topic", "pos", F.col("pair.terms").alias("term"), F.col("pair.termWeights").alias("termWeight")
    )


def expand_doc_topics(doc_topics: DataFrame, *keep: str) -> DataFrame:
    """(id, pos, topicDistribution): a row per document and topic."""
    return doc_topics.select(*keep, "id", F.posexplode("topicDistribution").alias("pos", "topicDistribution"))


def top_topics(weights: DataFrame, topics: DataFrame, n: int = 5, only: DataFrame | None = None) -> DataFrame:
    """The ``n`` topics that are dominant in most documents: (topic, label, count).

    ``weights`` are (id, pos, topicDistribution). The dominant topic has the highest
    weight, the lowest number among equals. ``only`` keeps the documents whose id it has.
    """
    if only is not None:
        weights = weights.join(only.select("id").distinct(), "id", "left_semi")
    dominant = weights.groupBy("id").agg(
        F.max(F.struct(F.col("topicDistribution").alias("weight"), (-F.col("pos")).alias("place"))).alias("best")
    )
    counted = dominant.groupBy((-F.col("best.place")).alias("topic")).agg(F.count(F.lit(1)).alias("count"))
    best = counted.orderBy(F.desc("count"), "topic").limit(n)
    return (
        topics.join(F.broadcast(best), "topic")
        .select("topic", F.array_join("terms", " ").alias("label"), "count")
        .orderBy(F.desc("count"), "topic")
    )


def top_topic_per_group(
    weights: DataFrame,
    groups: DataFrame,
    topics: DataFrame,
    column: str,
    n: int = 10,
    minimum: float = 0.1,
    dedupe: str = "topic",
) -> DataFrame:
    """For the ``n`` group values with most documents, the topic of highest mean weight.

    ``groups`` are (id, column). Weights below ``minimum`` do not count. With ``dedupe``
    "topic" a document's weight counts for one of its groups only, the smallest of those
    that are ranked; with "group" it counts for each of them.

    A document's groups are reduced to the ranked ones, at most ``n``, before they meet its
    weights, so the join cannot grow with the number of rows a document has in ``groups``.
    """
    known = groups.select("id", F.col(column).alias("group"))
    ranked = (
        known.groupBy("group")
        .agg(F.count_distinct("id").alias("documents"))
        .orderBy(F.desc("documents"), "group")
        .limit(n)
        .select(F.col("group").alias("ranked"))
    )
    members = known.join(F.broadcast(ranked), F.col("group").eqNullSafe(F.col("ranked")), "left_semi")
    if dedupe == "topic":
        members = members.groupBy("id").agg(F.min(F.struct("group")).alias("least")).select("id", "least.group")
    else:
        members = members.distinct()
    means = (
        weights.where(F.col("topicDistribution") >= minimum)
        .join(members, "id")
        .groupBy("group", F.col("pos").alias("topic"))
        .agg(F.avg("topicDistribution").alias("mean"))
    )
    best = means.groupBy("group").agg(
        F.max(F.struct("mean", (-F.col("topic")).alias("place"))).alias("best")
    )
    named = best.select("group", (-F.col("best.place")).alias("topic"), F.col("best.mean").alias("mean"))
    return (
        topics.join(F.broadcast(named), "topic")
        .select(F.col("group").alias(column), "topic", "mean", F.array_join("terms", " ").alias("label"))
        .orderBy(column)
    )
