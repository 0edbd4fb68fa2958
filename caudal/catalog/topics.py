"""Topic jobs. Embeddings serve as topic weights: the share of each place in the vector's absolute sum."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.catalog import Catalog, table
from caudal.catalog.features import documents, terms_sql
from caudal.operators import dictionary as D
from caudal.operators import topics as T
from caudal.session import materialise

catalog = Catalog()


def _doc_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    # an array of one value binds the sum, which would else be taken anew for every place
    shares = "transform(array(aggregate(sizes, 0D, (a, x) -> a + x)), whole -> transform(sizes, x -> x / whole))[0]"
    sized = table(spark, sf_dir, "embeddings").select("vec_id", "label", sizes.alias("sizes"))
    return sized.select(F.col("vec_id").alias("id"), F.expr(shares).alias("topicDistribution"), "label")


def _weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.expand_doc_topics(_doc_topics(spark, sf_dir))


def _topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic per place; its terms are the place and the label of the vector with the highest weight there."""
    strongest = T.expand_doc_topics(_doc_topics(spark, sf_dir), "label").groupBy(F.col("pos").alias("topic")).agg(
        F.max(F.struct(F.col("topicDistribution").alias("weight"), "label")).alias("best")
    )
    place = F.concat(F.lit("place"), F.col("topic").cast("string"))
    label = F.concat(F.lit("label"), F.col("best.label").cast("string"))
    return strongest.select(
        "topic",
        F.array(place, label).alias("terms"),
        F.array(F.lit(1.0), F.col("best.weight")).alias("termWeights"),
    )


_WEIGHTS_SQL = """
    sizes AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: abs(x::DOUBLE)) AS s FROM embeddings),
    weights AS (
      SELECT id, label, unnest(range(len(s)))::INTEGER AS pos, unnest(list_transform(s, lambda x: x / list_sum(s))) AS w
      FROM sizes),
    topics AS (SELECT pos AS topic, arg_max(label, w) AS best, max(w) AS top FROM weights GROUP BY pos)"""

catalog.add(
    "expand_topics",
    lambda spark, sf: T.expand_topics(_topics(spark, sf)).withColumn("termWeight", F.round("termWeight", 6)),
    f"""WITH {_WEIGHTS_SQL}
    SELECT topic, 0 AS pos, 'place' || topic AS term, 1.0::DOUBLE AS "termWeight" FROM topics
    UNION ALL SELECT topic, 1, 'label' || best, round(top, 6) FROM topics""",
)

catalog.add(
    "expand_doc_topics",
    lambda spark, sf: _weights(spark, sf).withColumn("topicDistribution", F.round("topicDistribution", 6)),
    f"""WITH {_WEIGHTS_SQL} SELECT id, pos, round(w, 6) AS "topicDistribution" FROM weights""",
)


def _top_sql(only: str = "") -> str:
    return f"""WITH {_WEIGHTS_SQL},
    dominant AS (SELECT id, first(pos ORDER BY w DESC, pos) AS topic FROM weights {only} GROUP BY id),
    counted AS (SELECT topic, count(*) AS n FROM dominant GROUP BY topic ORDER BY n DESC, topic LIMIT 5)
    SELECT topic, 'place' || topic || ' label' || best AS label, n AS "count"
    FROM counted JOIN topics USING (topic) ORDER BY n DESC, topic"""


catalog.add(
    "top_topics",
    lambda spark, sf: T.top_topics(_weights(spark, sf), _topics(spark, sf)),
    _top_sql(),
)


def _with_quality(spark: SparkSession, sf_dir: str, quality: int) -> DataFrame:
    return table(spark, sf_dir, "labels").where(F.col("quality") == quality).select(F.col("doc_id").alias("id"))


def _add_by_result(quality: int) -> None:
    catalog.add(
        f"top_topics_by_result_{quality}",
        lambda spark, sf: T.top_topics(_weights(spark, sf), _topics(spark, sf), only=_with_quality(spark, sf, quality)),
        _top_sql(f"WHERE id IN (SELECT doc_id FROM labels WHERE quality = {quality})"),
    )


_add_by_result(1)
_add_by_result(0)


def _add_per_group(name: str, column: str, dedupe: str, sql_members: str) -> None:
    catalog.add(
        name,
        lambda spark, sf: T.top_topic_per_group(
            _weights(spark, sf),
            table(spark, sf, "documents").select(F.col("doc_id").alias("id"), column),
            _topics(spark, sf),
            column,
            minimum=0.02,
            dedupe=dedupe,
        ).withColumn("mean", F.round("mean", 6)),
        f"""WITH {_WEIGHTS_SQL},
        ranked AS (SELECT {column} AS g FROM documents GROUP BY 1 ORDER BY count(DISTINCT doc_id) DESC, 1 LIMIT 10),
        members AS ({sql_members}),
        means AS (SELECT g, pos, avg(w) AS mean FROM weights JOIN members USING (id) WHERE w >= 0.02 GROUP BY g, pos),
        best AS (SELECT g, first(pos ORDER BY mean DESC, pos) AS topic, max(mean) AS mean FROM means GROUP BY g)
        SELECT g AS {column}, topic, round(mean, 6) AS mean, 'place' || topic || ' label' || best AS label
        FROM best b JOIN topics t USING (topic) ORDER BY g""".replace("|| best AS", "|| t.best AS"),
    )


for _column in ("source", "lang"):
    _add_per_group(
        f"top_topic_per_{_column}",
        _column,
        "topic",
        f"SELECT doc_id AS id, min({_column}) AS g FROM documents WHERE {_column} IN (FROM ranked) GROUP BY 1",
    )
    _add_per_group(
        f"top_topic_per_{_column}_all",
        _column,
        "group",
        f"SELECT DISTINCT doc_id AS id, {_column} AS g FROM documents WHERE {_column} IN (FROM ranked)",
    )


def _indexed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Vectors of the documents' terms for the models, and the dictionary."""
    rows = documents(spark, sf_dir)
    dictionary = D.numbered_terms(rows)
    size = max(1, dictionary.count())
    return materialise(D.ml_vectors(D.term_vectors(rows, dictionary), size)), dictionary


def _add_lda(optimizer: str) -> None:
    def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The ten strongest terms of each topic with their weights."""
        vectors, dictionary = _indexed(spark, sf_dir)
        found, _ = T.lda_topics(vectors, dictionary, k=5, iterations=5, optimizer=optimizer)
        return T.expand_topics(found)

    def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The weight of each topic in each document."""
        vectors, dictionary = _indexed(spark, sf_dir)
        _, found = T.lda_topics(vectors, dictionary, k=5, iterations=5, optimizer=optimizer)
        return T.expand_doc_topics(T.as_array(found))

    # fits have no SQL; the tests hold them against what any right result has
    catalog.add(f"lda_{optimizer}", topics)
    catalog.add(f"lda_{optimizer}_documents", weights)


_add_lda("em")
_add_lda("online")


def _kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of each document."""
    return T.kmeans_clusters(_indexed(spark, sf_dir)[0], k=5)[0]


catalog.add("kmeans", _kmeans)
