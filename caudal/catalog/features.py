"""Term and category features of ``documents`` and ``lineitem``."""

from __future__ import annotations

import os
import zipfile
from functools import lru_cache
from glob import glob

import pyspark
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.catalog import Catalog, table
from caudal.operators import dictionary as D
from caudal.operators import features as X

catalog = Catalog()


@lru_cache(maxsize=1)
def _spanish_sql() -> str:
    """Spark's Spanish stop words as SQL text, read from its library because SQL is made without a session."""
    home = os.environ.get("SPARK_HOME") or os.path.dirname(pyspark.__file__)
    (jar,) = glob(os.path.join(home, "jars", "spark-mllib_*.jar"))
    with zipfile.ZipFile(jar) as archive:
        words = archive.read("org/apache/spark/ml/feature/stopwords/spanish.txt").decode("utf-8").split("\n")
    return ", ".join("'" + word.strip().replace("'", "''") + "'" for word in words if word.strip())


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")


def terms_sql() -> str:
    """Terms per document (tf), documents per term (df) and the number of documents (m); made on request,
    as the stop words are read from a file."""
    return rf"""
    tokens AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS term FROM documents),
    tf AS (SELECT id, term, count(*) AS tf FROM tokens WHERE term NOT IN ({_spanish_sql()}) GROUP BY id, term),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 5),
    m AS (SELECT count(*) AS m FROM documents)"""

catalog.add(
    "term_frequency",
    lambda spark, sf: X.term_frequency(documents(spark, sf)),
    lambda: f"WITH {terms_sql()} SELECT id, term, tf FROM tf JOIN df USING (term)",
)

catalog.add(
    "tfidf",
    lambda spark, sf: X.tf_idf(documents(spark, sf))
    .withColumn("idf", F.round("idf", 6))
    .withColumn("tf_idf", F.round("tf_idf", 6)),
    lambda: f"""WITH {terms_sql()}
    SELECT id, term, tf, round(ln((m + 1.0) / (df + 1)), 6) AS idf, round(tf * ln((m + 1.0) / (df + 1)), 6) AS tf_idf
    FROM tf JOIN df USING (term), m""",
)


def _hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, bucket, tf_idf) for every bucket that a document has a term in."""
    rows = documents(spark, sf_dir)
    weights = Pipeline(stages=X.hashed_tf_idf_stages()).fit(rows).transform(rows)
    placed = weights.select("id", F.posexplode(F.arrays_zip(vector_to_array("hashTokens").alias("n"), vector_to_array("tfIdf").alias("w"))).alias("bucket", "v"))
    return placed.where("v.n > 0").select("id", "bucket", F.round("v.w", 6).alias("tf_idf"))


# the hash of a term has no SQL
catalog.add("hashed_tfidf", _hashed)

catalog.add(
    "term_dictionary",
    lambda spark, sf: D.term_dictionary(documents(spark, sf)),
    lambda: f"WITH {terms_sql()} SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS index FROM df",
)


def _term_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir)
    vectors = D.term_vectors(rows, D.numbered_terms(rows))
    return vectors.withColumn("tf_idf", F.transform("tf_idf", lambda x: F.round(x, 6)))


catalog.add(
    "term_vectors",
    _term_vectors,
    lambda: f"""WITH {terms_sql()}, numbered AS (SELECT *, row_number() OVER (ORDER BY term) - 1 AS index FROM df),
    vectors AS (SELECT id, list(index ORDER BY index) AS indices, list(tf ORDER BY index) AS tf,
                       list(round(tf * ln((m + 1.0) / (df + 1)), 6) ORDER BY index) AS tf_idf
                FROM tf JOIN numbered USING (term), m GROUP BY id)
    SELECT doc_id AS id, coalesce(indices, []) AS indices, coalesce(tf, []) AS tf, coalesce(tf_idf, []) AS tf_idf
    FROM documents LEFT JOIN vectors ON doc_id = id""",
)


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return flags of orders, written in two ways that mean the same."""
    flag = F.when(F.col("l_linestatus") == "F", F.lower("l_returnflag")).otherwise(
        F.concat(F.lit(" "), "l_returnflag", F.lit(" "))
    )
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), flag.alias("flag"))


_FLAGS_SQL = """
    flags AS (SELECT DISTINCT l_orderkey AS id, CASE WHEN l_linestatus = 'F' THEN lower(l_returnflag)
                                                     ELSE ' ' || l_returnflag || ' ' END AS flag FROM lineitem)"""

catalog.add(
    "category_counts",
    lambda spark, sf: X.category_counts(_flags(spark, sf), "flag"),
    f"""WITH {_FLAGS_SQL} SELECT id, count(*) AS "flagCount" FROM flags GROUP BY id""",
)

catalog.add(
    "category_features",
    lambda spark, sf: X.category_features(_flags(spark, sf), "flag"),
    f"WITH {_FLAGS_SQL} SELECT id, lower(trim(flag)) AS category, count(*) AS n FROM flags GROUP BY 1, 2",
)


catalog.add(
    "category_vectors",
    lambda spark, sf: D.category_vectors(_flags(spark, sf), "flag")[0],
    f"""WITH {_FLAGS_SQL},
    entries AS (SELECT id, lower(trim(flag)) AS category, count(*) AS n FROM flags WHERE trim(flag) <> '' GROUP BY 1, 2),
    numbered AS (SELECT category, row_number() OVER (ORDER BY category) - 1 AS index FROM (SELECT DISTINCT category FROM entries)),
    vectors AS (SELECT id, list(index ORDER BY index) AS indices, list(n ORDER BY index) AS n
                FROM entries JOIN numbered USING (category) GROUP BY id)
    SELECT id, "flagCount", coalesce(indices, []) AS indices, coalesce(n, []) AS n
    FROM (SELECT id, count(*) AS "flagCount" FROM flags GROUP BY id) LEFT JOIN vectors USING (id)""",
)
