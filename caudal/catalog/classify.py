"""Classification of ``documents``: good quality in ``labels`` is the result to predict."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.catalog import Catalog, table
from caudal.operators import classify as C
from caudal.operators import features as X
from caudal.operators import stats as S
from caudal.session import materialise

catalog = Catalog()


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The flat tables: source and language stand for signers and commissions."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return {
        "laws": documents.select(
            F.col("doc_id").alias("id"), F.lit(None).cast("string").alias("date"),
            F.col("source").alias("summary"), F.col("text").alias("law_text"),
        ),
        "results": labels.select(
            F.col("doc_id").alias("id"), F.lit("D").alias("chamber"),
            F.when(F.col("quality") == 1, "SANCIONADO").otherwise("RETIRADO").alias("result"),
            F.lit(None).cast("string").alias("date"),
        ),
        "signers": documents.select(
            F.col("doc_id").alias("id"), F.col("source").alias("congressman"), F.col("lang").alias("district"),
            F.concat_ws("-", "lang", "source").alias("party"),
        ),
        "deputy": documents.select(F.col("doc_id").alias("id"), F.col("source").alias("commission")),
        "senate": labels.select(
            F.col("doc_id").alias("id"), F.concat(F.lit("toxic "), F.col("toxic").cast("string")).alias("commission")
        ),
    }


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir)
    return X.labelled(tables["laws"].select("id"), tables["results"])


_ROWS_SQL = """
    rows AS (
      SELECT d.doc_id AS id, CASE WHEN quality = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS sanctioned,
             CASE WHEN quality = 1 THEN 'D/SANCIONADO' WHEN quality = 0 THEN 'D/RETIRADO' ELSE '' END AS outcome
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
    drawn AS (
      SELECT *, ('0x' || left(md5('1/' || id || '/' || outcome), 8))::BIGINT / 4294967296.0 AS first_draw,
                ('0x' || left(md5('2/' || id || '/' || outcome), 8))::BIGINT / 4294967296.0 AS second_draw FROM rows),
    balanced AS (
      SELECT * FROM drawn WHERE sanctioned = 1 OR first_draw < (
        SELECT count(*) FILTER (sanctioned = 1) / count(*) FILTER (sanctioned = 0) FROM rows))"""

catalog.add(
    "balance",
    lambda spark, sf: C.balance(_labelled(spark, sf), "id", "outcome").select("id", "sanctioned"),
    f"WITH {_ROWS_SQL} SELECT id, sanctioned FROM balanced",
)


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = C.split(C.balance(_labelled(spark, sf_dir), "id", "outcome"), "id", "outcome")
    return train.select("id", F.lit("train").alias("part")).unionByName(test.select("id", F.lit("test").alias("part")))


catalog.add(
    "split",
    _split,
    f"WITH {_ROWS_SQL} SELECT id, CASE WHEN second_draw < 0.8 THEN 'train' ELSE 'test' END AS part FROM balanced",
)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.feature_vectors(X.assemble(**_tables(spark, sf_dir)))


def _add_classifier(name: str) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = materialise(C.balance(_features(spark, sf_dir), "id", "outcome"))
        train, test = C.split(rows, "id", "outcome")
        return C.predict(name, train, test)

    catalog.add(name.lower(), query)


for _name in C.MODELS:
    _add_classifier(_name)


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers sign the orders they deliver to."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("congressman")
    )


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    result = F.when(status == "F", "SANCIONADO").when(status == "O", "MEDIA SANCION").otherwise("RETIRADO")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), result.alias("result"))


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.project_counts(_members(spark, sf_dir), _results(spark, sf_dir))


_COUNTS_SQL = """
    members AS (SELECT DISTINCT l_orderkey AS id, 'supplier ' || l_suppkey AS congressman FROM lineitem),
    counts AS (
      SELECT congressman, count(*) AS presented, count(*) FILTER (o_orderstatus = 'F') AS sanctioned,
             count(*) FILTER (o_orderstatus = 'O') AS half_sanctioned
      FROM members LEFT JOIN orders ON id = o_orderkey GROUP BY congressman)"""

catalog.add(
    "project_counts",
    _counts,
    f"WITH {_COUNTS_SQL} SELECT * FROM counts",
)

catalog.add(
    "project_ranking",
    lambda spark, sf: S.project_ranking(_counts(spark, sf)),
    f"WITH {_COUNTS_SQL} "
    + " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{r}' AS ranking, congressman, {r} AS projects FROM counts WHERE {r} > 0"
        f" ORDER BY {r} DESC, congressman LIMIT 10)"
        for r in ("presented", "sanctioned", "half_sanctioned")
    ),
)

def _add_ranking(column: str, value: str, sql: str) -> None:
    """The rankings by another column of the people who sign."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        members = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.expr(value).alias(column))
        return S.project_ranking(S.project_counts(members, _results(spark, sf_dir), column), column)

    ranked = " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{r}' AS ranking, {column}, {r} AS projects FROM counts WHERE {r} > 0 ORDER BY {r} DESC, {column} LIMIT 10)"
        for r in ("presented", "sanctioned", "half_sanctioned")
    )
    catalog.add(
        f"project_ranking_{column}",
        query,
        f"""WITH members AS (SELECT DISTINCT l_orderkey AS id, {sql} AS {column} FROM lineitem),
        counts AS (
          SELECT {column}, count(*) AS presented, count(*) FILTER (o_orderstatus = 'F') AS sanctioned,
                 count(*) FILTER (o_orderstatus = 'O') AS half_sanctioned
          FROM members LEFT JOIN orders ON id = o_orderkey GROUP BY {column})
        {ranked}""",
    )


_add_ranking("party", "concat('party ', string(l_suppkey % 13))", "'party ' || l_suppkey % 13")
_add_ranking("district", "concat('district ', string(l_suppkey % 25))", "'district ' || l_suppkey % 25")
_add_ranking("commission", "concat(l_returnflag, '-', l_linestatus)", "l_returnflag || '-' || l_linestatus")


catalog.add(
    "project_stats",
    lambda spark, sf: S.project_stats(_counts(spark, sf)).select(
        "count", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation"), "least", "median", "most"
    ),
    f"""WITH {_COUNTS_SQL}
    SELECT count(*) AS "count", round(avg(presented), 6) AS mean, round(stddev_samp(presented), 6) AS deviation,
           min(presented)::DOUBLE AS least, median(presented) AS median, max(presented)::DOUBLE AS most FROM counts""",
)
