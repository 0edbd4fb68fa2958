import math

import pytest
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from caudal.operators import classify as C
from caudal.operators import features as X
from caudal.operators import stats as S
from caudal.operators import topics as T
from caudal.plans import topics as plan
from caudal.plans.classification import run_classification
from caudal.plans.corpus import run_normalise
from caudal.sources.readers import doc_topics_path, read_topic_runs, topics_path
from tests.conftest import rows
from tests.test_documents import write_projects


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("tables")
    run_normalise(spark, write_projects(base / "raw.json"), str(base / "flat"))
    from caudal.plans.corpus import flat_tables

    return flat_tables(spark, str(base / "flat"))


TOPICS = [(0, ["tax", "law"], [0.6, 0.4]), (1, ["school", "book"], [0.6, 0.4]), (2, ["road", "rail"], [0.5, 0.5])]
WEIGHTS = [("A", [0.7, 0.2, 0.1]), ("B", [0.1, 0.5, 0.4]), ("C", [0.5, 0.5, 0.0])]


@pytest.fixture(scope="module")
def topics(spark):
    return spark.createDataFrame(TOPICS, "topic int, terms array<string>, termWeights array<double>")


@pytest.fixture(scope="module")
def weights(spark):
    vectors = spark.createDataFrame([(i, Vectors.dense(w)) for i, w in WEIGHTS], ["id", "topicDistribution"])
    return T.expand_doc_topics(T.as_array(vectors))


def test_expansion(topics, weights):
    assert rows(T.expand_topics(topics))[:2] == [(0, 0, "tax", 0.6), (0, 1, "law", 0.4)]
    assert T.expand_topics(topics).columns == ["topic", "pos", "term", "termWeight"]
    assert weights.columns == ["id", "pos", "topicDistribution"]
    assert weights.count() == 9 and ("B", 1, 0.5) in rows(weights)


def test_topic_rankings(tables, topics, weights):
    reports = plan.topic_reports(tables, topics, weights)
    assert [tuple(r) for r in reports["topTopics"].collect()] == [("tax law", 2), ("school book", 1)]
    assert rows(reports["topSanctionedTopics"]) == [("tax law", 1)]
    assert rows(reports["topHalfSanctionedTopics"]) == [("tax law", 1)]
    assert rows(reports["topRetiredTopics"]) == [("school book", 1)]
    assert rows(reports["topTopicsForTopParties"]) == [("p1", 0, pytest.approx(0.4), "tax law")]
    assert rows(reports["topTopicsForTopDeputyCommissions"])[0][:2] == ("X", 0)
    each = plan.topic_reports(tables, topics, weights, dedupe="group")
    assert rows(each["topTopicsForTopParties"]) == [
        ("p1", 0, pytest.approx(0.4), "tax law"),
        ("p2", 0, pytest.approx(0.7), "tax law"),
    ]


def test_a_group_without_a_name_is_a_group(spark, topics, weights):
    groups = spark.createDataFrame([("A", None), ("B", None), ("C", "p")], "id string, party string")
    assert [r[0] for r in T.top_topic_per_group(weights, groups, topics, "party").collect()] == [None, "p"]


def test_terms_and_weights(spark):
    docs = spark.createDataFrame([(1, "El Ñandú 12 ñandú, casa"), (2, "casa de campo"), (3, "")], "id int, text string")
    assert rows(X.term_frequency(docs, min_df=1)) == [(1, "casa", 1), (1, "ñandú", 2), (2, "campo", 1), (2, "casa", 1)]
    assert rows(X.term_frequency(docs, min_df=2)) == [(1, "casa", 1), (2, "casa", 1)]
    got = {(r.id, r.term): r.tf_idf for r in X.tf_idf(docs, min_df=1).collect()}
    assert got[(1, "ñandú")] == pytest.approx(2 * math.log(4 / 2))
    vectors, model = X.term_vectors(docs, min_df=1)
    assert sorted(model.vocabulary) == ["campo", "casa", "ñandú"]
    weighed = X.tf_idf_vectors(vectors).select("id", vector_to_array("tfIdf").alias("v")).collect()
    by_term = {(r.id, model.vocabulary[i]): x for r in weighed for i, x in enumerate(r.v) if x}
    assert by_term == pytest.approx({k: v for k, v in got.items()})


def test_text_with_missing_parts(spark):
    laws = spark.createDataFrame([("a", None, "t"), ("b", "s", None)], "id string, summary string, law_text string")
    assert rows(X.law_text(laws).select("text")) == [(" t",), ("s ",)]
    assert rows(X.law_text(laws, sep="").select("text")) == [("s",), ("t",)]


def test_category_features(tables, spark):
    described = X.category_columns(
        tables["laws"], tables["signers"], tables["deputyCommissions"], tables["senateCommissions"]
    )
    counts = described.select(
        "id", "partyCount", "districtCount", "congressmanCount", "deputyCommissionsCount", "senateCommissionsCount"
    )
    assert rows(counts) == [("A", 2, 1, 2, 2, 1), ("B", 1, 1, 1, 1, 1)]
    senate = {r.id: r.v for r in described.select("id", vector_to_array("senateCommissionsFeatureVector").alias("v")).collect()}
    assert senate == {"A": [1.0], "B": [0.0]}
    values = spark.createDataFrame([(1, "X"), (1, " x"), (1, "X"), (1, "y"), (2, ""), (2, None)], "id int, c string")
    assert rows(X.category_counts(values, "c")) == [(1, 3), (2, 1)]
    assert rows(X.category_features(values, "c")) == [(1, "x", 2), (1, "y", 1)]


def test_labels(tables):
    labelled = X.labelled(tables["laws"], tables["results"]).select("id", "sanctioned")
    assert rows(labelled) == [("A", 0.0), ("A", 1.0), ("B", 0.0), ("C", 0.0)]
    once = X.labelled(tables["laws"], tables["results"], per_id=True).select("id", "sanctioned")
    assert rows(once) == [("A", 1.0), ("B", 0.0), ("C", 0.0)]


def test_feature_vectors(tables):
    args = (tables[n] for n in ("laws", "results", "signers", "deputyCommissions", "senateCommissions"))
    got = X.feature_vectors(X.assemble(*args)).collect()
    assert sorted((r.id, r.sanctioned) for r in got) == [("A", 0.0), ("A", 1.0), ("B", 0.0)]
    assert {r.featureVector.size for r in got} == {5 + 2 + 1 + 2 + 2 + 1 + 4096}


def test_balance_and_split_do_not_depend_on_partitions(spark):
    data = spark.range(4000).select("id", (F.col("id") % 5 == 0).cast("double").alias("sanctioned"))
    one, many = (C.balance(data.repartition(n), "id") for n in (1, 13))
    assert rows(one) == rows(many)
    positives, negatives = one.where("sanctioned = 1").count(), one.where("sanctioned = 0").count()
    assert positives == 800 and 700 < negatives < 900
    train, test = C.split(one, "id")
    assert train.count() + test.count() == one.count() and train.join(test, "id").count() == 0
    assert 0.75 < train.count() / one.count() < 0.85
    assert rows(C.balance(data, "id", seed=9)) != rows(one)


def test_rankings_and_statistics(spark, tables):
    counts = S.project_counts(tables["signers"], tables["results"])
    assert rows(counts) == [("c1", 2, 1, 1), ("c2", 1, 1, 1)]
    assert rows(S.project_ranking(counts, k=1)) == [("half_sanctioned", "c1", 1), ("presented", "c1", 2), ("sanctioned", "c1", 1)]
    (stats,) = S.project_stats(counts).collect()
    assert (stats["count"], stats["mean"], stats["least"], stats["median"], stats["most"]) == (2, 1.5, 1.0, 1.5, 2.0)
    assert stats["deviation"] == pytest.approx(math.sqrt(0.5))
    assert S.project_stats(counts.limit(1)).first()["deviation"] is None
    parties = S.project_counts(tables["signers"], tables["results"], "party")
    assert rows(parties) == [("p1", 2, 1, 1), ("p2", 1, 1, 1)]


def _laws(spark, n=60):
    """Laws about two matters, told apart by their words."""
    matters = ["impuesto renta tributo banco", "escuela maestro libro alumno"]
    data = [(str(i), "2014-01-01", f"resumen {matters[i % 2]}", f"{matters[i % 2]} texto comun") for i in range(n)]
    return spark.createDataFrame(data, "id string, date string, summary string, law_text string")


def test_topic_models_from_files_to_reports(spark, tmp_path):
    laws = _laws(spark)
    base = str(tmp_path)
    laws.write.parquet(f"{base}/flat/laws.parquet")
    laws.createOrReplaceTempView("laws")
    for name, columns in [
        ("signers", "id, concat('c', id) congressman, 'd' district, if(id % 2 = 0, 'even', 'odd') party"),
        ("deputyCommissions", "id, 'X' commission"),
        ("senateCommissions", "id, 'Y' commission"),
        ("results", "id, 'D' chamber, if(id % 3 = 0, 'SANCIONADO', 'RETIRADO') result, '2014-02-02' date"),
    ]:
        spark.sql(f"SELECT {columns} FROM laws").write.parquet(f"{base}/flat/{name}.parquet")
    plan.run_topic_models(spark, f"{base}/flat/laws.parquet", f"{base}/lda", [2, 3], ("em", "online"), iterations=5)
    topics, doc_topics = read_topic_runs(spark, f"{base}/lda", [2, 3])
    assert topics.groupBy("k", "optimizer").count().count() == 4
    assert topics.where("k = 2 and optimizer = 'em'").count() == 2
    sums = T.as_array(doc_topics).select(F.aggregate("topicDistribution", F.lit(0.0), lambda a, x: a + x).alias("s"))
    low, high = sums.agg(F.min("s"), F.max("s")).first()
    assert low == pytest.approx(1) and high == pytest.approx(1)

    plan.run_expansion(spark, f"{base}/lda", f"{base}/long", [2, 3])
    long = spark.read.parquet(f"{base}/long/topics_expanded.parquet")
    assert set(long.columns) == {"topic", "pos", "term", "termWeight", "k", "optimizer"}
    weights = spark.read.parquet(f"{base}/long/laws_expanded.parquet").where("k = 2 and optimizer = 'online'")
    assert weights.count() == 120
    weights.select("id", "pos", "topicDistribution").write.parquet(f"{base}/weights.parquet")
    plan.run_topic_reports(
        spark, f"{base}/flat", topics_path(f"{base}/lda", 2, "online"), f"{base}/weights.parquet", f"{base}/reports"
    )
    report = spark.read.csv(f"{base}/reports/topTopicsForTopParties.csv")
    assert {r[0] for r in report.collect()} == {"even", "odd"}
    assert len(list((tmp_path / "reports" / "topTopics.csv").glob("part-*"))) == 1
    assert spark.read.parquet(doc_topics_path(f"{base}/lda", 3, "em")).count() == 60


def test_clusters(spark, tmp_path):
    base = str(tmp_path)
    _laws(spark).write.parquet(f"{base}/laws.parquet")
    plan.run_clustering(spark, f"{base}/laws.parquet", base, k=2)
    clusters = spark.read.parquet(f"{base}/laws_kmeans_2.parquet")
    pure = clusters.groupBy((F.col("id").cast("int") % 2).alias("matter")).agg(F.count_distinct("cluster").alias("n"))
    assert clusters.count() == 60 and [r.n for r in pure.collect()] == [1, 1]
    assert len(KMeansModel.load(f"{base}/kmeans_2.model").clusterCenters()) == 2


@pytest.mark.parametrize("fit_on", ["all", "train"])
def test_classification(spark, tmp_path, fit_on):
    base = str(tmp_path)
    laws = _laws(spark, 200)
    laws.write.parquet(f"{base}/laws.parquet")
    laws.createOrReplaceTempView("laws")
    for name, columns in [
        ("signers", "id, concat('c', id % 7) congressman, 'd' district, concat('p', id % 3) party"),
        ("deputyCommissions", "id, concat('X', id % 4) commission"),
        ("results", "id, 'D' chamber, if(id % 2 = 0, 'SANCIONADO', 'RETIRADO') result, '2014-02-02' date"),
    ]:
        spark.sql(f"SELECT {columns} FROM laws").write.parquet(f"{base}/{name}.parquet")
    spark.sql("SELECT id, 'Z' commission FROM laws WHERE id % 5 = 0").write.parquet(f"{base}/senateCommissions.parquet")
    run_classification(spark, base, f"{base}/out", fit_on=fit_on)
    for name in C.MODELS:
        got = spark.read.schema("sanctioned double, prediction double").csv(f"{base}/out/{name}results.csv")
        right = got.where("sanctioned = prediction").count()
        assert 20 < got.count() < 60 and right / got.count() > 0.9, name


def test_unknown_classifier():
    with pytest.raises(ValueError):
        C.classifier("SVM")


def test_terms_outside_the_vocabulary_are_skipped(spark):
    described = spark.createDataFrame([(0, [2, 9, 0], [0.5, 0.3, 0.2])], "topic int, termIndices array<int>, termWeights array<double>")
    assert rows(T.name_terms(described, ["a", "b", "c"])) == [(0, ["c", "a"], [0.5, 0.3, 0.2])]
