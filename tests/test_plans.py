"""What the plans must and must not hold, whatever the size of the tables."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from caudal.operators import features as X
from caudal.operators import sessions as S
from caudal.operators import text as T
from caudal.session import materialise, shared_dir

SF_DIR = "/root/testdata/sf0.001"
FITTED = {"lda_em", "lda_online", "lda_em_documents", "lda_online_documents", "kmeans", "lr", "dt", "rf", "nb", "hashed_tfidf"}

OWN = {name for name, query in entry.queries().items() if query.__module__.startswith("caudal.catalog")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(OWN - FITTED))
def test_no_cross_join_no_python_no_global_window(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert bad not in text
    for window in re.finditer(r"\+- Window .*?(Exchange \S+)", text, re.S):
        assert "SinglePartition" not in window.group(1)


def test_hits_of_a_user_are_summed_before_they_are_shuffled(spark):
    hits = spark.read.parquet(f"{SF_DIR}/events.parquet")
    text = plan(S.sessionize(hits, 30, user="user_id", timestamp="ts", event="event_type", amount="value"))
    assert "partial_min" in text[text.index("Window") :], "the window must stand above the sums per minute"


def test_event_filter_reaches_the_scan(spark):
    hits = spark.read.parquet(f"{SF_DIR}/events.parquet")
    text = plan(
        S.funnel(hits, user="user_id", timestamp="ts", event="event_type", events={"R": "view", "P": "click", "C": "purchase"})
    )
    assert "props" not in text and "value" not in re.findall(r"ReadSchema: (\S+)", text)[0]
    assert "EqualTo(event_type,click)" in text or "In(event_type" in text


def test_texts_are_cut_into_terms_once(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    df = X.term_frequency(documents)
    df.collect()
    final = plan(df)
    final = final[: final.index("== Initial Plan ==")]
    assert "Reused" in final or final.count("Generate explode") == 1


def test_counts_are_shuffled_after_a_partial_sum(spark):
    lines = T.to_lines(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    text = plan(T.word_count(lines))
    assert text.count("Exchange") == 1 and "partial_count" in text[text.index("Exchange") :]


def test_checkpoints_go_to_the_named_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert materialise(spark.range(5)).count() == 5
