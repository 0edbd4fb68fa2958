"""Numbered terms and vectors over them."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.clustering import LDA

from caudal.functions import em as M
from caudal.functions import entries as E
from caudal.operators import dictionary as D
from caudal.operators import topics as T
from tests.conftest import rows


def test_rows_are_numbered_in_order(spark):
    words = spark.range(5000).selectExpr("md5(string(id)) AS w", "id AS x").repartition(7)
    got = D.number_rows(words, "w").orderBy("index").collect()
    assert [r["index"] for r in got] == list(range(5000))
    assert [r["w"] for r in got] == sorted(r["w"] for r in got)
    assert D.number_rows(words.limit(0), "w").count() == 0


def test_vectors_of_terms_and_categories(spark):
    docs = spark.createDataFrame([(1, "El Ñandú 12 ñandú, casa"), (2, "casa de campo"), (3, ""), (4, None)], "id int, text string")
    dictionary = D.term_dictionary(docs, min_df=1)
    assert rows(dictionary.select("term", "df", "index")) == [("campo", 1, 0), ("casa", 2, 1), ("ñandú", 1, 2)]
    vectors = D.term_vectors(docs, dictionary)
    assert rows(vectors.select("id", "indices", "tf")) == [(1, [1, 2], [1, 2]), (2, [0, 1], [1, 1]), (3, [], []), (4, [], [])]
    assert vectors.where("id = 1").first()["tf_idf"][1] == pytest.approx(2 * 0.916290731874155)
    ml = {r["id"]: r["termFrequency"] for r in D.ml_vectors(vectors, 3).collect()}
    assert ml[1].toArray().tolist() == [0, 1, 2] and ml[4].numNonzeros() == 0
    values = spark.createDataFrame([(1, "X"), (1, " x"), (1, "X"), (1, "y"), (2, ""), (3, None)], "id int, c string")
    found, categories = D.category_vectors(values, "c")
    assert rows(found) == [(1, 3, [0, 1], [2, 1]), (2, 1, [], []), (3, 0, [], [])]
    assert rows(categories) == [("x", 0), ("y", 1)]


def test_models_over_the_dictionary(spark):
    """What any right result has: weights that add up, terms in falling order, the nearest centre."""
    matters = ["impuesto renta tributo banco", "escuela maestro libro alumno"]
    docs = spark.createDataFrame([(i, f"{matters[i % 2]} comun") for i in range(60)] + [(60, "")], "id int, text string")
    dictionary = D.term_dictionary(docs)
    vectors = D.ml_vectors(D.term_vectors(docs, dictionary), dictionary.count()).cache()
    topics, weights = T.lda_topics(vectors, dictionary, k=2, iterations=10, optimizer="online", terms=4)
    terms = [r["terms"] for r in topics.collect()]
    assert len(terms) == 2 and all(len(t) == 4 for t in terms)
    assert {w for t in terms for w in t} <= set(" ".join(matters).split()) | {"comun"}
    assert all(r["termWeights"] == sorted(r["termWeights"], reverse=True) for r in topics.collect())
    sums = [sum(r["topicDistribution"]) for r in T.as_array(weights).where("id < 60").collect()]
    assert sums == pytest.approx([1.0] * 60)
    clusters, model = T.kmeans_clusters(vectors, k=2)
    by_id = {r["id"]: r["termFrequency"].toArray() for r in vectors.collect()}
    for r in clusters.collect():
        apart = [float(((c - by_id[r["id"]]) ** 2).sum()) for c in model.clusterCenters()]
        assert apart[r["cluster"]] <= min(apart) + 1e-9


def test_terms_are_counted_where_the_documents_are(spark):
    """Terms of documents are not sent: what is dealt out are documents and the numbers of a part's terms."""
    words = ["casa", "Árbol", "libro", "de", "mar", "sol"]
    texts = [(i % 40 if i % 9 else None, " ".join(words[j] for j in range(6) if i >> j & 1) + f", w{i % 3}") for i in range(90)]
    docs = spark.createDataFrame([*texts, (7, None), (None, ""), (99, "12")], "id int, text string").repartition(5)
    bags: dict = {}
    for i, text in [*texts, (7, None), (99, "12")]:
        for t in re.findall(r"[a-zá]+", (text or "").lower()):
            if t != "de":
                bags.setdefault(i, Counter())[t] += 1
    df = Counter(t for bag in bags.values() for t in bag)
    numbers = {t: n for n, t in enumerate(sorted(t for t in df if df[t] >= 2))}
    numbered = D.numbered_terms(docs, min_df=2)
    plain = D.term_dictionary(docs, min_df=2)
    assert rows(plain) == rows(numbered.select("term", "df", "index")) == sorted((t, df[t], n) for t, n in numbers.items())
    want = []
    for i in [i for i, _ in texts] + [7, None, 99]:
        bag = bags.get(i, {}) if i is not None else {}
        at = sorted((numbers[t], n) for t, n in bag.items() if t in numbers)
        want.append((i, [a for a, _ in at], [n for _, n in at]))
    for dictionary in (numbered, plain):
        vectors = D.term_vectors(docs, dictionary)
        assert rows(vectors.select("id", "indices", "tf")) == sorted(want, key=repr)
        shuffles = re.findall(r"hashpartitioning\(([^)]*)\)", vectors._jdf.queryExecution().executedPlan().toString())
        assert not [keys for keys in shuffles if "id#" in keys]


def test_documents_in_pieces_are_counted_whole():
    pieces = [([1, 1, 2], ["a b", "a", "c"]), ([], []), ([2], ["c d"]), ([2, 3, None], ["d", "", "a"]), ([None], ["a"])]
    got = []
    for c in E.counted(((ids, pa.array(words, pa.string())) for ids, words in pieces), ["b"]):
        names = c.terms.to_pylist()
        for at, (i, copies) in enumerate(zip(c.ids, c.copies.tolist(), strict=True)):
            got.append((i, copies, {names[t]: n for d, t, n in zip(c.document, c.term, c.n.tolist(), strict=True) if d == at}))
    assert got == [(1, 2, {"a": 2}), (2, 3, {"c": 2, "d": 2}), (3, 1, {}), (None, 1, {"a": 1}), (None, 1, {"a": 1})]


def test_category_rows_are_shuffled_once(spark, monkeypatch):
    values = [(i % 30 or None, ["X", " x", "y", "", None, "Z"][i % 6]) for i in range(300)] * 2 + [(77, None)]
    data = spark.createDataFrame(values, "id int, c string").repartition(3)
    own: dict = {}
    for i, value in values:
        own.setdefault(i, set()).update([value] if value is not None else [])
    want = []
    for i, distinct in own.items():
        bag = Counter(v.strip().lower() for v in distinct if v.strip()) if i is not None else {}
        at = sorted(({"x": 0, "y": 1, "z": 2}[c], n) for c, n in bag.items())
        want.append((i, len(distinct), [a for a, _ in at], [n for _, n in at]))
    found, _ = D.category_vectors(data, "c")
    assert rows(found) == sorted(want, key=repr)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange (?:hashpartitioning|SinglePartition)", plan.split("Initial Plan")[-1])) == 1
    monkeypatch.setattr(D, "_CARRIED", 0)
    assert rows(D.category_vectors(data, "c")[0]) == sorted(want, key=repr)


def test_topics_by_expectation_maximisation(spark):
    """The rounds give what a plain loop gives, wherever documents lie, and tell matters apart."""
    matters = ["impuesto renta tributo banco", "escuela maestro libro alumno"]
    data = [(i, f"{matters[i % 2]} {matters[i % 2].split()[i % 3]} comun") for i in range(60)] + [(60, ""), (None, "renta")]
    docs = spark.createDataFrame(data, "id int, text string")
    dictionary = D.numbered_terms(docs)
    vectors = D.ml_vectors(D.term_vectors(docs, dictionary), dictionary.count()).cache()
    described, weights = T.em_topics(vectors, 2, 15, 1, 4)
    again, _ = T.em_topics(vectors.repartition(7), 2, 15, 1, 4)
    for a, b in zip(described.collect(), again.collect(), strict=True):
        assert a["termIndices"] == b["termIndices"] and a["termWeights"] == pytest.approx(b["termWeights"])
    names = {r["index"]: r["term"] for r in dictionary.collect()}
    counts = np.array([r[0].toArray() for r in vectors.where("id < 60").select("termFrequency").collect()])
    plain = M.entries(pa.RecordBatch.from_pydict({"indices": [np.flatnonzero(c).tolist() for c in counts], "n": [c[c > 0].tolist() for c in counts]}))
    shares = M.drawn(plain, 60, 2, 1)
    for _ in range(16):
        d, w = np.zeros((60, 2)), np.zeros((counts.shape[1], 2))
        for at, (i, t, n) in enumerate(zip(plain.document, plain.term, plain.n, strict=True)):
            d[i] += n * shares[at]
            w[t] += n * shares[at]
        for at, (i, t) in enumerate(zip(plain.document, plain.term, strict=True)):
            p = (w[t] + 0.1) * (d[i] + 25) / (w.sum(0) + 0.1 * len(w))
            shares[at] = p / p.sum()
    for r in described.collect():
        assert r["termWeights"] == pytest.approx(sorted(w[:, r["topic"]] / w[:, r["topic"]].sum(), reverse=True)[:4])
    found = {r["id"]: r["topicDistribution"].toArray() for r in weights.collect()}
    assert len(found) == 62 and not found[60].any() and not found[None].any()
    assert all(v.sum() == pytest.approx(1) for i, v in found.items() if i is not None and i < 60)
    assert len(names) == 9
    library = LDA(k=2, maxIter=15, optimizer="em", featuresCol="termFrequency", seed=1).fit(vectors.where("id < 60"))
    lam = library.topicsMatrix().toArray()
    own = M.infer(plain, 60, M._expected(lam, 0), 26.0)
    wanted = np.array([r[0].toArray() for r in library.transform(vectors.where("id < 60")).select("topicDistribution").collect()])
    assert np.abs(own - wanted).max() < 1e-3
    assert M.digamma(np.array([1.0, 0.5, 10.0])) == pytest.approx([-0.5772156649, -1.9635100260, 2.2517525891])
