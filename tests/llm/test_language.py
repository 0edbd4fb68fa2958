"""Language identification."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from caudal.llm import language as L
from caudal.llm.queries import QUERIES
from tests.llm.frames import documents


def plain_grams(text):
    """Grams of a word and its gaps, word by word."""
    cleaned = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    found = Counter()
    for word in cleaned.split():
        padded = f" {word} "
        found.update(word)
        found.update(padded[i : i + 2] for i in range(len(padded) - 1))
        found.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return found


def test_grams_are_those_of_each_word(monkeypatch):
    texts = ["Ab c", None, "", "été\x00x 12 漢字!", "ß-a  b", "a" * 50 + " bc", "İx"]
    number = {}
    for window in (1 << 18, 16):
        monkeypatch.setattr(L, "WINDOW", window)
        got = [Counter() for _ in texts]
        for docs, grams in L.gram_windows(texts):
            for d, g in zip(docs.tolist(), grams.tolist(), strict=True):
                got[d][g] += 1
        for text, own in zip(texts, got, strict=True):
            assert sorted(own.values()) == sorted(plain_grams(text).values()) or window == 16 and len(text) > 40
        number.setdefault("whole", got)
    assert "".join(L.pieces("ab cd " * 40, 16)) == "ab cd " * 40


def test_document_frequencies_count_each_text_once(spark):
    texts = ["aba aba", "ab", "", "zz ab"] * 40 + [None]
    got = L.inverse_frequencies(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5))
    df = Counter()
    for t in texts:
        for _, grams in L.gram_windows([t]):
            df.update(set(grams.tolist()))
    want = np.array([np.log(162 / (df[g] + 1)) + 1 for g in range(L.DIMS)])
    assert np.allclose(got, want)


def test_leader_follows_the_plain_formula():
    rng = np.random.default_rng(3)
    rows = [(int(rng.integers(3)), np.unique(rng.integers(0, 9, 4)), None) for _ in range(50)]
    rows = [(y, g, rng.random(len(g)) * 3) for y, g, _ in rows]
    z, n = np.zeros((9, 3)), np.zeros((9, 3))
    L.follow(z, n, rows)
    pz, pn = [[0.0] * 3 for _ in range(9)], [[0.0] * 3 for _ in range(9)]

    def weight(i, k):
        if abs(pz[i][k]) <= L.L1:
            return 0.0
        sign = 1 if pz[i][k] > 0 else -1
        return -(pz[i][k] - sign * L.L1) / ((L.BETA + pn[i][k] ** 0.5) / L.ALPHA + L.L2)

    for y, grams, values in rows:
        w = {(i, k): weight(i, k) for i in grams.tolist() for k in range(3)}
        scores = [sum(v * w[i, k] for i, v in zip(grams.tolist(), values.tolist(), strict=True)) for k in range(3)]
        total = sum(np.exp(s) for s in scores)
        for i, v in zip(grams.tolist(), values.tolist(), strict=True):
            for k in range(3):
                g = (np.exp(scores[k]) / total - (k == y)) * v
                pz[i][k] += g - ((pn[i][k] + g * g) ** 0.5 - pn[i][k] ** 0.5) / L.ALPHA * w[i, k]
                pn[i][k] += g * g
    assert np.allclose(z, pz) and np.allclose(n, pn)


def test_temperature_makes_probabilities_of_scores():
    rng = np.random.default_rng(4)
    scores = rng.normal(0, 2, (4000, 3))
    labels = np.array([rng.choice(3, p=p) for p in L.softmax(scores)])
    assert abs(L.temperature(scores * 5, labels) - 5) < 0.5
    assert abs(L.temperature(scores / 3, labels) - 1 / 3) < 0.05
    assert L.temperature(np.zeros((0, 2)), np.zeros(0, int)) == 1
    assert L.temperature(np.zeros((4, 1)), np.zeros(4, int)) == 1


def test_held_out_documents_are_told_apart(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op13_language_id"](spark, sf_dir)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert held and np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.95


def test_rows_of_every_kind(spark):
    rng = random.Random(2)
    word = {"xx": "abcd", "yy": "wxyz"}
    rows = [(i, " ".join("".join(rng.choice(word[k]) for _ in range(5)) for _ in range(20)), k, "s") for i, k in enumerate(["xx", "yy", "xx"] * 20)]
    rows += [(100, None, "xx", "s"), (101, "", "yy", "s"), (102, "12 -- 3", None, "s"), (None, "abcd abdc", "zz", "s"), (7, rows[7][1], rows[7][2], "s"), (103, "wxyz " * 90000, None, "s")]
    got = [tuple(r) for r in L.identify_languages(documents(spark, rows)).collect()]
    by_id = {r[0]: r for r in got}
    assert len(got) == len(rows) and by_id[100][2:] == by_id[101][2:] == by_id[102][2:] == ("und", 0.0)
    assert by_id[103][2] == "yy" and by_id[None][1:3] == (False, "xx") and by_id[0][2] == "xx"
    hidden = documents(spark, rows).withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit("never")).otherwise(F.col("lang")))
    assert Counter(got) == Counter(tuple(r) for r in L.identify_languages(hidden.withColumn("source", F.lit(None).cast("string"))).collect())


def test_nothing_to_learn_from(spark):
    assert L.identify_languages(documents(spark, [])).count() == 0
    assert {r["lang_pred"] for r in L.identify_languages(documents(spark, [(1, "abc", None, "s"), (3, "abc", None, "s")])).collect()} == {"und"}
    one = L.identify_languages(documents(spark, [(1, "abc", "en", "s"), (2, "漢", "en", "s"), (3, "abc", "en", "s")])).collect()
    assert {(r["lang_pred"], r["score"]) for r in one} == {("en", 1.0)}
    with pytest.raises(ValueError):
        L.identify_languages(documents(spark, [(i, "a", f"l{i}", "s") for i in range(400)]))
