"""Spelling variants."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from caudal.llm import spelling
from caudal.llm.queries import damaged_words
from tests.llm.frames import LOWER, documents



def distance_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(words, ratio=10):
    near = {w: [v for v in words if distance_one(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    result = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        result.append((w, n, len(near[w]), form[w], words[form[w]] if form[w] else None, root))
    return sorted(result)


def some_words(seed, alphabet, n=150):
    rng = random.Random(seed)
    found = {}
    stems = ["".join(rng.choice(alphabet) for _ in range(rng.randint(7, 14))) for _ in range(12)] + ["ab" * 40, "a" * 66, "a" * 9]
    while len(found) < n:
        w = rng.choice(stems)
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(w) + 1)
            w = w[:i] + rng.choice(alphabet + "-")[: rng.randint(0, 1)] + w[i + rng.randint(0, 1) :]
        if len(w) > 6:
            found[w] = int(10 ** (rng.random() * 5)) + 1
    return found


@pytest.mark.parametrize(("seed", "alphabet", "frequent", "block"), [(1, "ab", 32, 1024), (2, "abcdefg", 1, 7), (3, "aé漢🎈b", 3, 20)])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, seed, alphabet, frequent, block):
    monkeypatch.setattr(spelling, "FREQUENT", frequent)
    monkeypatch.setattr(spelling, "BLOCK", block)
    words = some_words(seed, alphabet)
    frame = spark.createDataFrame(list(words.items()) + [(None, 5)], "word string, n long")
    frame = frame.selectExpr("*", "word AS other", "n AS form", "n AS key", "n AS root")
    got = spelling.spelling_groups(frame).select("word", "n", "n_near", "form", "form_n", "root")
    assert sorted(map(tuple, got.collect())) == plain_groups(words)


def test_any_two_near_words_share_a_list():
    rng = random.Random(9)
    for _ in range(20):
        words = list(some_words(rng.random(), "abc", 60))
        all_ = spelling.Words(words)
        grams, n = np.unique(np.concatenate([all_.grams(q) for q in (3, 4, 5)]), return_counts=True)
        limit = rng.choice([1, 3, 20])
        number, keys = spelling.listed(all_, grams[n > limit], n[n > limit])
        lists = [set(keys[number == i].tolist()) for i in range(len(words))]
        for i, a in enumerate(words):
            for j in range(i):
                assert not distance_one(a, words[j]) or lists[i] & lists[j]


def test_words_are_counted_and_damaged(spark):
    rows = [(i, t) for i, t in enumerate(["Wonderful,wonderful\twonderfuL1été", "ÉCHANTILLON échantillon xabcdefgx", None, "", "short abcdefg×÷Àÿabcd"] * 30)]
    rows += [(None, "wonderful wonderful"), (3, "wonderful")]
    want = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{d}:{run}".encode())
            if d is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += len(run) >= 7
    got = {r["word"]: r["n"] for r in damaged_words(documents(spark, rows)).collect()}
    assert got == {w: n for w, n in want.items() if n >= 2}
    assert any(distance_one(a, b) for a in got for b in got)


def test_no_words_and_short_words(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling.spelling_groups(empty).count() == 0
    assert damaged_words(documents(spark, [])).count() == 0
    with pytest.raises(Exception, match="code points"):
        spelling.spelling_groups(spark.createDataFrame([("abcdef", 2)], "word string, n long"))
    with pytest.raises(ValueError):
        spelling.spelling_groups(empty, ratio=1)
