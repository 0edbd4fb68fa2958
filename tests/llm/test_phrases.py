"""Collocations."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from caudal.llm import phrases
from tests.llm.frames import LOWER, corpus, documents

FIELDS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def plain_collocations(rows, depth, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            own = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(own)
            for k in range(1, depth + 1):
                for i in range(len(own) - k + 1):
                    counts[lang][tuple(own[i : i + k])] += 1
    result = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in candidates.items():
            inside = lambda q: len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: B023, E731
            if any(b >= a and inside(q) for q, b in candidates.items()):
                continue
            cuts = [(1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            result.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(result)


def mixed_rows(seed):
    rng = random.Random(seed)
    rows = [(d, t, rng.choice(["en", "fr", "", None, "und"]), "s") for d, t in corpus(seed)]
    few = ["la", "de", "casa", "é", "x"]
    rows += [(100 + i, " ".join(rng.choice(few) for _ in range(30)) + rng.choice(".,;:!?\n\r\x0b "), "en", "s") for i in range(40)]
    return rows + [(200, "a b a b a b c. A B!a b", "fr", "s"), (200, "a b a b a b c. A B!a b", "fr", "s"), (201, None, None, "s")]


@pytest.mark.parametrize(("seed", "depth", "least", "top"), [(31, 5, 3, 2000), (32, 3, 2, 7), (33, 2, 4, 50)])
def test_collocations_are_those_of_plain_counts(spark, seed, depth, least, top):
    rows = mixed_rows(seed)
    got = phrases.collocations(documents(spark, rows), depth, least, top).collect()
    assert sorted(tuple(r[c] for c in FIELDS) for r in got) == plain_collocations(rows, depth, least, top)


def test_hot_leads_are_routed_by_more_words(spark, monkeypatch):
    rows = [(i, "of the " * 5 + f"w{i % 7} of the", "en", "s") for i in range(60)] + [(99, "of of of the", "en", "s")]
    hot = []
    send = phrases._send
    monkeypatch.setattr(phrases, "_send", lambda depth, buckets, leads: hot.append(len(leads)) or send(depth, buckets, leads))
    got = phrases.collocations(documents(spark, rows), 5, 5, 100).collect()
    assert hot[0] >= 2
    assert sorted(tuple(r[c] for c in FIELDS) for r in got) == plain_collocations(rows, 5, 5, 100)


def test_scores_pass_64_bits(spark):
    frame = spark.createDataFrame([(3_000_000_000, 9_000_000_000_000, 4_000_000_000, 5_000_000_000)], "a long, n long, l long, r long")
    assert frame.select(phrases._score(frame.a, frame.n, frame.l, frame.r)).first()[0] == 1000 * 3 * 9_000 // 20


def test_no_words_no_phrases(spark):
    assert phrases.collocations(documents(spark, [])).count() == 0
    assert phrases.collocations(documents(spark, [(1, None), (2, ""), (3, " .\n")])).count() == 0


def test_long_texts_are_cut_between_pieces():
    text = "é b c. d e\nf" * 50 + " g " * 400 + ". h"
    batch = pa.RecordBatch.from_arrays([pa.array(["fr"]), pa.array([text])], ["lang", "text"])
    parts = [b["text"][0].as_py() for b in phrases.whole_pieces(iter([batch]), 100)]
    assert "".join(parts) == text and len(parts) > 5
    assert all(re.search(r"[.,;:!?\x0A-\x0D]$", p) for p in parts[:-1])


def test_sorted_pointers_count_what_sets_count():
    rng = np.random.default_rng(5)
    wide = rng.integers(1, 4, (400, 4)).astype(np.uint64)
    wide[rng.random(400) < 0.3, 2:] = 0
    weight = rng.integers(1, 5, 400).astype(np.uint32)
    route = np.ones(400, np.uint8)
    route[wide[:, 0] == 1] = 3
    got = {tuple(wide[i, :k].tolist()): n for k, at, count in phrases.multikey_counts(wide, weight, route, 40) for i, n in zip(at, count.tolist(), strict=True)}
    want = Counter()
    for row, w in zip(wide.tolist(), weight.tolist(), strict=True):
        for k in range(2, 5):
            if row[k - 1]:
                want[tuple(row[:k])] += w
    assert got == {p: n for p, n in want.items() if n >= 40 or (p[0] == 1 and len(p) < 3)}
