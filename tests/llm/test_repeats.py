"""Substring and suffix dedup, Jaccard join, line dedup, components, and the pipeline."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from caudal.llm import jaccard, lines, pairs, regions, substrings, suffixes
from caudal.llm.components import connected
from caudal.llm.stage import Stage
from tests.llm.frames import corpus, documents, jaccard_components, quality, union_find, without_lines, words
from tests.llm.test_small_operators import check_pieces

ROWS = corpus(21) + [(200, "a " * 3000), (201, "a" * 5000), (202, "ab" * 700)]


# words


def plain_substrings(rows, window):
    first = {}
    for d, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        own = words(text)
        for i in range(len(own) - window + 1):
            first.setdefault(tuple(own[i : i + window]), d)
    result = []
    for d, text in rows:
        own = words(text)
        gone = [False] * len(own)
        for i in range(len(own) - window + 1):
            if d is not None and first[tuple(own[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        result.append((d, " ".join(w for w, g in zip(own, gone, strict=True) if not g), len(own), sum(gone)))
    return Counter(result)


@pytest.mark.parametrize("window", [13, 4])
def test_repeated_words_go_from_later_documents(spark, window):
    rows = ROWS + [(None, ROWS[12][1]), (9, ROWS[12][1]), ROWS[12]]
    got = substrings.remove_repeats(documents(spark, rows), window)
    assert Counter((r["doc_id"], r["text"], r["n_words"], r["n_removed"]) for r in got.collect()) == plain_substrings(rows, window)
    assert substrings.remove_repeats(documents(spark, [])).count() == 0


# bytes


def plain_bytes(rows, window):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + window] for _, b in texts for i in range(len(b) - window + 1))
    result = []
    for d, b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                gone[i : i + window] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        result.append((d, np.frombuffer(b, np.uint8)[~gone].tobytes(), len(b), int(gone.sum()), runs))
    return Counter(result)


@pytest.mark.parametrize(("window", "choice", "crowd"), [(400, 193, 512), (60, 20, 1), (60, 45, 512), (17, 2, 2)])
def test_repeated_bytes_go(spark, window, choice, crowd):
    rows = ROWS + [(None, ROWS[12][1]), (300, None), ROWS[13]]
    got = suffixes.remove_repeats(documents(spark, rows), window, choice, crowd)
    assert Counter((r["doc_id"], bytes(r["kept"]), r["n_bytes"], r["n_removed"], len(r["spans"])) for r in got.collect()) == plain_bytes(rows, window)


def test_no_document_is_long_enough(spark):
    assert [r["n_removed"] for r in suffixes.remove_repeats(documents(spark, [(1, "short"), (2, "short")])).collect()] == [0, 0]
    assert suffixes.remove_repeats(documents(spark, [])).count() == 0


def test_merged_runs_are_in_order_with_their_common_prefixes():
    rng = random.Random(22)
    for n in (1, 2, 3, 5, 8):
        runs = []
        for sender in range(n):
            own = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 40))]
            runs.append(suffixes.front_code(sorted(suffixes.Suffix(s, b"x", 1, i) for i, s in enumerate(own)), sender))
        merged = list(suffixes.merge_runs(runs))
        strings = [s.after for _, _, s in merged]
        assert strings == sorted(s.after for run in runs for _, s in suffixes.decode(run))
        for before, (shared, _, s) in zip(strings, merged[1:], strict=False):
            plain = next((i for i, (a, b) in enumerate(zip(before, s.after, strict=False)) if a != b), min(len(before), len(s.after)))
            assert shared == plain


# sets


@pytest.mark.parametrize(("k", "percent", "small"), [(3, 90, 8), (5, 80, 256)])
def test_components_of_similar_documents(spark, k, percent, small):
    rng = random.Random(23)
    base = [f"w{rng.randint(0, 400)}" for _ in range(120)]
    family = []
    for i in range(60):  # a crowd of near copies, many of them less alike than asked
        own = list(base)
        for _ in range(rng.randint(0, 12)):
            own[rng.randrange(len(own))] = f"v{rng.randint(0, 300)}"
        family.append((400 + i, " ".join(own)))
    rows = ROWS + family
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(documents(spark, rows), k, percent, small=small).collect()}
    assert got == jaccard_components(rows, k, percent)


def test_sketches_of_similar_sets_are_near():
    rng = np.random.default_rng(32)
    sets = []
    for n in (1, 5, 30, 200, 1500):
        base = rng.integers(0, 2**62, n).astype(np.uint64)
        for _ in range(12):
            own = np.where(rng.random(n) < rng.choice([0.01, 0.05, 0.3]), rng.integers(0, 2**62, n).astype(np.uint64), base)
            sets.append(np.unique(np.concatenate((own, rng.integers(0, 2**62, rng.integers(0, n // 3 + 1)).astype(np.uint64)))))
    sketches = [regions.sketch(x) for x in sets]
    both = [(i, j) for i in range(len(sets)) for j in range(len(sets))]
    near = regions.may_be_similar([sketches[i] for i, _ in both], [sketches[j] for _, j in both], 80)
    alike = far = dropped = 0
    for (i, j), kept in zip(both, near, strict=True):
        common = len(np.intersect1d(sets[i], sets[j]))
        similar = 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common)
        assert kept or not similar
        alike, far, dropped = alike + similar, far + (not common), dropped + (not common and not kept)
    assert alike > 100 and dropped > 0.9 * far
    assert not len(regions.may_be_similar([], [], 80))


def test_texts_of_documents_unlike_their_pivot_are_not_sent(spark, monkeypatch):
    """Documents that share a passage meet in many regions; only sketches tell them apart, not texts."""
    rng = random.Random(33)
    prose = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    passage = prose(120)
    rows = [(i, " ".join(passage + prose(90))) for i in range(50)]
    rows.append((50, rows[7][1] + " more"))
    met, measured = [], []
    put, measure = Stage.put, regions._measure

    def counted_put(self, df, name, free=True):
        out = put(self, df, name, free)
        met.extend([out.count()] * name.startswith("met-"))
        return out

    def counted_measure(these, *others):
        measured.append(these.count())
        return measure(these, *others)

    monkeypatch.setattr(Stage, "put", counted_put)
    monkeypatch.setattr(regions, "_measure", counted_measure)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(documents(spark, rows), 5, 80).collect()}
    assert got == jaccard_components(rows, 5, 80) and got[50][1] == 7
    assert sum(met) > 50 and 1 <= sum(measured) <= sum(met) // 5


def test_sets_leave_large_regions_of_few_common_shingles(spark, monkeypatch):
    rng = random.Random(41)
    prose = lambda n: [f"w{rng.randint(0, 10**6)}" for _ in range(n)]
    passage = prose(20)
    rows = [(i, " ".join(prose(90) + passage + prose(90))) for i in range(120)]
    rows.append((120, rows[7][1] + " more"))
    entries, put = {}, Stage.put

    def counted(self, df, name, free=True):
        out = put(self, df, name, free)
        entries.update({name: out.count()} if name in ("regions", "kept", "met-0") else {})
        return out

    monkeypatch.setattr(Stage, "put", counted)
    found = jaccard.jaccard_components(documents(spark, rows), 5, 80, small=4, frequent=2)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()} == jaccard_components(rows, 5, 80)
    assert entries["regions"] > 300 and entries["met-0"] < entries["regions"] // 4


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_similar_sets_share_as_many_keys_as_are_sure(percent):
    rng = np.random.default_rng(42)
    for _ in range(300):
        x = np.unique(rng.integers(0, 2**62, rng.integers(4, 400))).astype(np.uint64)
        y = np.unique(np.concatenate((rng.permutation(x)[rng.integers(0, 1 + len(x) // 8) :], rng.integers(0, 2**62, rng.integers(0, 1 + len(x) // 8)).astype(np.uint64))))
        common = len(np.intersect1d(x, y))
        if 100 * common < percent * (len(x) + len(y) - common) or np.array_equal(x, y):
            continue
        counts = np.array([len(x), len(y)])
        sure = np.array(jaccard.sure_parts(counts, percent))
        kinds = [{0: set(), 1: set()}, {0: set(), 1: set()}]
        for text, keys in jaccard.part_keys(np.concatenate((x, y)), counts, percent):
            for t, key in zip(text.tolist(), keys.tolist(), strict=True):
                kinds[t][key >> 63].add(key)
        shared = [len(kinds[0][odd] & kinds[1][odd]) for odd in (0, 1)]
        # the class of the smaller set is the one that counts
        begins = jaccard.size_classes(percent, int(counts.max()))
        odd = int(np.searchsorted(begins, counts.min(), "right") - 1) % 2
        assert shared[odd] >= max(sure[odd]) >= 1 and sure[odd][0] == sure[odd][1]


def test_near_copies_in_large_regions_need_no_further_regions(spark, monkeypatch):
    """Some of a crowd of near copies are less alike than asked, so that its regions stay open behind their pivot."""
    rng = random.Random(43)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(150)]
    rows = []
    for i in range(40):
        own = list(base)
        for _ in range(rng.randint(0, 9)):
            own[rng.randrange(len(own))] = f"v{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(own)))
    asked, divide, put, sizes = [], regions._onward, Stage.put, []

    def counted(self, df, name, free=True):
        out = put(self, df, name, free)
        sizes.extend([out.count()] * (name.startswith("left-") and "component" in out.columns))
        return out

    monkeypatch.setattr(Stage, "put", counted)
    monkeypatch.setattr(regions, "_onward", lambda *a: (asked.append(1), divide(*a))[1])
    got = lambda: {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(documents(spark, rows), 5, 80, small=8).collect()}
    want = jaccard_components(rows, 5, 80)
    assert len(set(c for _, c in want.values())) > 1
    assert got() == want and not asked
    assert sum(sizes) < 10 * len(rows)  # its many regions are united
    monkeypatch.setattr(regions, "BLOCKS", 1)
    assert got() == want and asked


def test_difference_prefixes_meet():
    """Two similar sets, one of them unlike the pivot, go on under a common shingle."""
    rng = np.random.default_rng(24)
    for trial in range(4000):
        percent = (60, 80, 90)[trial % 3]
        pivot = np.unique(rng.integers(0, 400, rng.integers(5, 60))).astype(np.uint64)
        change = lambda s, n: np.unique(np.concatenate((rng.permutation(s)[: max(1, len(s) - rng.integers(0, n))], rng.integers(0, 400, rng.integers(0, n)).astype(np.uint64))))
        x = change(pivot, 20)
        y = change(x, 8)
        common = len(np.intersect1d(x, y))
        if 100 * common < percent * (len(x) + len(y) - common) or np.array_equal(x, y):
            continue
        (x_in, x_first), (y_in, y_first) = (jaccard_first(s, pivot, percent) for s in (x, y))
        if not (x_in and y_in) and not np.array_equal(x, pivot) and not np.array_equal(y, pivot):
            assert len(np.intersect1d(x_first, y_first)), (percent, x, y, pivot)


def jaccard_first(own, pivot, percent):
    from caudal.llm.regions import first_differences

    return first_differences(own, pivot, percent)


def test_one_document_of_each_component_stays(spark):
    frame = documents(spark, ROWS + [(None, "a b c d e f"), (None, "a b c d e f")])
    kept = jaccard.keep_one_each(frame)
    want = {c for _, c in jaccard_components(ROWS, 5, 80).values()}
    assert {r["doc_id"] for r in kept.collect()} - {None} == want and kept.columns == frame.columns
    twice = [(5, ROWS[0][1]), *ROWS, (5, "of one id and quite another text than that of the first")]
    assert len({d for d, _ in ROWS} & {5}) < 2
    first = {d for d, (_, c) in jaccard_components(ROWS, 5, 80).items() if d == c}
    got = [r["doc_id"] for r in jaccard.keep_one_each(documents(spark, twice)).collect()]
    assert got.count(5) >= 2 and first - {5} >= set(got) - {5}
    assert jaccard.jaccard_components(documents(spark, [])).count() == 0


# lines


def test_repeated_lines_go(spark):
    got = {r["doc_id"]: r["text"] for r in lines.remove_lines(documents(spark, ROWS)).collect()}
    want = without_lines(ROWS)
    assert got == want
    frame = documents(spark, ROWS)
    whole = lines.without_repeated_lines(frame)
    assert whole.columns == frame.columns
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in whole.collect()} == {d: (t, None if t is None else len(t)) for d, t in want.items()}
    assert lines.remove_lines(documents(spark, [])).count() == 0


def test_band_recall():
    """Lines alike in 80 to 90 % of their shingles share a band nearly always."""
    rng = random.Random(25)
    met = tried = 0
    while tried < 400:
        line = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(20, 400)))
        other = list(line)
        for _ in range(max(1, len(line) // 90)):
            other[rng.randrange(len(other))] = rng.choice("xyz")
        pair = [line, "".join(other)]
        sets = [lines.one_line(x, lines.SHINGLE) for x in pair]
        common = len(np.intersect1d(*sets))
        if common < 0.8 * (len(sets[0]) + len(sets[1]) - common):
            continue
        tried += 1
        sums = lines._sums(lines.code_points(pair))
        starts, ends = np.array([0, len(pair[0]) + 1]), np.array([len(pair[0]), len(sums) - 1])
        keys = [set(), set()]
        for own, found in lines.band_keys(sums, starts, ends, lines.SHINGLE, lines.BANDS, lines.ROWS):
            for n, key in zip(own, found, strict=True):
                keys[n].add(int(key))
        met += bool(keys[0] & keys[1])
    assert met >= 0.97 * tried


@pytest.mark.parametrize("small", [1, 3])
def test_large_regions_of_lines_give_the_same(spark, small):
    got = {r["doc_id"]: r["text"] for r in lines.remove_lines(documents(spark, ROWS), small=small).collect()}
    assert got == without_lines(ROWS)


@pytest.mark.parametrize("small", [1, 4, 10])
def test_any_two_nodes_of_a_region_meet_in_blocks(spark, small):
    sizes = {1: 1, 2: 2, 3: 9, 4: 33}
    nodes = [(r, n, f"{r}-{i}".encode()) for r, n in sizes.items() for i in range(n)]
    got = pairs.in_blocks(spark.createDataFrame(nodes, "region long, n long, node binary"), small).collect()
    blocks = {}
    for r in got:
        blocks.setdefault(r["region"], set()).add(bytes(r["node"]))
    assert sum(map(len, blocks.values())) == len(got) <= sum(n * max(1, -(-n // small) - 1) for n in sizes.values())
    met = {(a, b) for own in blocks.values() for a in own for b in own}
    assert met == {(a, b) for r, _, a in nodes for s, _, b in nodes if r == s}


def test_a_region_of_some_blocks_needs_no_pivots(spark, monkeypatch):
    """Near copies of a line whose edits differ: a pivot leaves most of them open, and sends each to dozens of regions."""
    rng = random.Random(34)
    base = [f"w{rng.randint(0, 10**5)}" for _ in range(40)]
    rows = []
    for i in range(30):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = f"v{rng.randint(0, 10**5)}"
        rows.append((i, " ".join(own)))
    want = without_lines(rows)
    got = lambda: {r["doc_id"]: r["text"] for r in lines.remove_lines(documents(spark, rows), small=4).collect()}
    asked = []
    divide = lines.join_regions
    monkeypatch.setattr(lines, "join_regions", lambda *a: (asked.append(1), divide(*a))[1])
    assert got() == want and not asked
    monkeypatch.setattr(lines, "BLOCKS", 1)
    assert got() == want and asked


def test_links_of_regions_connect_what_all_pairs_connect(spark):
    rng = random.Random(31)
    rows, sets = [], {}
    for region in range(60):
        base = [rng.randrange(10**6) for _ in range(rng.choice([3, 40, 300]))]
        for _ in range(rng.choice([1, 2, 2, 5, 30])):
            own = {x if rng.random() > rng.choice([0.0, 0.05, 0.2]) else rng.randrange(10**6) for x in base}
            node = f"{len(rows):05}".encode()
            rows.append((region, node, " ".join(map(str, sorted(own)))))
            sets[node] = (region, own)

    def numbers(texts):
        own = [np.array(t.split(), np.uint64) for t in texts]
        return np.concatenate(own), np.array([len(x) for x in own])

    frame = spark.createDataFrame(rows, "region long, node binary, shape string").repartition(5)
    links = [(bytes(r["node"]), bytes(r["pivot"])) for r in pairs.linked_pairs(frame, numbers, 80).collect()]
    for a, b in links:
        (r, x), (s, y) = sets[a], sets[b]
        assert r == s and 100 * len(x & y) >= 80 * len(x | y)
    every = [
        (a, b) for a, (r, x) in sets.items() for b, (s, y) in sets.items() if r == s and a < b and 100 * len(x & y) >= 80 * len(x | y)
    ]
    assert len(every) > 100

    def united(edges):
        root = {n: n for n in sets}
        for a, b in edges:
            old, new = root[a], root[b]
            root = {n: new if c == old else c for n, c in root.items()}
        groups = {}
        for n, c in root.items():
            groups.setdefault(c, set()).add(n)
        return sorted(map(sorted, groups.values()))

    assert united(links) == united(every)


def test_pairs_that_the_same_tasks_hold_are_all_found(spark):
    """Both members of many alike pairs are in the same two partitions: no pair stands for another."""
    rng = random.Random(29)
    twins = []
    for _ in range(30):
        own = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(80)]
        twins.append((" ".join(own), " ".join([*own[:-1], "other"])))
    texts = list(enumerate([t for pair in twins for t in pair] * 2))
    frame = spark.createDataFrame(spark.sparkContext.parallelize(texts, 2), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(frame, 3, 90).collect()}
    assert got == jaccard_components(texts, 3, 90)
    assert {r["doc_id"]: r["text"] for r in lines.remove_lines(frame).collect()} == without_lines(texts)


# graphs


def test_connected_components(spark):
    rng = random.Random(26)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)] + [(200 + i, 201 + i) for i in range(60)] + [(300, i) for i in range(301, 340)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in connected(frame, Stage(spark), "graph").collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == union_find(nodes, [(a, b) for a, b in edges if a != b])


# the pipeline


def test_pipeline_is_its_stages_in_plain_loops(spark, tmp_path):
    rows = [(d, t) for d, t in corpus(27, 60)]
    documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    texts = {d: t for d, t in rows if not quality(t)[5]}
    assert len(texts) > 30
    texts = without_lines(sorted(texts.items()))
    groups = jaccard_components(list(texts.items()), 5, 80)
    texts = {d: t for d, t in texts.items() if groups[d][1] == d}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    used, least = check_pieces(got, texts, 1024)
    assert used <= 1.1 * least + 1


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "mixing sources", "best-fit packing"]
    docs = documents(spark, corpus(28)).select("doc_id", "text", "lang", "source", "n_chars")
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, str(tmp_path)).dtypes == docs.dtypes
