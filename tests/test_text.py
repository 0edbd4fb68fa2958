import itertools
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from caudal.functions.cells import Cell, Lines, count_cells, pack, pair_sums, send_lines
from caudal.functions.text import stop_words
from caudal.functions.time import epoch_minute
from caudal.operators import text as T
from caudal.sources.readers import read_lines
from caudal.sources.writers import preview
from tests.conftest import rows


def frame(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def test_lines_are_those_of_a_file(spark, tmp_path):
    for text, want in [("a\nb", ["a", "b"]), ("a\r\nb\n", ["a", "b"]), ("\n", [""]), ("", []), ("a\n\n", ["a", ""]), ("a\rb", ["a", "b"])]:
        got = T.to_lines(spark.createDataFrame([(text,)], "text string")).orderBy("line")
        assert [r.value for r in got.collect()] == want, repr(text)
    (tmp_path / "f.txt").write_text("x\n\ny\n")
    assert [r.value for r in read_lines(spark, str(tmp_path / "f.txt")).collect()] == ["x", "", "y"]


def test_characters(spark):
    got = dict(rows(T.char_count(frame(spark, "Hola ULCHO. PLS!!!"))))
    assert got == {".": 1, "U": 1, "!": 3, "a": 1, " ": 2, "L": 2, "l": 1, "P": 1, "C": 1, "H": 2, "O": 1, "o": 1, "S": 1}


def test_words(spark):
    assert rows(T.word_count(frame(spark, "a b  a ", ""))) == [("a", 2), ("b", 1)]


@pytest.mark.parametrize(
    "line, pieces",
    [("a b a", 3), ("", 1), ("  ", 0), (" a", 2), ("a  ", 1), ("a\tb", 2)],
)
def test_raw_word_total_counts_what_splitting_gives(spark, line, pieces):
    assert T.total_words(frame(spark, line)).first()[0] == pieces


def test_word_total(spark):
    lines = frame(spark, "a b a", "")
    assert T.total_words(lines).first()[0] == 4
    assert T.total_words(lines, raw=False).first()[0] == 3


def test_letter(spark):
    assert T.letter_count(frame(spark, "cacao Cc", "x")).first()[0] == 3


def test_top_words(spark):
    lines = frame(spark, "beta beta alpha of of of of", "alpha gamma ")
    assert [tuple(r) for r in T.top_words(lines, k=2).collect()] == [("alpha", 2), ("beta", 2)]


def test_pairs_of_a_line(spark):
    lines = frame(spark, "a b a", "")
    assert rows(T.word_pairs(lines)) == [("a", "a", 3), ("a", "b", 2), ("b", "b", 1)]
    assert rows(T.word_pairs(lines, include_self=False)) == [("a", "a", 1), ("a", "b", 2)]


@pytest.mark.parametrize("include_self", [True, False])
@pytest.mark.parametrize("block", [1, 3, 64])
def test_pairs_match_a_plain_loop_however_long_the_line(spark, include_self, block):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefghij") for _ in range(n)) for n in (1, 2, 7, 150)]
    texts += [texts[2]] * 5
    want = Counter()
    for line in texts:
        ws = line.split(" ")
        for i in range(len(ws)):
            for j in range(i if include_self else i + 1, len(ws)):
                want[tuple(sorted((ws[i], ws[j])))] += 1
    got = rows(T.word_pairs(frame(spark, *texts), include_self=include_self, block=block))
    assert got == sorted((a, b, n) for (a, b), n in want.items())


def test_wiki_links(spark):
    lines = frame(spark, "see [[Link]] and [[self-governance|self-governed]]", "none [x]")
    assert rows(T.find_links(lines)) == [("[[Link]]",), ("[[self-governance|self-governed]]",)]


def test_line_filters(spark):
    lines = frame(spark, "human activity", "human", "activity", "none")
    assert rows(T.keyword_lines(lines, "human", "activity")) == [(2, 2, 1)]
    log = frame(spark, "ERROR x", "config ERROR", "ok")
    found = T.lines_with(log, "ERROR", "config")
    assert rows(found) == [("ERROR x",), ("config ERROR",)]
    assert len(preview(found, 1)) == 1


def test_stop_words_are_those_the_sql_uses(spark):
    from caudal.catalog.features import _spanish_sql

    assert len(stop_words("spanish")) == 313
    assert _spanish_sql() == ", ".join("'" + w + "'" for w in stop_words("spanish"))


def test_filters_reach_the_scan_and_only_needed_columns_are_read(spark):
    lines = T.to_lines(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    plan = T.word_count(lines)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_minutes_before_1970_are_rounded_down(spark):
    times = spark.createDataFrame([("1969-12-31 23:59:30",), ("1970-01-01 00:00:30",), ("no time",)], "t string")
    assert [r[0] for r in times.select(epoch_minute(times, "t")).collect()] == [-1, 0, None]


def test_pairs_of_a_long_line_are_those_of_a_loop(spark):
    rng = random.Random(4)
    lines = [" ".join(f"w{rng.randint(0, 90)}" for _ in range(n)) for n in (1, 3, 40, 300)] * 2
    want = Counter()
    for line in lines:
        words = sorted(line.split())
        want.update((words[i], words[j]) for i in range(len(words)) for j in range(i, len(words)))
    got = {(r["word_a"], r["word_b"]): r["n"] for r in T.word_pairs(frame(spark, *lines), block=16).collect()}
    assert got == dict(want)


def test_words_are_sent_and_not_their_pairs(spark, monkeypatch):
    """Cells of several groups give the same sums, and no pair is shuffled."""
    monkeypatch.setattr(T, "_CELL", 50)
    texts = [" ".join(f"w{(i * j) % 23}" for j in range(i % 9)) for i in range(60)] + ["é a  é b", "", None]
    got = T.word_pairs(frame(spark, *texts))
    want = Counter()
    for text in texts:
        tally = sorted(Counter(w for w in (text or "").split(" ") if w).items())
        for at, (a, n) in enumerate(tally):
            want[a, a] += n * (n + 1) // 2
            for b, m in tally[at + 1 :]:
                want[a, b] += n * m
    assert {(r["word_a"], r["word_b"]): r["n"] for r in got.collect()} == dict(want) and got.count() == len(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "word_a" not in "".join(line for line in plan.splitlines() if "Exchange" in line)


def test_sums_go_on_from_piece_to_piece():
    lines = Lines(np.array([0, 0, 0, 1, 1, 2, 2]), np.array([0, 1, 2, 0, 1, 0, 1]), np.array([1, 2, 1, 1, 1, 3, 1]))
    whole = [tuple(map(np.ndarray.tolist, p)) for p in pair_sums(lines, None, 1 << 20)]
    assert whole == [([0, 0, 1], [1, 2, 2], [6, 1, 2])]
    pieces = [np.concatenate(p).tolist() for p in zip(*pair_sums(lines, None, 1), strict=True)]
    assert pieces == [[0, 0, 1], [1, 2, 2], [6, 1, 2]]


def sent(texts, groups, lines):
    """The rows that cells are sent, so many lines of text at a time."""
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[at : at + lines])], ["value"]) for at in range(0, len(texts), lines)]
    return list(send_lines(groups)(iter(batches)))


@pytest.mark.parametrize(("groups", "lines", "piece"), [(1, 7, 1), (3, 50, 40), (4, 3, 10**6)])
def test_cells_add_up_parcels_range_by_range(groups, lines, piece):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdeé漢zw") * rng.randint(1, 3) for _ in range(rng.randint(0, 25))) for _ in range(90)]
    want = Counter()
    for text in texts:
        ws = sorted(text.split())
        want.update((ws[i], ws[j]) for i in range(len(ws)) for j in range(i, len(ws)))
    got = [r for batch in count_cells(True, piece)(iter(sent(texts, groups, lines))) for r in batch.to_pylist()]
    assert {(r["word_a"], r["word_b"]): r["n"] for r in got} == dict(want) and len(got) == len(want)


def test_a_cell_holds_the_pairs_of_a_range_only():
    """However many parcels a cell has, their lines are unpacked one after another, and pairs made some at a time."""
    rng = np.random.default_rng(8)
    words, parcels = [f"w{i:05}" for i in range(4000)], []
    for _ in range(60):
        keys = np.unique(np.repeat(np.arange(2000), 20) << 32 | rng.integers(0, len(words), 40000))
        parcels.append((pack(Lines(keys >> 32, keys & 0xFFFFFFFF, np.ones(len(keys), np.int64)), words), None))
    cell = Cell(parcels)
    ranges = list(cell.ranges(1 << 18))
    assert ranges[0][0] == 0 and ranges[-1][1] >= 3990 and all(a[1] <= b[0] for a, b in itertools.pairwise(ranges))
    tracemalloc.start()
    total = sum(int(cell.sums(a, b, 1 << 17)[1].sum()) for a, b in ranges[::20])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 60 x 40,000 places of 24 bytes are 58 MB
    assert total > 0 and peak < 40e6
