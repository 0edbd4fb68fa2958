"""Spelling variants by an index of variable-length grams.

Every place of a word begins a gram, which is as short as it can be without being frequent; a dictionary of the
frequent grams says how long that is. A gram depends on its own characters only, so one edit spoils no grams but
those that hold its place. A word's affected-gram bound is the largest number of grams that share a place: of any
such number of grams and one more, one is also in the other word. Each word therefore stands in the lists of so many
of its rarest grams only. What stands on the side of the gram that the edit is not on is equal in both words, and
divides a list. The members of a list that differ by at most one in length are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm import arrays as A
from caudal.llm import parcels as P
from caudal.llm.arrays import U
from caudal.llm.stage import Stage

#: Shortest and longest gram. A word has to be longer than the longest gram, so that an edit spares one of its grams.
SHORTEST, LONGEST = 3, 6
#: A gram is frequent above so many occurrences, and above 1 in DICTIONARY of all of its length: so the dictionary
#: has at most DICTIONARY grams of each length below the longest, whatever the number of words.
FREQUENT, DICTIONARY = 32, 1 << 18
#: A longer list is cut into blocks of about so many words, which meet two by two.
BLOCK = 1024
#: Pairs compared at a time; words beyond LONG code points are compared one by one.
PAIRS, LONG = 1 << 17, 64
_END = np.uint32(0x110000)


def word_counts(docs: DataFrame, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, word) of every match in every text, A-Z lower-cased."""
    found = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(text_col, F.lit(pattern), F.lit(0))).alias("word"))
    return found.withColumn("word", F.translate("word", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


class Words:
    """Code points of words, each followed by end marks, and the fingerprint of the gram of each length at each place."""

    def __init__(self, words: list[str]) -> None:
        texts = [w.encode("utf-32-le") for w in words]
        pad = _END.tobytes() * (LONGEST - 1)
        points = np.frombuffer(b"".join(t + pad for t in texts) or b"", np.uint32)
        self.length = np.array([len(t) // 4 for t in texts], np.int64)
        self.begin = np.cumsum(self.length + LONGEST - 1) - (self.length + LONGEST - 1)
        values = A.mix(points.astype(U) + U(0x9E3779B97F4A7C15))
        self.sums = A.value_sums(values)
        self.word = np.repeat(np.arange(len(words)), self.length)
        self.place = np.arange(len(self.word)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        self.at = self.begin[self.word] + self.place

    def grams(self, q: np.ndarray | int) -> np.ndarray:
        return A.hashes(self.sums, self.at, self.at + q)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = Words(batch["word"].to_pylist())
        for q in range(SHORTEST, LONGEST):
            grams, n = np.unique(words.grams(q), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(grams), q, np.int32)), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], ["q", "gram", "n"]
            )


def gram_dictionary(words: DataFrame, stage: Stage) -> tuple[np.ndarray, np.ndarray]:
    """The frequent grams in order, and how often each stands in the words."""
    counted = stage.put(words.select("word").mapInArrow(_gram_counts, "q int, gram long, n long").groupBy("q", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = counted.groupBy("q").agg(F.sum("n").alias("total"))
    frequent = counted.join(F.broadcast(totals), "q").where((F.col("n") > FREQUENT) & (F.col("n") * DICTIONARY > F.col("total")))
    held = frequent.select("gram", "n").toPandas()
    stage.drop("grams")
    grams, n = held["gram"].to_numpy(np.int64).view(U), held["n"].to_numpy(np.int64)
    order = np.argsort(grams)
    return grams[order], n[order]


def listed(words: Words, frequent: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the word and key of the list for each list that a word stands in."""
    if not len(words.word):
        return np.zeros(0, np.int64), np.zeros(0, U)
    q = np.full(len(words.word), SHORTEST)
    often = np.zeros(len(words.word), np.int64)
    open_ = np.ones(len(words.word), bool)
    for size in range(SHORTEST, LONGEST):
        grams = words.grams(size)
        found = np.minimum(np.searchsorted(frequent, grams), max(len(frequent) - 1, 0))
        open_ &= frequent[found] == grams if len(frequent) else False
        q[open_] = size + 1
        often[open_] = counts[found[open_]] if len(frequent) else 0
    often[q < LONGEST] = 0  # not frequent; of the longest only the count of what they begin with is known
    steps = np.zeros(len(words.sums) + 1, np.int64)
    np.add.at(steps, words.at, 1)
    np.add.at(steps, words.at + q, -1)
    covering = np.cumsum(steps)
    # an edit may also come right behind the last character; places further on hold none
    for k in range(1, LONGEST - 1):
        covering[words.begin + words.length + k] = 0
    bound = np.maximum.reduceat(covering, words.begin)
    order = np.lexsort((words.place, A.mix(words.grams(q)), often, words.word))
    rank = words.place  # ranks are numbered as places are
    kept = order[rank <= bound[words.word]]
    begin, at, end = words.begin[words.word[kept]], words.at[kept], words.at[kept] + q[kept]
    whole = begin + words.length[words.word[kept]]
    left = end <= whole
    keys = [A.hashes(words.sums, begin[left], end[left]) ^ U(1), A.hashes(words.sums, at, whole)]
    # a key is a fact of both words, so which of its characters are the gram belongs to it
    keys = [A.mix(keys[0] + (end - at)[left].astype(U)), A.mix(keys[1] + U(16) * (end - at).astype(U))]
    return np.concatenate([words.word[kept[left]], words.word[kept]]), np.concatenate(keys)


def _entries(frequent: np.ndarray, counts: np.ndarray):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, keys = listed(Words(batch["word"].to_pylist()), frequent, counts)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch["word"].take(pa.array(number))], ["key", "word"])

    return entries


def one_edit(a: str, b: str) -> bool:
    """Whether two words differ by one code point put in, left out or replaced."""
    a, b = sorted((a, b), key=len)
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def near(points: np.ndarray, length: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same for pairs of rows, the second word not being shorter; rows are filled up with end marks."""
    x, y = points[a], points[b]
    differs = x != y
    same = length[a] == length[b]
    ok = same & (np.count_nonzero(differs, axis=1) == 1)
    at = np.flatnonzero(~same)
    if len(at):
        first = np.argmax(differs[at], axis=1)
        shifted = x[at, :-1] != y[at, 1:]
        shifted &= np.arange(shifted.shape[1]) >= first[:, None]
        ok[at] = ~shifted.any(axis=1)
    return ok


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of each cell; rows come in the order of cells."""

    def pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        words = table["word"].to_pylist()
        length = np.array([len(w) for w in words])
        key, low, high, block = (table[c].to_numpy() for c in ("key", "low", "high", "block"))
        order = np.lexsort((length, high, low, key))
        key, low, high, block, length = (x[order] for x in (key, low, high, block, length))
        words = [words[i] for i in order.tolist()]
        short = length <= LONG
        width = int(length[short].max(initial=0)) + 1
        points = np.full((len(words), width), _END, np.uint32)
        text = np.frombuffer("".join(w for w, s in zip(words, short.tolist(), strict=True) if s).encode("utf-32-le"), np.uint32)
        points[(np.arange(width) < length[:, None]) & short[:, None]] = text
        # an edit takes one letter away or adds one, or both
        letters = np.bitwise_or.reduce(np.where(points == _END, U(0), U(1) << (points % 64).astype(U)), axis=1)
        starts = P.groups(key, low, high)
        last = np.repeat(np.append(starts, len(key))[1:], np.diff(np.append(starts, len(key))))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        rows, step = np.arange(len(key)), 0
        while len(rows):
            step += 1
            rows = rows[rows + step < last[rows]]
            rows = rows[length[rows + step] - length[rows] <= 1]
            asked = rows[(low[rows] == high[rows]) | (block[rows] != block[rows + step])]
            for c in range(0, len(asked), PAIRS):
                a = asked[c : c + PAIRS]
                quick = a[short[a + step]]
                quick = quick[np.bitwise_count(letters[quick] ^ letters[quick + step]) <= 2]
                quick = quick[near(points, length, quick, quick + step)]
                slow = [i for i in a[~short[a + step]].tolist() if one_edit(words[i], words[i + step])]
                found += [(quick, quick + step), (np.array(slow, np.int64), np.array(slow, np.int64) + step)]
        if found:
            a, b = (np.concatenate(x) for x in zip(*found, strict=True))
            column = pa.array(words, pa.string())
            yield pa.RecordBatch.from_arrays([column.take(pa.array(a)), column.take(pa.array(b))], ["word", "other"])

    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n < 1 << 18:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        cells = P.groups(*(table[c].to_numpy() for c in ("key", "low", "high")))
        if len(cells) > 1:  # the last cell may go on
            yield from pairs(table.slice(0, int(cells[-1])))
            held = table.slice(int(cells[-1])).to_batches()
            n = sum(b.num_rows for b in held)
    if n:
        yield from pairs(pa.Table.from_batches(held))


def near_pairs(words: DataFrame, stage: Stage) -> DataFrame:
    """(word, other) for every two words that differ by one code point, each way round once."""
    frequent, counts = gram_dictionary(words, stage)
    entries = stage.put(words.select("word").mapInArrow(_entries(frequent, counts), "key long, word string"), "entries")
    sizes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    cells = F.when(F.col("n") <= BLOCK, F.expr("array(struct(0 AS low, 0 AS high, 0 AS block))")).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.ceil(F.col("n") / BLOCK).cast("int") - 1),
            lambda other: F.struct(F.least("own", other).alias("low"), F.greatest("own", other).alias("high"), F.col("own").alias("block")),
        )
    )
    own = F.pmod(F.xxhash64("word"), F.ceil(F.col("n") / BLOCK)).cast("int")
    dealt = entries.join(sizes, "key").withColumn("own", own).select("key", "word", F.inline(cells))
    parts = P.partitions(words)
    dealt = dealt.repartition(parts, "key", "low", "high").sortWithinPartitions("key", "low", "high")
    pairs = dealt.mapInArrow(_compare, "word string, other string").select(F.least("word", "other").alias("word"), F.greatest("word", "other").alias("other"))
    pairs = stage.put(pairs.distinct(), "pairs")
    stage.drop("entries")
    return pairs.union(pairs.select("other", "word"))


def spelling_groups(words: DataFrame, ratio: int = 10) -> DataFrame:
    """Words with the form each is a variant of: word, n, n_near, form, form_n, root.

    ``words`` has a row (word, n) for each distinct word. Words are near if they differ by one code point put in,
    left out or replaced, and ``n_near`` counts a word's near words. Its form is the near word of largest n, the
    smallest in code-point order of equal ones, if that n is at least ``ratio`` times its own, else null; ``root``
    is where forms of forms end, the word itself without one. ``ratio`` is 2 or more, so forms never go in a circle.

    Words of LONGEST code points or fewer end the job with an error, because an edit may spoil all their grams;
    null words are left out; an empty table gives an empty table. Other columns are not read.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    stage = Stage(words.sparkSession)
    short = F.raise_error(F.lit(f"words need more than {LONGEST} code points"))
    words = words.where("word IS NOT NULL").select("word", F.when(F.length("word") > LONGEST, F.col("n")).otherwise(short).alias("n"))
    words = stage.put(words, "words")
    pairs = near_pairs(words, stage)
    others = pairs.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = others.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    )
    often = -F.col("best.less") >= F.col("n") * ratio
    forms = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(often, F.col("best.form")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n")
    )
    forms = stage.put(forms, "forms")
    largest = forms.agg(F.max("n")).first()[0] or 1
    ends = forms.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # n grows by ratio with each step, so a way has at most so many steps; each round goes twice as far
    for turn in range(math.ceil(math.log2(math.log(largest, ratio) + 1)) if largest > 1 else 0):
        ends = ends.join(ends.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        ends = stage.put(ends.select("word", F.coalesce("next", "root").alias("root")), f"roots-{turn}", free=False)
    return forms.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
