"""Text jobs over lines: counts, rankings, pairs, links and line filters."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.functions.cells import cell_of, count_cells, send_lines
from caudal.functions.text import WIKI_LINK, lines, token_count, trim_blanks, words
from caudal.session import ship

#: Pairs of a cell, about, while there are few cells, and eight times as many later; most groups, as a word is sent once for each.
_CELL, _FEW_CELLS, _GROUPS = 4 << 20, 64, 32


def to_lines(texts: DataFrame, column: str = "text", *keep: str) -> DataFrame:
    """One row per line of each text: the kept columns, ``line`` (from 0) and ``value``."""
    return texts.select(*keep, F.posexplode(lines(F.col(column))).alias("line", "value"))


def char_count(df: DataFrame, column: str = "value") -> DataFrame:
    """Occurrences of each character, case kept, spaces included."""
    return (
        df.select(F.explode(F.split(F.col(column), "")).alias("char"))
        .where(F.col("char") != "")
        .groupBy("char")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def word_count(df: DataFrame, column: str = "value") -> DataFrame:
    """Occurrences of each non-empty word between spaces."""
    return (
        df.select(F.explode(F.split(F.col(column), " ")).alias("word"))
        .where(F.col("word") != "")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def total_words(df: DataFrame, column: str = "value", *, raw: bool = True) -> DataFrame:
    """Number of whitespace-separated words, in one row.

    ``raw`` counts what splitting each line gives, so an empty line counts as one and
    leading whitespace as one more; otherwise only words count.
    """
    per_line = token_count(F.col(column)) if raw else F.regexp_count(F.col(column), F.lit(r"\S+"))
    return df.agg(F.sum(per_line.cast("long")).alias("words"))


def letter_count(df: DataFrame, letter: str = "c", column: str = "value") -> DataFrame:
    """Occurrences of one letter, in one row; lines are measured, not cut into letters."""
    text = F.col(column)
    without = F.replace(text, F.lit(letter), F.lit(""))
    return df.agg(F.sum((F.length(text) - F.length(without)).cast("long")).alias("n"))


def top_words(df: DataFrame, k: int = 10, longer_than: int = 3, column: str = "value") -> DataFrame:
    """The ``k`` most frequent words of more than ``longer_than`` characters; ties in order of the word."""
    counted = (
        df.select(F.explode(F.split(F.col(column), " ")).alias("word"))
        .where((F.length("word") > longer_than) & (F.length(trim_blanks(F.col("word"))) > longer_than))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.orderBy(F.desc("n"), "word").limit(k)


def tallies(words: str) -> Column:
    """Distinct words of a sorted array, or other values, each with how often it stands there."""
    return F.expr(f"""transform(array({words}), w -> transform(array(filter(sequence(0, size(w)),
        i -> i = 0 OR i = size(w) OR w[i] <> w[i - 1])), cuts ->
        zip_with(slice(cuts, 1, size(cuts) - 1), slice(cuts, 2, size(cuts)), (i, j) -> struct(w[i] AS word, bigint(j - i) AS n)))[0])[0]""")


def word_pairs(df: DataFrame, column: str = "value", *, include_self: bool = True, block: int = 64) -> DataFrame:
    """How often two words stand in the same line: (word_a, word_b, n) with word_a <= word_b.

    Every two places of a line count once. ``include_self`` also counts each place with
    itself, which gives a word that stands c times in a line c * (c + 1) / 2 pairs with
    itself instead of c * (c - 1) / 2.

    The result is as large as the pairs are many, and most pairs stand in few lines, so pairs are not shuffled. Words
    are dealt into groups, and each two groups are a cell, which is sent the words that lines have of them and makes
    the pairs, a bounded number at a time. There are so many groups that cells have about so many pairs, and no more
    than about ``block`` different words of a line are of one group; up to a number of groups.
    """
    texts = df.select(F.col(column).alias("value")).where(F.col(column).isNotNull())
    n = F.size(words(F.col("value"))).cast("long")
    pairs, longest = (x or 0 for x in texts.agg(F.sum(F.shiftright(n * (n + 1), 1)), F.max(n)).first())
    cells = max(min(pairs / _CELL, _FEW_CELLS), pairs / (8 * _CELL))
    groups = max(1, min(_GROUPS, max(math.ceil((math.sqrt(8 * cells + 1) - 1) / 2), -(-longest // block))))
    ship(df.sparkSession)
    sent = texts.mapInArrow(send_lines(groups), "cell int, low binary, high binary").repartitionById(cell_of(groups - 1, groups - 1) + 1, "cell")
    return sent.mapInArrow(count_cells(include_self), "word_a string, word_b string, n long")


def find_links(df: DataFrame, column: str = "value", pattern: str = WIKI_LINK, *keep: str) -> DataFrame:
    """Every match of the pattern's first group, ``[[link]]`` and ``[[link|text]]`` by default."""
    return df.select(*keep, F.explode(F.regexp_extract_all(F.col(column), F.lit(pattern), F.lit(1))).alias("link"))


def lines_with(df: DataFrame, *needles: str, column: str = "value") -> DataFrame:
    """Lines that hold any of the texts, found in one pass; a line with several comes once."""
    found = F.lit(False)
    for needle in needles:
        found = found | F.contains(F.col(column), F.lit(needle))
    return df.where(found)


def keyword_lines(df: DataFrame, first: str, second: str, column: str = "value") -> DataFrame:
    """Lines with the first text, with the second, and with both, in one row and one pass."""
    has_first = F.contains(F.col(column), F.lit(first))
    has_second = F.contains(F.col(column), F.lit(second))
    return df.agg(
        F.count_if(has_first).alias("first"),
        F.count_if(has_second).alias("second"),
        F.count_if(has_first & has_second).alias("both"),
    )
