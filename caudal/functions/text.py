"""Text expressions: trimming, lines, words, letters-only tokens."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character up to and including the space is trimmed.
BLANKS = "".join(chr(code) for code in range(33))

# A wiki link, with or without a text of its own.
WIKI_LINK = r"(\[\[[^\]]+\]\])"

LETTERS = r"(\p{L}+)"


def trim_blanks(text: Column) -> Column:
    """Drop leading and trailing control characters and spaces."""
    return F.btrim(text, F.lit(BLANKS))


def lines(text: Column) -> Column:
    """The lines of a text as an array, as a text-file reader would deliver them.

    ``\\r\\n``, ``\\n`` and ``\\r`` all end a line; one terminator at the very end
    opens no further line, and an empty text has no line.
    """
    unified = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    body = F.regexp_replace(unified, r"\n\z", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n"))


def words(line: Column) -> Column:
    """Non-empty pieces of a line between single spaces."""
    return F.filter(F.split(line, " "), lambda word: word != "")


def token_count(line: Column) -> Column:
    """How many pieces splitting a line on runs of whitespace gives.

    Trailing empty pieces do not count, a leading one does; an empty line counts as
    one piece and a line of whitespace only as none.
    """
    body = F.regexp_replace(line, r"\s+\z", "")
    return (
        F.when(line == "", F.lit(1))
        .when(body == "", F.lit(0))
        .otherwise(F.size(F.split(body, r"\s+")))
    )


def letter_tokens(text: Column) -> Column:
    """Lowercased runs of letters; digits, marks and punctuation separate them."""
    return F.regexp_extract_all(F.lower(text), F.lit(LETTERS), F.lit(1))


def stop_words(language: str = "spanish") -> list[str]:
    """The stop-word list Spark ships for a language."""
    return StopWordsRemover.loadDefaultStopWords(language)
