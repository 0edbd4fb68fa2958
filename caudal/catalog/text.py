"""Text jobs on the lines of ``documents`` and ``conversations``, and links of ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.catalog import Catalog, table
from caudal.operators import text as T

catalog = Catalog()


def _lines(spark: SparkSession, sf_dir: str, name: str = "documents", *keep: str) -> DataFrame:
    return T.to_lines(table(spark, sf_dir, name), "text", *keep)


def _lines_sql(name: str = "documents", keep: str = "") -> str:
    return f"""
    unified AS (SELECT {keep} replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS t FROM {name}),
    split AS (
      SELECT {keep} CASE WHEN t = '' THEN [] ELSE string_split(
               CASE WHEN ends_with(t, chr(10)) THEN left(t, length(t) - 1) ELSE t END, chr(10)) END AS ls
      FROM unified),
    lines AS (SELECT {keep} unnest(range(len(ls))) AS line, unnest(ls) AS value FROM split)"""


catalog.add(
    "char_count",
    lambda spark, sf: T.char_count(_lines(spark, sf)),
    f"""WITH {_lines_sql()}, chars AS (SELECT unnest(string_split(value, '')) AS char FROM lines)
    SELECT char, count(*) AS n FROM chars WHERE char <> '' GROUP BY char""",
)

catalog.add(
    "word_count",
    lambda spark, sf: T.word_count(_lines(spark, sf)),
    f"""WITH {_lines_sql()}, words AS (SELECT unnest(string_split(value, ' ')) AS word FROM lines)
    SELECT word, count(*) AS n FROM words WHERE word <> '' GROUP BY word""",
)

catalog.add(
    "total_words",
    lambda spark, sf: T.total_words(_lines(spark, sf)),
    rf"""WITH {_lines_sql()}, bodies AS (SELECT value, regexp_replace(value, '\s+$', '') AS body FROM lines)
    SELECT sum(CASE WHEN value = '' THEN 1 WHEN body = '' THEN 0
                    ELSE len(regexp_split_to_array(body, '\s+')) END)::BIGINT AS words FROM bodies""",
)

catalog.add(
    "letter_c",
    lambda spark, sf: T.letter_count(_lines(spark, sf), "c"),
    f"""WITH {_lines_sql()}
    SELECT sum(len(string_split(value, 'c')) - 1)::BIGINT AS n FROM lines""",
)

catalog.add(
    "top_words",
    lambda spark, sf: T.top_words(_lines(spark, sf)),
    f"""WITH {_lines_sql()}, words AS (SELECT unnest(string_split(value, ' ')) AS word FROM lines)
    SELECT word, count(*) AS n FROM words WHERE length(trim(word)) > 3 GROUP BY word ORDER BY n DESC, word LIMIT 10""",
)

_PAIRS_SQL = """
    words AS (SELECT id, unnest(range(len(ws))) AS place, unnest(ws) AS word
              FROM (SELECT id, list_filter(string_split(value, ' '), lambda w: w <> '') AS ws FROM numbered)),
    tallied AS (SELECT id, word, count(*) AS n FROM words GROUP BY id, word),
    pairs AS (
      SELECT x.word AS word_a, y.word AS word_b,
             CASE WHEN x.word = y.word THEN x.n * (x.n + 1) // 2 ELSE x.n * y.n END AS n
      FROM tallied x JOIN tallied y ON x.id = y.id AND x.word <= y.word)
    SELECT word_a, word_b, sum(n)::BIGINT AS n FROM pairs GROUP BY word_a, word_b"""

catalog.add(
    "cooccurrence",
    lambda spark, sf: T.word_pairs(_lines(spark, sf, "conversations")),
    f"""WITH {_lines_sql("conversations")},
    numbered AS (SELECT row_number() OVER () AS id, value FROM lines), {_PAIRS_SQL}""",
)

catalog.add(
    "cooccurrence_benchmark",
    lambda spark, sf: T.word_pairs(_lines(spark, sf, "benchmark"), block=8),
    f"""WITH {_lines_sql("benchmark")},
    numbered AS (SELECT row_number() OVER () AS id, value FROM lines), {_PAIRS_SQL}""",
)

catalog.add(
    "log_filter",
    lambda spark, sf: T.lines_with(_lines(spark, sf, "documents", "doc_id"), "@", "http"),
    f"""WITH {_lines_sql(keep="doc_id,")}
    SELECT doc_id, line::INTEGER AS line, value FROM lines WHERE contains(value, '@') OR contains(value, 'http')""",
)

catalog.add(
    "keyword_lines",
    lambda spark, sf: T.keyword_lines(_lines(spark, sf), "the", "and"),
    f"""WITH {_lines_sql()}
    SELECT count(*) FILTER (contains(value, 'the')) AS first, count(*) FILTER (contains(value, 'and')) AS second,
           count(*) FILTER (contains(value, 'the') AND contains(value, 'and')) AS both FROM lines""",
)


def _wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with their anchors written as wiki links."""
    wiki = F.regexp_replace("html", r'<a href="([^"]*)">([^<]*)</a>', r"[[$1|$2]]")
    return table(spark, sf_dir, "pages").select("page_id", wiki.alias("value"))


catalog.add(
    "links",
    lambda spark, sf: T.find_links(_wiki_pages(spark, sf), "value", T.WIKI_LINK, "page_id"),
    """WITH anchors AS (
      SELECT page_id, unnest(regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>')) AS a FROM pages)
    SELECT page_id, '[[' || regexp_extract(a, 'href="([^"]*)"', 1) || '|' || regexp_extract(a, '>([^<]*)<', 1) || ']]' AS link
    FROM anchors""",
)

catalog.add(
    "hrefs",
    lambda spark, sf: T.find_links(table(spark, sf, "pages"), "html", 'href="([^"]*)"', "page_id"),
    """SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages""",
)
