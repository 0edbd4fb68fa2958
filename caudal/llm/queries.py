"""The operators set on the given tables, beside SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.llm import exact, jaccard, language, lines, mixing, packing, phrases, pii, quality, spelling, substrings, suffixes, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = [
    urls.Rule("com", "/", "allow"),
    urls.Rule("example.com", "/en/", "block"),
    urls.Rule("www.example.com", "/en/", "allow"),
    urls.Rule("net", "/es/", "block"),
    urls.Rule("net", "/fr/", "block"),
]

QUERIES["op1_url_filters"] = lambda spark, sf: urls.judge_urls(table(spark, sf, "pages"), URL_RULES)
SQL["op1_url_filters"] = f"""
WITH rules(rhost, rpath, rverdict) AS (VALUES {", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)}),
rests AS (SELECT row_number() OVER () AS n, page_id,
          CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT n, page_id, regexp_extract(rest, '^[^/?#]*') AS raw,
          regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM rests),
hosts AS (SELECT n, page_id, path, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM parts),
fits AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY length(rhost || rpath) DESC NULLS LAST) AS place
         FROM hosts LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rhost || rpath AS rule, coalesce(rverdict, 'allow') AS verdict FROM fits WHERE place = 1
"""

QUERIES["op10_exact_dedup"] = lambda spark, sf: exact.exact_groups(table(spark, sf, "documents"))
SQL["op10_exact_dedup"] = r"""
WITH norm AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
grouped AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM grouped
"""


QUERIES["op2_line_dedup"] = lambda spark, sf: lines.remove_lines(table(spark, sf, "documents"))


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


QUERIES["op3_best_fit_packing"] = lambda spark, sf: packing.pack(table(spark, sf, "documents"), tokenizer())

QUERIES["op4_pii"] = lambda spark, sf: pii.personal_data(table(spark, sf, "documents"))

QUERIES["op5_substring_dedup"] = lambda spark, sf: substrings.remove_repeats(table(spark, sf, "documents")).select(
    "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
)

QUERIES["op6_suffix_dedup"] = lambda spark, sf: suffixes.remove_repeats(table(spark, sf, "documents")).select(
    "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
)

QUERIES["op7_jaccard_join"] = lambda spark, sf: jaccard.jaccard_components(table(spark, sf, "documents"), 3, 90)

QUERIES["op8_mixing_sources"] = lambda spark, sf: mixing.mix(table(spark, sf, "documents"))
_JOB_SQL = "STRUCT(deadline BIGINT, source VARCHAR, k BIGINT, release BIGINT)"
SQL["op8_mixing_sources"] = f"""
WITH RECURSIVE sizes AS (SELECT coalesce(source, '') AS source, count(*) AS n FROM documents GROUP BY 1),
shares AS (SELECT source, ceil(n / 16.0)::BIGINT AS blocks,
                  greatest(1, round(100 * sqrt(n) / (SELECT sum(sqrt(n)) FROM sizes)))::BIGINT AS share FROM sizes),
parts AS (SELECT period, source, least(share, blocks - period * share) AS b
          FROM (SELECT *, unnest(range((blocks + share - 1) // share)) AS period FROM shares)),
jobs AS (SELECT period, slots, {{'deadline': (k * slots + b - 1) // b, 'source': source, 'k': k,
                                'release': ((k - 1) * slots) // b}}::{_JOB_SQL} AS job
         FROM (SELECT *, unnest(range(1, b + 1)) AS k
               FROM (SELECT *, sum(b) OVER (PARTITION BY period)::BIGINT AS slots FROM parts))),
run(period, slots, t, waiting, job) AS (
  SELECT period, any_value(slots), 0::BIGINT, list(job), NULL::{_JOB_SQL} FROM jobs GROUP BY period
  UNION ALL
  SELECT period, slots, t + 1, list_filter(waiting, lambda j: j <> pick), pick
  FROM (SELECT *, list_sort(list_filter(waiting, lambda j: j.release <= t))[1] AS pick FROM run WHERE t < slots)),
slotted AS (SELECT period, job.source AS source, job.k AS k, period * (SELECT sum(share)::BIGINT FROM shares) + t - 1 AS slot
            FROM run WHERE t > 0),
ranks AS (SELECT doc_id, coalesce(source, '') AS source,
                 row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY md5(doc_id::VARCHAR)) - 1 AS r FROM documents),
blocks AS (SELECT doc_id, source, r, r // 16 AS block, (r // 16) // share AS period, (r // 16) % share + 1 AS k
           FROM ranks JOIN shares USING (source))
SELECT doc_id, source, block, slot, slot * 16 + r % 16 AS place FROM blocks JOIN slotted USING (period, source, k)
"""

QUERIES["op9_quality_rules"] = lambda spark, sf: quality.judge_quality(table(spark, sf, "documents"))

QUERIES["op11_phrases"] = lambda spark, sf: phrases.collocations(table(spark, sf, "documents"))
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
SQL["op11_phrases"] = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
                       unnest(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
grams AS (SELECT lang, w[i:i + k - 1] AS p FROM starts, range(1, 6) AS ks(k) WHERE i + k - 1 <= len(w)),
counted AS (SELECT lang, p, count(*) AS f FROM grams GROUP BY lang, p HAVING count(*) >= 100),
candidates AS (SELECT lang, p, f AS a FROM counted WHERE len(p) >= 2),
inner_ones AS (SELECT lang, p[b:b + m - 1] AS p, max(a) AS longer FROM candidates, range(1, 5) AS bs(b), range(2, 5) AS ms(m)
               WHERE m < len(p) AND b + m - 1 <= len(p) GROUP BY 1, 2),
kept AS (SELECT c.lang, c.p, c.a FROM candidates c LEFT JOIN inner_ones i USING (lang, p) WHERE coalesce(100 * longer, 0) < 100 * a),
cuts AS (SELECT c.lang, c.p, c.a, k, x.f AS l, y.f AS r, n,
                ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
         FROM (SELECT *, unnest(range(1, len(p))) AS k FROM kept) c
         JOIN counted x ON x.lang = c.lang AND x.p = c.p[1:k] JOIN counted y ON y.lang = c.lang AND y.p = c.p[k + 1:]
         JOIN sizes s ON s.lang = c.lang),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS cut FROM cuts),
ranked AS (SELECT *, array_to_string(p, ' ') AS phrase FROM lowest WHERE cut = 1)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked) WHERE rank <= 2000
"""


def damaged_words(docs: DataFrame, length: int = 7, least: int = 2) -> DataFrame:
    """Words with their numbers, after one in 31 runs of letters of a document has lost a code point.

    A row without an id has whole runs.
    """
    runs = spelling.word_counts(docs, rf"[A-Za-z\u00C0-\u00FF]{{{length},}}")
    h = F.crc32(F.concat(F.col("id").cast("string"), F.lit(":"), F.col("word")).cast("binary"))
    at = F.pmod("h", F.length("word").cast("long")).cast("int")
    less = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    words = runs.withColumn("h", h).select(F.when(F.pmod("h", F.lit(31)) == 0, less).otherwise(F.col("word")).alias("word"))
    return words.where(F.length("word") >= length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


QUERIES["op12_spelling_variants"] = lambda spark, sf: spelling.spelling_groups(damaged_words(table(spark, sf, "documents")))
SQL["op12_spelling_variants"] = rf"""
WITH RECURSIVE runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]{{7,}}')), {_LOWER}) AS run FROM documents),
few AS (SELECT doc_id, run, count(*) AS k FROM runs GROUP BY ALL),
steps AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
                 lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
coded AS (SELECT *, flatten(list_transform(string_split(doc_id::VARCHAR || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128
                 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6)::BIGINT, 128 + (unicode(c) & 63)::BIGINT] END)) AS bytes FROM few),
hashed AS (SELECT run, k, xor(list_reduce(list_prepend(4294967295, bytes),
                 lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM coded, steps),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, k FROM hashed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
less AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM words, range(1, 1000) AS places(i) WHERE i <= length(word)),
pairs AS (SELECT a.word, b.word AS other FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
          UNION SELECT a.word, b.word FROM less a JOIN words b ON a.rest = b.word
          UNION SELECT b.word, a.word FROM less a JOIN words b ON a.rest = b.word),
best AS (SELECT p.word, count(*) AS n_near, arg_min(p.other, struct_pack(x := -w.n, y := p.other)) AS form, max(w.n) AS form_n
         FROM pairs p JOIN words w ON w.word = p.other GROUP BY p.word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * w.n THEN form END AS form,
                 CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n FROM words w LEFT JOIN best USING (word)),
ways AS (SELECT word, word AS here, 0 AS steps FROM forms
         UNION ALL SELECT ways.word, forms.form, steps + 1 FROM ways JOIN forms ON forms.word = ways.here WHERE forms.form IS NOT NULL),
ends AS (SELECT word, arg_max(here, steps) AS root FROM ways GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""

QUERIES["op13_language_id"] = lambda spark, sf: language.identify_languages(table(spark, sf, "documents"))
