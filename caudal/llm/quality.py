"""Quality rules: statistics of each text, and robust outliers by the minimum covariance determinant.

DataFrame functions only. The statistics of a text are taken within its row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.llm.stage import Stage

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Share of a group's rows that the estimate rests on, and the concentration steps taken.
SUPPORT, STEPS = 0.75, 4
#: Least standard deviation of each transformed statistic: below it, differences don't count as deviations.
FLOOR = (0.75, 0.08, 0.25, 0.1, 0.05)
#: Square of the robust distance from which on a document is rejected. For five normal statistics
#: 25.7 would be passed by one row in 10,000; texts have heavier tails, so four times that is asked.
CUTOFF = 100.0
#: Median of the chi-square distribution with five degrees of freedom, to which distances are scaled.
MEDIAN = 4.351
#: A group of fewer rows is judged as part of its language, a language of fewer rows as part of the corpus.
MIN_GROUP = 30

_WORD = r"[^\\x20\\x09-\\x0D]"

_REPEATED = """transform(array(words), w -> CASE WHEN size(w) < 6 THEN 0 ELSE
  transform(array(transform(sequence(0, size(w) - 5), i -> xxhash64(w[i], w[i+1], w[i+2], w[i+3], w[i+4]))), k ->
    CASE WHEN size(array_distinct(k)) = size(k) THEN 0 ELSE
      transform(array(array_sort(transform(sequence(0, size(w) - 5), i -> struct(array_join(slice(w, i + 1, 5), ' ') AS t, i AS i)))), s ->
      transform(array(zip_with(s, slice(s, 2, size(s)), (a, b) -> coalesce(a.t = b.t, false))), same ->
      transform(array(array_sort(filter(
        zip_with(s, zip_with(same, concat(array(false), same), (x, y) -> coalesce(x, false) OR y), (a, d) -> CASE WHEN d THEN a.i END),
        p -> p IS NOT NULL))), at ->
      aggregate(zip_with(at, slice(at, 2, size(at)), (a, b) -> coalesce(least(5, b - a), 5)), 0, (n, x) -> n + x)
      )[0])[0])[0]
    END)[0]
  END)[0]"""


def text_statistics(docs: DataFrame, text_col: str = "text", *keep: str) -> DataFrame:
    """The columns named in ``keep`` and the five statistics of each text, as long.

    A null text counts as empty. Hashes of the five-word windows only tell which texts have no
    repeated window; in all others the windows themselves are compared.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*keep, text.alias("_text")).withColumn("words", F.expr(f"regexp_extract_all(_text, '{_WORD}+', 0)"))
    lines = f"transform(array(filter(split(_text, '\\n'), l -> l rlike '{_WORD}')), l -> size(l) - size(array_distinct(l)))[0]"
    return rows.select(
        *keep,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.expr(lines).cast("long").alias("n_dup_lines"),
        F.expr(_REPEATED).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _transformed() -> list[Column]:
    """Length, word length, symbols, repeated words and repeated lines, on scales where spreads are alike."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log1p(F.col("n_words")),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        F.log1p(100 * F.col("n_symbols") / words),
        F.col("n_repeat_words") / words,
        F.log1p(F.col("n_dup_lines")) / F.log1p(words),
    ]


P = len(FLOOR)
_PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]
_KEY = ["_lang", "_source"]


def _moments(rows: DataFrame) -> DataFrame:
    """Mean and covariance of each group, the variances not below their floor."""
    sums = [F.avg(f"x{i}").alias(f"m{i}") for i in range(P)]
    products = [F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}{j}") for i, j in _PAIRS]
    floored = [
        (F.greatest(F.col(f"c{i}{j}"), F.lit(FLOOR[i] ** 2)) if i == j else F.col(f"c{i}{j}")).alias(f"c{i}{j}")
        for i, j in _PAIRS
    ]
    return rows.groupBy(*_KEY).agg(*sums, *products).select(*_KEY, *[f"m{i}" for i in range(P)], *floored)


def _factors(moments: DataFrame) -> DataFrame:
    """Adds the lower triangle of the Cholesky factor, column by column."""
    for j in range(P):
        rest = reduce(lambda a, k: a - F.col(f"l{j}{k}") ** 2, range(j), F.col(f"c{j}{j}"))
        # rounding may leave nothing of a variance that the other statistics explain
        moments = moments.withColumn(f"l{j}{j}", F.sqrt(F.greatest(rest, F.lit(FLOOR[j] ** 2 / 100))))
        for i in range(j + 1, P):
            rest = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"l{j}{k}"), range(j), F.col(f"c{i}{j}"))
            moments = moments.withColumn(f"l{i}{j}", rest / F.col(f"l{j}{j}"))
    return moments.select(*_KEY, *[f"m{i}" for i in range(P)], *[f"l{i}{j}" for i, j in _PAIRS])


def _distances(rows: DataFrame, moments: DataFrame) -> DataFrame:
    """Adds the squared Mahalanobis distance d of each row to its group, by forward substitution."""
    columns = rows.columns
    rows = rows.join(_factors(moments), _KEY)
    for i in range(P):
        rest = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"z{k}"), range(i), F.col(f"x{i}") - F.col(f"m{i}"))
        rows = rows.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    return rows.select(*[c for c in columns if c != "d"], reduce(lambda a, b: a + b, [F.col(f"z{i}") ** 2 for i in range(P)]).alias("d"))


def _bucket() -> Column:
    """Distances in steps of about one hundredth, so that a quantile is found from counts."""
    return F.floor(F.log(F.col("d") + 1e-6) * 100)


def _quantile(rows: DataFrame, share: float, name: str) -> DataFrame:
    """For each group, the least bucket that has ``share`` of its rows at or below it."""
    from pyspark.sql import Window

    counts = rows.groupBy(*_KEY, _bucket().alias("b")).agg(F.count("*").alias("n"))
    group = Window.partitionBy(*_KEY)
    below = F.sum("n").over(group.orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
    return (
        counts.select(*_KEY, "b", below.alias("below"), F.sum("n").over(group).alias("rows"))
        .where(F.col("below") >= share * F.col("rows"))
        .groupBy(*_KEY)
        .agg(F.min("b").alias(name))
    )


def robust_distances(rows: DataFrame, stage: Stage) -> DataFrame:
    """Adds the squared robust distance ``d`` to rows of x0..x4 within groups.

    Deterministic concentration: the start is the mean and covariance of the group's central part by
    distance to its plain estimate; each step keeps the nearest three quarters of the rows and estimates
    anew, which never raises the determinant. Only counts and sums of a group are gathered; they are written,
    a row a group, so that the join with a group's rows is one that Spark can split.
    """
    moments = _moments(rows)
    for step in range(STEPS):
        near = _distances(rows, moments)
        edges = stage.put(_quantile(near, SUPPORT, "edge"), f"edges{step}")
        part = near.join(edges, _KEY).where(_bucket() <= F.col("edge"))
        moments = stage.put(_moments(part), f"moments{step}")  # a row a group
    near = _distances(rows, moments)
    middle = stage.put(_quantile(near, 0.5, "middle"), "middle")
    scale = MEDIAN / F.exp((F.col("middle") + 1) / 100)
    return near.join(middle, _KEY).withColumn("d", F.col("d") * F.least(scale, F.lit(1.0)))


def _pooled(rows: DataFrame, stage: Stage) -> DataFrame:
    """The rows under the names of all groups whose estimate they are part of; ``judged`` in the one that judges them.

    The least of language and source, language, and corpus that has ``MIN_GROUP`` rows judges, or else the corpus.
    A language or the corpus is estimated from all of its rows, where any is judged by it.
    """
    sizes = stage.put(rows.groupBy(*_KEY).agg(F.count("*").alias("n")), "sizes")
    languages = sizes.groupBy("_lang").agg(F.sum("n").alias("of_lang"), F.min("n").alias("least"))
    rare = languages.agg(F.min("of_lang")).first()[0]
    by_corpus = rare is not None and rare < MIN_GROUP
    own, common = F.col("n") >= MIN_GROUP, F.col("of_lang") >= MIN_GROUP
    # names of groups begin with a letter, so that none is another's
    names = [
        F.when(own, F.struct(F.concat(F.lit("g"), "_lang").alias("l"), F.concat(F.lit("g"), "_source").alias("s"), F.lit(True).alias("judged"))),
        F.when(common & (F.col("least") < MIN_GROUP), F.struct(F.concat(F.lit("l"), "_lang").alias("l"), F.lit("").alias("s"), (~own).alias("judged"))),
        F.when(F.lit(by_corpus), F.struct(F.lit("").alias("l"), F.lit("").alias("s"), (~own & ~common).alias("judged"))),
    ]
    groups = sizes.join(languages, "_lang").select(*_KEY, F.filter(F.array(*names), lambda g: g.isNotNull()).alias("_groups"))
    others = [c for c in rows.columns if c not in _KEY]
    spread = rows.join(stage.put(groups, "groups"), _KEY).select(*others, F.explode("_groups").alias("g"))
    return spread.select(*others, F.col("g.l").alias("_lang"), F.col("g.s").alias("_source"), F.col("g.judged").alias("judged"))


def judge_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """One row per document: id, five statistics, base_failed, distance, kept.

    A document goes if it fails the base rules or lies far outside its language and source. Null language
    or source counts as an empty name. An empty text has no words and fails. Groups with fewer than
    ``MIN_GROUP`` documents that pass the rules are judged by the distance to their whole language, or to the
    corpus where that has too few as well. Repeated rows are judged alike. Other columns are not carried.
    """
    stage = Stage(docs.sparkSession)
    named = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(lang_col), F.lit("")).alias("_lang"),
        F.coalesce(F.col(source_col), F.lit("")).alias("_source"),
        F.col(text_col).alias("_body"),
    )
    rows = stage.put(text_statistics(named, "_body", "id", *_KEY).withColumn("base_failed", base_failed()), "statistics")
    passed = rows.where(~F.col("base_failed")).select(
        "id", *_KEY, *STATISTICS, "base_failed", *[x.alias(f"x{i}") for i, x in enumerate(_transformed())]
    )
    near = robust_distances(_pooled(passed, stage), stage)
    judged = near.where("judged").withColumn("kept", F.col("d") <= CUTOFF)
    columns = [F.col("id").alias(id_col), *STATISTICS, "base_failed"]
    failed = rows.where("base_failed").select(*columns, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return judged.select(*columns, F.col("d").alias("distance"), "kept").unionByName(failed)


def keep_quality(docs: DataFrame, id_col: str = "doc_id", **columns: str) -> DataFrame:
    """The documents that are kept, with all their columns. A null id is matched as a value."""
    kept = judge_quality(docs, id_col, **columns).where("kept").select(F.col(id_col).alias("_caudal_kept")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["_caudal_kept"]), "left_semi")
