"""Term and category features of documents: long tables, and vectors for the models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, CountVectorizer, CountVectorizerModel, HashingTF, RegexTokenizer, StopWordsRemover, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal.functions.text import LETTERS, letter_tokens, stop_words


def law_text(laws: DataFrame, sep: str = " ") -> DataFrame:
    """Laws with ``text``: summary and law text put together; missing parts count as empty."""
    whole = F.concat(F.coalesce("summary", F.lit("")), F.lit(sep), F.coalesce("law_text", F.lit("")))
    return laws.withColumn("text", whole)


def terms(documents: DataFrame, text: str = "text", language: str | None = "spanish") -> DataFrame:
    """One row (id, term) per word of letters that is no stop word."""
    tokens = documents.select("id", F.explode(letter_tokens(F.col(text))).alias("term"))
    return tokens if language is None else tokens.where(~F.col("term").isin(stop_words(language)))


def term_frequency(documents: DataFrame, text: str = "text", language: str | None = "spanish", min_df: int = 5) -> DataFrame:
    """(id, term, tf) for the terms that occur in at least ``min_df`` documents."""
    return _in_vocabulary(*_counts(documents, text, language, min_df)).select("id", "term", "tf")


def tf_idf(documents: DataFrame, text: str = "text", language: str | None = "spanish", min_df: int = 5) -> DataFrame:
    """(id, term, tf, idf, tf_idf) with idf = ln((m + 1) / (df + 1)) over the m documents."""
    m = documents.select("id").agg(F.count(F.lit(1)).alias("m")).scalar()
    weighed = _in_vocabulary(*_counts(documents, text, language, min_df)).withColumn(
        "idf", F.log((m + F.lit(1.0)) / (F.col("df") + 1))
    )
    return weighed.select("id", "term", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tf_idf"))


def _counts(documents: DataFrame, text: str, language: str | None, min_df: int) -> tuple[DataFrame, DataFrame]:
    """Terms per document, and documents per term; the second reads the first one's shuffle.

    A term's total is never below the number of its documents, so asking for it drops
    nothing. It makes both plans need the same counts, which lets Spark read the texts once.
    """
    tf = terms(documents, text, language).groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    return tf, df.where((F.col("df") >= min_df) & (F.col("total") >= min_df)).select("term", "df")


def _in_vocabulary(tf: DataFrame, df: DataFrame) -> DataFrame:
    """Join the two on the term. The vocabulary has one row per term, so Spark may send it to
    every task when it measures it to be small, and may split the rows of a very common term
    when it is not: nothing after the join needs them in one place."""
    return tf.join(df, "term")


def tokenizer(text: str, out: str, language: str = "spanish") -> list:
    """ML stages: letters-only words in lower case, without stop words."""
    words = RegexTokenizer(inputCol=text, outputCol=f"{out}Words", pattern=LETTERS.strip("()"), gaps=False)
    kept = StopWordsRemover(inputCol=f"{out}Words", outputCol=out, stopWords=stop_words(language))
    return [words, kept]


def term_vectors(
    documents: DataFrame, text: str = "text", language: str = "spanish", min_df: int = 5, vocabulary: int | None = None
) -> tuple[DataFrame, CountVectorizerModel]:
    """(id, termFrequency) vectors over all terms of at least ``min_df`` documents, and the model with the vocabulary.

    The terms are counted first, so that none is lost to the library's own limit. The vocabulary goes
    through the driver; whoever can't have that names a number of most frequent terms in ``vocabulary``.
    """
    vocabulary = vocabulary or max(1, _counts(documents, text, language, min_df)[1].count())
    tokens = Pipeline(stages=tokenizer(text, "tokens", language)).fit(documents).transform(documents)
    counter = CountVectorizer(inputCol="tokens", outputCol="termFrequency", minDF=min_df, vocabSize=vocabulary)
    model = counter.fit(tokens.select("tokens"))
    return model.transform(tokens.select("id", "tokens")).select("id", "termFrequency"), model


def tf_idf_vectors(vectors: DataFrame) -> DataFrame:
    """Term vectors with a column ``tfIdf`` beside ``termFrequency``."""
    return IDF(inputCol="termFrequency", outputCol="tfIdf").fit(vectors).transform(vectors)


def hashed_tf_idf_stages(text: str = "text", buckets: int = 4096, language: str = "spanish") -> list:
    """ML stages from text to ``tfIdf`` over hashed terms."""
    return [
        *tokenizer(text, "filteredTokens", language),
        HashingTF(inputCol="filteredTokens", outputCol="hashTokens", numFeatures=buckets),
        IDF(inputCol="hashTokens", outputCol="tfIdf"),
    ]


def category_counts(rows: DataFrame, column: str) -> DataFrame:
    """Per id how many distinct values the column has: (id, {column}Count). A null is no value."""
    return rows.groupBy("id").agg(F.count_distinct(column).alias(f"{column}Count"))


def category(value: Column) -> Column:
    return F.lower(F.trim(value))


def category_features(rows: DataFrame, column: str) -> DataFrame:
    """Long form of the category vectors: (id, category, n).

    Values are told apart as they stand and then trimmed and lowercased, so two spellings
    of one category count twice. Empty categories are left out.
    """
    distinct = rows.select("id", F.col(column).alias("value")).distinct()
    return (
        distinct.select("id", category(F.col("value")).alias("category"))
        .where(F.col("category") != "")
        .groupBy("id", "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def category_vectors(rows: DataFrame, column: str, vector: str, count: str | None = None) -> DataFrame:
    """(id, {column}Count, {vector}): the number of distinct values and their count vector."""
    collected = rows.groupBy("id").agg(F.collect_set(column).alias("values"))
    sized = collected.select(
        "id",
        F.size("values").alias(count or f"{column}Count"),
        F.filter(F.transform("values", category), lambda c: c != "").alias("categories"),
    )
    # as many entries as there are categories, as the library's own limit would drop the rarest
    size = max(1, sized.select(F.explode("categories").alias("c")).agg(F.count_distinct("c")).first()[0])
    counter = CountVectorizer(inputCol="categories", outputCol=vector, vocabSize=size)
    return counter.fit(sized.select("categories")).transform(sized).drop("categories")


# The columns of the feature vector, in order.
FEATURES = [
    "partyCount", "partyFeatureVector",
    "districtCount", "districtFeatureVector",
    "congressmanCount", "congressmanFeatureVector",
    "deputyCommissionsCount", "deputyCommissionsFeatureVector",
    "senateCommissionsCount", "senateCommissionsFeatureVector",
    "tfIdf",
]


def labelled(laws: DataFrame, results: DataFrame, result: str = "SANCIONADO", per_id: bool = False) -> DataFrame:
    """The laws with ``outcome`` and ``sanctioned``: 1.0 where the law has the result, else 0.0.

    A law with several results gives a row for each, told apart by ``outcome``, unless
    ``per_id`` asks for one row that is 1.0 when any of them is the result.

    Laws without a result get an outcome of their own first. What is left is an inner
    join, in which Spark can split the results of a law that has very many.
    """
    is_result = F.when(F.col("result") == result, 1.0).otherwise(0.0)
    told = results.select(
        "id", F.concat_ws("/", "chamber", "result", "date").alias("outcome"), is_result.alias("sanctioned")
    )
    if per_id:
        told = told.groupBy("id").agg(F.lit("").alias("outcome"), F.max("sanctioned").alias("sanctioned"))
    untold = (
        laws.select("id")
        .join(results.select("id").distinct(), "id", "left_anti")
        .select("id", F.lit("").alias("outcome"), F.lit(0.0).alias("sanctioned"))
    )
    return laws.join(told.unionByName(untold), "id")


def category_columns(laws: DataFrame, signers: DataFrame, deputy: DataFrame, senate: DataFrame) -> DataFrame:
    """Counts and vectors of the five categories per law.

    A law without a Senate commission has one empty commission: count 1 and an empty
    vector. Laws without a signer or a Chamber commission are left out.
    """
    senate = laws.select("id").join(senate, "id", "left").na.fill({"commission": ""})
    parts = [
        category_vectors(signers, "party", "partyFeatureVector"),
        category_vectors(signers, "district", "districtFeatureVector"),
        category_vectors(signers, "congressman", "congressmanFeatureVector"),
        category_vectors(deputy, "commission", "deputyCommissionsFeatureVector", "deputyCommissionsCount"),
        category_vectors(senate, "commission", "senateCommissionsFeatureVector", "senateCommissionsCount"),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.join(part, "id")
    return whole


def feature_stages(columns: Sequence[str] = tuple(FEATURES)) -> list:
    return [*hashed_tf_idf_stages(), VectorAssembler(inputCols=list(columns), outputCol="featureVector")]


def assemble(
    laws: DataFrame, results: DataFrame, signers: DataFrame, deputy: DataFrame, senate: DataFrame, *, per_id: bool = False
) -> DataFrame:
    """Labelled laws with everything the feature vector needs except the text's own features.

    The results come last: a law is one row until then, and nothing is shuffled by law after.
    """
    described = law_text(laws).select("id", "date", "text").join(
        category_columns(laws, signers, deputy, senate), "id"
    )
    return labelled(described, results, per_id=per_id)


def feature_vectors(assembled: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """(id, outcome, featureVector, sanctioned). The text weights are fitted on all rows, or on ``fit_on``."""
    source = assembled if fit_on is None else fit_on
    model = Pipeline(stages=feature_stages()).fit(source)
    return model.transform(assembled).select("id", "outcome", "featureVector", "sanctioned")
