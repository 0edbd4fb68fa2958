"""Numbered terms, and vectors over them, for vocabularies of any size: no term passes the driver."""

from __future__ import annotations

from itertools import accumulate

from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from caudal.functions.entries import distinct_rows, document_frequencies, terms_of_parts, vectors
from caudal.functions.text import stop_words
from caudal.operators import features as X
from caudal.operators.text import tallies
from caudal.session import materialise, ship

_ROW = (1 << 33) - 1
#: Bytes of text that a part has, about; an eighth while there are few parts.
_PART, _FEW = 32 << 20, 256
#: Rows of a partition when they are dealt out by id, and categories that travel with the tasks.
_ROWS, _CARRIED = 1_500_000, 100_000


def number_rows(rows: DataFrame, column: str, name: str = "index") -> DataFrame:
    """The rows with ``name``: 0, 1, 2 and so on in the order of ``column``, which has no value twice.

    Rows are dealt out in ranges of the column and numbered inside each; what comes before a range is added, one number
    a range. They are written first, as ranges are drawn by sampling and both steps must see the same.
    """
    placed = rows.repartitionByRange(column).sortWithinPartitions(column).withColumn("_at", F.monotonically_increasing_id())
    placed = materialise(placed).withColumn("_range", F.shiftright("_at", 33).cast("int"))
    # a number for each range reaches the driver
    sizes = sorted(tuple(r) for r in placed.groupBy("_range").count().collect())
    before = list(zip([r for r, _ in sizes], accumulate([n for _, n in sizes], initial=0), strict=False))
    ranges = rows.sparkSession.createDataFrame(before, "_range int, _before long")
    numbered = placed.join(F.broadcast(ranges), "_range")
    return numbered.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(F.lit(_ROW))).drop("_at", "_range", "_before")


def _dealt(documents: DataFrame, text: str) -> tuple[int, DataFrame]:
    """Number of parts, and the documents as (part, id, words): their letters in lower case, between spaces.

    The number depends on the texts alone, as two jobs must see the same parts. Rows of one id share a part, so terms
    are counted where they are; those without an id are dealt out by their text.
    """
    size = documents.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    n = max(1, min(_FEW, -(-size // (_PART >> 3))), -(-size // _PART))
    ship(documents.sparkSession)
    words = F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\P{L}+", " ")
    part = F.pmod(F.when(F.col("id").isNull(), F.xxhash64(text)).otherwise(F.xxhash64("id")), F.lit(n)).cast("int")
    return n, documents.select(part.alias("part"), "id", words.alias("words"))


def numbered_terms(documents: DataFrame, text: str = "text", language: str | None = "spanish", min_df: int = 5) -> DataFrame:
    """(term, df, index, parts) for the terms of at least ``min_df`` documents, in order of the term.

    Documents are dealt out by id; what leaves a task then is a row per term, not one per term of each document.
    ``parts`` are those that have the term, for ``term_vectors`` of the same documents, text and language.
    """
    n, dealt = _dealt(documents, text)
    local = dealt.repartitionById(n, "part").sortWithinPartitions("part", "id").mapInArrow(
        document_frequencies(stop_words(language) if language else []), "part int, term string, df long, unnamed long"
    )
    counted = local.groupBy("term").agg((F.sum("df") + F.max("unnamed")).alias("df"), F.collect_set("part").alias("parts"))
    return number_rows(counted.where(F.col("df") >= min_df), "term")


def term_dictionary(documents: DataFrame, text: str = "text", language: str | None = "spanish", min_df: int = 5) -> DataFrame:
    """(term, df, index) for the terms of at least ``min_df`` documents, in order of the term."""
    return numbered_terms(documents, text, language, min_df).select("term", "df", "index")


def term_vectors(documents: DataFrame, dictionary: DataFrame, text: str = "text", language: str | None = "spanish") -> DataFrame:
    """(id, indices, tf, tf_idf) for every document, over the terms of ``dictionary``; a document of none has empty arrays.

    The weight of a term is ln((m + 1) / (df + 1)) over the m documents.

    The dictionary comes to the documents: each part is sent the numbers of its own terms, once. So the terms of each
    document, which are many times as large as the texts, are never sent. A dictionary from ``numbered_terms`` knows
    the parts; for another one the parts ask first.
    """
    m = documents.select("id").agg(F.count(F.lit(1)).alias("m")).scalar()
    n, dealt = _dealt(documents, text)
    dropped = stop_words(language) if language else []
    idf = F.log((m + F.lit(1.0)) / (F.col("df") + 1)).alias("idf")
    if "parts" in dictionary.columns:
        named = dictionary.select(F.explode("parts").alias("part"), "term", "index", idf)
    else:
        asked = dealt.repartitionById(n, "part").sortWithinPartitions("part").mapInArrow(terms_of_parts(dropped), "part int, term string")
        named = asked.join(dictionary.select("term", "index", idf), "term")
    kind = documents.schema["id"].dataType
    entries = named.select("part", F.col("term").alias("words"), F.col("index").cast("long").alias("index"), "idf")
    met = dealt.unionByName(entries, allowMissingColumns=True).repartitionById(n, "part").sortWithinPartitions("part", F.col("index").isNull(), "id")
    schema = StructType([StructField("id", kind), *StructType.fromDDL("indices array<long>, tf array<long>, tf_idf array<double>")])
    return met.mapInArrow(vectors(dropped), schema)


def category_vectors(rows: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(id, {column}Count, indices, n) for every id, and the categories (category, index).

    The count is that of distinct values as they stand; ``n`` counts those that become the category when trimmed and
    lower-cased. An empty category has no place in the vectors.

    Rows are shuffled once, by id, and into so many partitions that each has a bounded number of them. Up to a number of
    categories, all of them travel with the tasks.
    """
    values = rows.select("id", F.col(column).alias("value"))
    names = values.select(X.category(F.col("value")).alias("category")).where(F.col("category") != "")
    dictionary = number_rows(names.distinct(), "category")
    known = F.broadcast(dictionary) if dictionary.count() <= _CARRIED else dictionary
    ship(rows.sparkSession)
    dealt = values.mapInArrow(distinct_rows, values.schema).repartition(max(1, -(-rows.count() // _ROWS)), "id")
    sets = dealt.groupBy("id").agg(F.collect_set("value").alias("values"))
    found = F.filter(F.transform("values", X.category), lambda c: c != "")
    counted = sets.select("id", F.size("values").cast("long").alias("count"), F.explode_outer(found).alias("category"))
    placed = counted.join(known, "category", "left").groupBy("id", "count").agg(F.sort_array(F.collect_list("index")).alias("places"))
    placed = placed.withColumn("places", F.when(F.col("id").isNotNull(), F.col("places")).otherwise(F.array().cast("array<long>")))
    vectors = placed.select("id", F.col("count").alias(f"{column}Count"), tallies("places").alias("v"))
    return vectors.select("id", f"{column}Count", F.col("v.word").alias("indices"), F.col("v.n").alias("n")), dictionary


def ml_vectors(vectors: DataFrame, size: int, values: str = "tf", out: str = "termFrequency") -> DataFrame:
    """(id, out): the sparse vectors as the model library takes them. ``size`` is the number of terms."""
    make = F.udf(lambda indices, entries: Vectors.sparse(size, indices, [float(x) for x in entries]), VectorUDT())
    return vectors.select("id", make("indices", values).alias(out))
