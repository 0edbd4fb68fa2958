"""Exact deduplication by a 128-bit content hash, with the texts compared inside groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalised(text: str) -> Column:
    """The text with every run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are grouped by their 128-bit hash and, inside it, by their bytes, so that texts which
    share a hash by chance stay apart. A text is sent once by each task that holds it, however many
    copies there are. The smallest id of a group stays; rows that repeat this very id are all marked
    kept. A null id never wins over another; in a group of nulls only, keep_id is null and all are kept.
    Other columns are not carried.
    """
    text = normalised(text_col)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("norm"))
    groups = (
        rows.groupBy(F.md5("norm").alias("hash"), "norm")
        .agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("hash", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    # of texts with one hash, the longer digest tells which bytes a row has
    keyed = rows.select("id", F.md5("norm").alias("hash"), F.sha2("norm", 256).alias("text_sha256"))
    return keyed.join(groups, ["hash", "text_sha256"]).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def keep_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = exact_groups(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("_caudal_keep")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["_caudal_keep"]), "left_semi")
