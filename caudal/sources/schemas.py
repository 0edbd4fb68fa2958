"""Schemas of the inputs; nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, StringType, StructField, StructType


def _texts(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


PROJECT = StructType(
    [
        StructField("id", StringType()),
        StructField("summary", StringType()),
        StructField("date", StringType()),
        StructField("law_text", StringType()),
        StructField("signers", ArrayType(_texts("congressman", "district", "party"))),
        StructField("dcommissions", ArrayType(StringType())),
        StructField("scommissions", ArrayType(StringType())),
        StructField("results", ArrayType(_texts("chamber", "result", "date"))),
    ]
)

DOWNLOADS = _texts("date", "doi", "ip_code", "country", "city", "coords")

PREFIXES = _texts("prefix", "publisher")
