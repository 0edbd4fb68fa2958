"""Writers: an existing target is an error unless the caller says otherwise."""

from __future__ import annotations

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, Row


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV without header, one file per partition."""
    df.write.mode(mode).csv(path)


def write_report(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One CSV file. For reports of a few rows only: a single task writes it."""
    df.coalesce(1).write.mode(mode).csv(path)


def save_model(model: MLWritable, path: str) -> None:
    model.write().save(path)


def preview(df: DataFrame, n: int = 10) -> list[Row]:
    """The first rows, on the driver. The number is the caller's and bounds what is fetched."""
    return df.take(n)
