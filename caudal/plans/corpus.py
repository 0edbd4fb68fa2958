"""Project records or pages to flat tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from caudal.operators.documents import normalise, project_records
from caudal.session import remove, shared_dir
from caudal.sources.readers import read_projects
from caudal.sources.writers import write_parquet

TABLES = ("laws", "signers", "senateCommissions", "deputyCommissions", "results")


def _write_tables(projects: DataFrame, out: str) -> None:
    """Five tables from one pass over the source.

    The records are written once as nested Parquet in the shared folder; each table then
    reads the columns it needs from there instead of parsing every record again. The nested
    copy is removed in the end.
    """
    spark = projects.sparkSession
    staged = f"{shared_dir(spark)}/projects-{uuid4()}"
    try:
        write_parquet(projects, staged)
        for name, table in normalise(spark.read.parquet(staged)).items():
            write_parquet(table, f"{out}/{name}.parquet")
    finally:
        remove(spark, staged)


def run_normalise(spark: SparkSession, json: str, out: str) -> None:
    """Nested project records (JSON Lines) to the five tables below ``out``."""
    _write_tables(read_projects(spark, json), out)


def run_extraction(pages: DataFrame, out: str) -> None:
    """Raw project pages (column ``html``) to the five tables below ``out``."""
    _write_tables(project_records(pages), out)


def flat_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{base}/{name}.parquet") for name in TABLES}
