"""The jobs set on the given tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
Sql = str | Callable[[], str]


class Catalog:
    """Named queries and, where SQL can say the same, their SQL, or a function that makes it when it is asked for."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, Sql] = {}

    def add(self, name: str, query: Query, sql: Sql | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"query {name} is already there")
        self.queries[name] = query
        if sql is not None:
            self.sql[name] = sql

    def extend(self, other: "Catalog") -> None:
        for name, query in other.queries.items():
            self.add(name, query, other.sql.get(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
