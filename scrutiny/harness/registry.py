"""Registry of the queries: a name, the operators it covers, its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from scrutiny.harness.fixtures import Tables, oracle


@dataclass(frozen=True)
class Query:
    name: str
    ids: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


QUERIES: dict[str, Query] = {}


def query(name: str, ids: str, sql: str | None = None):
    """Register a query; ``ids`` are the operators of the survey it exercises."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, tuple(ids.split()), build, oracle(sql) if sql else None)
        return build

    return register
