"""Queries over the test inputs, each next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from permitwright.fixtures import Fixtures, with_views
from permitwright.session import tune

Build = Callable[[Fixtures], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return self.build(Fixtures(spark, sf_dir))


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def add(build: Build) -> Build:
        QUERIES[name] = Query(build, with_views(sql) if sql else None)
        return build

    return add
