"""Registry of the query cases: a plan builder and, where one exists, its ANSI SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


class Tables:
    """The input tables of one run, read lazily by name: `t.orders`, `t.events`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def sql(self, text: str, **args) -> DataFrame:
        """Run SQL text in which `{orders}` and the like stand for the tables."""
        used = {name: getattr(self, name) for name in TABLES if "{" + name + "}" in text}
        return self.spark.sql(text, **used, **args)


@dataclass(frozen=True)
class Case:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


CASES: dict[str, Case] = {}


def case(name: str, sql: str | None = None):
    """Register a plan builder under `name`, with the SQL that must give the same rows."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in CASES:
            raise ValueError(f"query case {name} is registered twice")
        CASES[name] = Case(name, build, sql)
        return build

    return add
