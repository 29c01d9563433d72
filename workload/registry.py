from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The given tables, by attribute."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Query]:
    """Register a function of the tables under its own name, with the SQL for the same rows."""

    def register(build: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(configure(spark), folder))

        QUERIES[build.__name__] = run
        if sql:
            SQL[build.__name__] = sql
        return run

    return register


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def day(c: str | Column) -> Column:
    """A timestamp's day as text, comparable across engines."""
    return (F.col(c) if isinstance(c, str) else c).cast("date").cast("string")


def iso(c: str) -> Column:
    """UTC timestamp without zone as ISO text."""
    return F.concat(F.replace(text(c), F.lit(" "), F.lit("T")), F.lit("Z"))
