"""Reading the corpus tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import configure


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")
