"""Additive schema evolution: columns are added, never dropped or retyped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.meta import MetaColumns


def new_columns(target: T.StructType, load: T.StructType) -> list[T.StructField]:
    """Fields the load has and the target lacks; Spark tables ignore case in names."""
    held = {name.lower() for name in target.fieldNames()}
    return [f for f in load.fields if f.name.lower() not in held]


def evolve(target: DataFrame, load: T.StructType) -> DataFrame:
    """The target with the load's extra columns, null in every row."""
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in new_columns(target.schema, load)]
    return target.select("*", *extra)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``df`` known to ``schema`` in its types; values that do not fit become null."""
    known = {f.name.lower(): f.dataType for f in schema.fields}
    return df.select(
        *[
            F.col(f.name).try_cast(known[f.name.lower()]).alias(f.name)
            if known.get(f.name.lower(), f.dataType) != f.dataType
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def stack(target: DataFrame, load: DataFrame) -> DataFrame:
    """Rows of both under the union of their columns."""
    return target.unionByName(load, allowMissingColumns=True)


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def create_table(spark: SparkSession, table: str, columns: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")


def base_columns(meta: MetaColumns = MetaColumns()) -> str:
    """Columns every synchronised table starts from."""
    return (
        f"`{meta.id}` BIGINT, `{meta.modified}` TIMESTAMP,"
        f" `{meta.synced}` TIMESTAMP_NTZ, `{meta.deleted}` BOOLEAN"
    )


def add_columns(spark: SparkSession, table: str, load: T.StructType) -> list[str]:
    """Add the load's new columns to a catalog table; a missing table is left alone."""
    if not spark.catalog.tableExists(table):
        return []
    fields = new_columns(spark.table(table).schema, load)
    if fields:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({ddl})")
    return [f.name for f in fields]
