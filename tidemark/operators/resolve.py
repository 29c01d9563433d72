"""Readable names for link-type ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def names_from_associations(own: DataFrame) -> DataFrame:
    """(type_id, name) read off association names such as ``OWN_TO_OTHER`` or ``OTHER_TO_OWN``.

    ``own`` holds (type_id, name, associations, _ord); of several names for one id the last holds.
    """
    each = own.where(F.coalesce(F.col("name"), F.lit("")) != "").select(
        F.col("type_id").alias("own_id"),
        F.concat(F.upper("name"), F.lit("_TO_")).alias("head"),
        F.concat(F.lit("_TO_"), F.upper("name")).alias("tail"),
        F.col("_ord").alias("_rec"),
        F.posexplode_outer("associations").alias("_at", "a"),
    ).where(F.col("_at").isNotNull())
    ends = each.select(
        "*",
        F.col("a.fromObjectTypeId").alias("source"),
        F.col("a.toObjectTypeId").alias("sink"),
        F.upper("a.name").alias("label"),
    )
    out = (F.col("source") == F.col("own_id")) & F.col("label").startswith(F.col("head"))
    back = (F.col("sink") == F.col("own_id")) & F.col("label").endswith(F.col("tail"))
    after_head = F.expr("substring(label, length(head) + 1)")
    before_tail = F.expr("left(label, length(label) - length(tail))")
    found = ends.select(
        F.when(out, F.col("sink")).when(back, F.col("source")).alias("type_id"),
        F.lower(F.when(out, after_head).when(back, before_tail)).alias("name"),
        F.struct("_rec", "_at").alias("_ord"),
    ).where((F.col("name") != "") & F.col("type_id").isNotNull())
    return found.groupBy("type_id").agg(F.max_by("name", "_ord").alias("name"))


def names_from_schemas(schemas: DataFrame) -> DataFrame:
    """(type_id, name) straight from a list of object schemas, last one per id."""
    named = schemas.where(F.coalesce(F.col("name"), F.lit("")) != "")
    return named.groupBy("type_id").agg(F.max_by(F.lower("name"), "_ord").alias("name"))


def resolve_names(wanted: DataFrame, *sources: DataFrame) -> DataFrame:
    """(type_id, name, resolved) for distinct ids; earlier sources win, the id itself is last."""
    out = wanted.select("type_id").distinct()
    for i, source in enumerate(sources):
        out = out.join(source.select("type_id", F.col("name").alias(f"_n{i}")), "type_id", "left")
    found = F.coalesce(*[F.col(f"_n{i}") for i in range(len(sources))])
    return out.select(
        "type_id",
        F.coalesce(found, F.replace("type_id", F.lit("-"), F.lit("_"))).alias("name"),
        found.isNotNull().alias("resolved"),
    )


def name_coverage(names: DataFrame) -> DataFrame:
    return names.agg(
        F.count_if("resolved").alias("resolved"), F.count(F.lit(1)).alias("wanted")
    )
