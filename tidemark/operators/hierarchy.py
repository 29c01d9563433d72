"""Two-level pipeline -> stage trees, and property names that embed stage ids."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import parse_instant
from tidemark.meta import STAGE_PREFIXES, MetaColumns
from tidemark.operators.records import at
from tidemark.session import collect_catalog


def _node(prefix: str, default_order: int) -> list[Column]:
    def field(name: str) -> Column:
        return F.col(f"{prefix}{name}")

    return [
        field("label").alias("label"),
        F.coalesce(field("displayOrder"), F.lit(default_order)).alias("display_order"),
        parse_instant(field("createdAt")).alias("created_at"),
        parse_instant(field("updatedAt")).alias("updated_at"),
        F.coalesce(field("archived"), F.lit(False)).alias("archived"),
    ]


def _stamped(df: DataFrame, mark: datetime, meta: MetaColumns) -> DataFrame:
    return df.select("*", F.col("archived").alias(meta.deleted), at(mark).alias(meta.synced))


def flatten_pipelines(
    trees: DataFrame, mark: datetime, meta: MetaColumns = MetaColumns()
) -> DataFrame:
    flat = trees.select(F.col("id").alias("pipeline_id"), *_node("", 1))
    return _stamped(flat, mark, meta)


def flatten_stages(
    trees: DataFrame, mark: datetime, meta: MetaColumns = MetaColumns()
) -> DataFrame:
    each = trees.select(F.col("id").alias("pipeline_id"), F.explode_outer("stages").alias("s"))
    each = each.where(F.col("s").isNotNull())
    blank = F.lit("")
    state = F.coalesce(
        F.nullif(F.col("s.metadata.state"), blank), F.nullif(F.col("s.metadata.leadState"), blank)
    )
    flat = each.select(
        F.col("s.id").alias("stage_id"), "pipeline_id", *_node("s.", 0), state.alias("state")
    )
    return _stamped(flat, mark, meta)


def orphan_stages(stages: DataFrame, pipelines: DataFrame) -> DataFrame:
    """Stages whose pipeline is not there."""
    return stages.join(pipelines.select("pipeline_id"), "pipeline_id", "left_anti")


def repeated_stages(stages: DataFrame) -> DataFrame:
    """(pipeline, stage) pairs that occur more than once."""
    counted = stages.groupBy("pipeline_id", "stage_id").agg(F.count(F.lit(1)).alias("rows"))
    return counted.where(F.col("rows") > 1)


def stage_rename_map(
    properties: DataFrame,
    stages: DataFrame,
    whole_parts: bool = False,
    prefixes: list[str] = STAGE_PREFIXES,
) -> DataFrame:
    """(property, renamed) for properties that start with a prefix and contain a stage id.

    ``properties`` has (name), ``stages`` has (stage_id, stage_ord). A stage id counts as written
    or with dashes turned to underscores; the first prefix and the last stage win. Containment is
    an equality join, not a pairing of everything with everything: a name is cut into its
    substrings of the lengths that stage ids have, and those meet the ids on equality. With
    ``whole_parts`` a match must stand between underscores or the ends.
    """
    dashless = F.replace("stage_id", F.lit("-"), F.lit("_"))
    spelled = stages.select("stage_id", "stage_ord", F.explode(F.array("stage_id", dashless)).alias("spelling"))
    spelled = spelled.groupBy("spelling").agg(
        F.max_by(F.struct("stage_id", "stage_ord"), "stage_ord").alias("stage")
    )
    lengths = collect_catalog(spelled.select(F.length("spelling").alias("n")).distinct())
    sizes = F.array(*[F.lit(r.n) for r in lengths if r.n]) if lengths else F.array().cast("array<int>")

    prefix = F.coalesce(*[F.when(F.col("name").startswith(p), F.lit(p)) for p in prefixes])
    candidates = properties.select("name").distinct().select("name", prefix.alias("prefix"))
    candidates = candidates.where(F.col("prefix").isNotNull())
    pieces = candidates.select("*", F.explode(sizes).alias("n")).where(F.length("name") >= F.col("n"))
    pieces = pieces.select("*", F.explode(F.sequence(F.lit(1), F.length("name") - F.col("n") + 1)).alias("at"))
    if whole_parts:
        before = (F.col("at") == 1) | (F.expr("substring(name, at - 1, 1)") == "_")
        after = (F.col("at") + F.col("n") > F.length("name")) | (
            F.expr("substring(name, at + n, 1)") == "_"
        )
        pieces = pieces.where(before & after)
    pieces = pieces.select("name", "prefix", F.expr("substring(name, at, n)").alias("spelling"))

    hits = pieces.join(spelled, "spelling")
    last = hits.groupBy("name", "prefix").agg(F.max_by("stage", "stage.stage_ord").alias("stage"))
    tail = F.replace("stage.stage_id", F.lit("-"), F.lit("_"))
    return last.select(
        F.col("name").alias("property"), F.concat_ws("_", "prefix", tail).alias("renamed")
    )
