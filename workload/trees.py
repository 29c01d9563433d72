"""Two-level trees and the property names that embed their ids."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.meta import STAGE_PREFIXES, MetaColumns
from tidemark.operators import hierarchy as H
from tidemark.sources.pages import PIPELINE, explode_results, parse_pages
from workload.registry import Tables, iso, query, text

MARK = datetime(2024, 2, 1)
META = MetaColumns(id="id", synced="synced_at", deleted="deleted")


def trees(t: Tables) -> DataFrame:
    """Each order as a pipeline with one stage for its status and one for its priority."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    stages = F.array(
        F.struct(
            F.concat(F.lit("s-"), text("o_orderkey")).alias("id"),
            status.alias("label"),
            F.when(status != "P", F.col("o_custkey")).alias("displayOrder"),
            iso("o_orderdate").alias("createdAt"),
            (status == "F").alias("archived"),
            F.struct(
                F.when(status == "O", "").otherwise(status).alias("state"),
                priority.alias("leadState"),
            ).alias("metadata"),
        ),
        F.struct(
            F.concat(F.lit("p-"), text("o_orderkey")).alias("id"),
            priority.alias("label"),
            F.lit(None).cast("int").alias("displayOrder"),
            F.lit("soon").alias("createdAt"),
            F.lit(None).cast("boolean").alias("archived"),
            F.lit(None).cast("struct<state:string,leadState:string>").alias("metadata"),
        ),
    )
    tree = F.struct(
        text("o_orderkey").alias("id"),
        priority.alias("label"),
        F.when(status == "P", F.col("o_custkey")).alias("displayOrder"),
        iso("o_orderdate").alias("createdAt"),
        F.when(status == "P", True).alias("archived"),
        F.when(status != "P", stages).alias("stages"),
    )
    body = F.to_json(F.struct(F.array(tree).alias("results")))
    pages = t.orders.select("o_orderkey", body.alias("body"))
    return explode_results(parse_pages(pages, "body", "o_orderkey", PIPELINE))


def in_micros(df: DataFrame) -> DataFrame:
    keep = [c for c in df.columns if c not in ("created_at", "updated_at", "synced_at")]
    return df.select(
        *keep,
        text(F.unix_micros("created_at")).alias("created_us"),
        text(F.unix_micros("updated_at")).alias("updated_us"),
    )


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS pipeline_id, o_orderpriority AS label,
           CASE WHEN o_orderstatus = 'P' THEN o_custkey ELSE 1 END::INTEGER AS display_order,
           CAST(epoch_us(o_orderdate) AS VARCHAR) AS created_us, NULL::VARCHAR AS updated_us,
           o_orderstatus = 'P' AS archived, o_orderstatus = 'P' AS deleted
    FROM orders""")
def pipelines_flat(t: Tables) -> DataFrame:
    return in_micros(H.flatten_pipelines(trees(t), MARK, META))


@query("""
    SELECT 's-' || o_orderkey AS stage_id, CAST(o_orderkey AS VARCHAR) AS pipeline_id,
           o_orderstatus AS label, o_custkey::INTEGER AS display_order,
           CAST(epoch_us(o_orderdate) AS VARCHAR) AS created_us, NULL::VARCHAR AS updated_us,
           o_orderstatus = 'F' AS archived, o_orderstatus = 'F' AS deleted,
           CASE o_orderstatus WHEN 'O' THEN o_orderpriority ELSE o_orderstatus END AS state
    FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT 'p-' || o_orderkey, CAST(o_orderkey AS VARCHAR), o_orderpriority, 0, NULL, NULL,
           false, false, NULL FROM orders WHERE o_orderstatus <> 'P'""")
def stages_flat(t: Tables) -> DataFrame:
    return in_micros(H.flatten_stages(trees(t), MARK, META))


@query("""
    SELECT l_orderkey AS pipeline_id, l_partkey AS stage_id FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def orphan_stages(t: Tables) -> DataFrame:
    live = t.orders.where(F.col("o_orderstatus") != "P")
    stages = t.lineitem.select(
        F.col("l_orderkey").alias("pipeline_id"), F.col("l_partkey").alias("stage_id")
    )
    return H.orphan_stages(stages, live.select(F.col("o_orderkey").alias("pipeline_id")))


@query("""
    SELECT l_orderkey AS pipeline_id, l_linenumber AS stage_id, count(*)::BIGINT AS rows
    FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def repeated_stages(t: Tables) -> DataFrame:
    stages = t.lineitem.select(
        F.col("l_orderkey").alias("pipeline_id"), F.col("l_linenumber").alias("stage_id")
    )
    return H.repeated_stages(stages)


PROPERTY = """CASE o_orderpriority
    WHEN '1-URGENT' THEN 'hs_v2_date_entered_' WHEN '2-HIGH' THEN 'hs_time_in_'
    WHEN '3-MEDIUM' THEN 'hs_date_exited_x_' WHEN '5-LOW' THEN 'hs_v2_latest_time_in'
    ELSE 'created_' END || CASE o_orderstatus WHEN 'P' THEN 'stage-' ELSE 'stage_' END
    || o_custkey || '_' || o_orderkey"""


@query(f"""
    WITH props AS (SELECT DISTINCT {PROPERTY} AS name FROM orders),
    stages AS (SELECT 'stage-' || s_suppkey AS stage_id, s_suppkey AS ord FROM supplier),
    prefixes AS (
        SELECT unnest({STAGE_PREFIXES!r}) AS prefix, unnest(range({len(STAGE_PREFIXES)})) AS pos),
    headed AS (
        SELECT name, prefix FROM props JOIN prefixes ON starts_with(name, prefix)
        QUALIFY row_number() OVER (PARTITION BY name ORDER BY pos) = 1)
    SELECT name AS property, prefix || '_' || replace(stage_id, '-', '_') AS renamed
    FROM headed JOIN stages ON contains(name, stage_id) OR contains(name, replace(stage_id, '-', '_'))
    QUALIFY row_number() OVER (PARTITION BY name ORDER BY ord DESC) = 1""")
def stage_rename(t: Tables) -> DataFrame:
    properties = t.orders.select(F.expr(PROPERTY).alias("name"))
    stages = t.supplier.select(
        F.concat(F.lit("stage-"), text("s_suppkey")).alias("stage_id"), F.col("s_suppkey").alias("stage_ord")
    )
    return H.stage_rename_map(properties, stages)
