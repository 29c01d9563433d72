"""Null profiles, counters, status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import profile as P
from tidemark.operators.ordinal import number_batches as batches
from workload.registry import Tables, query, text

COLUMNS = ["status", "priority", "total", "customer"]
HOLES = """
    o AS (
        SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status,
               nullif(o_orderpriority, '5-LOW') AS priority,
               CASE WHEN o_totalprice > 20000 THEN o_totalprice END AS total, o_custkey AS customer,
               (row_number() OVER (ORDER BY o_orderkey) - 1) // 100 AS batch
        FROM orders),
    long AS (
        SELECT batch, 'status' AS "column", status IS NULL AS hole FROM o
        UNION ALL SELECT batch, 'priority', priority IS NULL FROM o
        UNION ALL SELECT batch, 'total', total IS NULL FROM o
        UNION ALL SELECT batch, 'customer', customer IS NULL FROM o),
    profile AS (
        SELECT "column", count(*) FILTER (hole)::BIGINT AS null_count,
               count(*) FILTER (hole) / count(*) * 100 AS pct
        FROM long GROUP BY 1 HAVING count(*) FILTER (hole) > 0)"""


def with_holes(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.when(F.col("o_totalprice") > 20000, F.col("o_totalprice")).alias("total"),
        F.col("o_custkey").alias("customer"),
    )


@query(f'WITH {HOLES} SELECT "column", null_count, round(pct, 6) AS pct FROM profile')
def null_profile(t: Tables) -> DataFrame:
    profile = P.null_profile(with_holes(t), COLUMNS)
    return profile.select("column", "null_count", F.round("pct", 6).alias("pct"))


@query(f"""
    WITH {HOLES},
    per_batch AS (
        SELECT "column", batch, count(*) FILTER (hole)::BIGINT AS null_count,
               count(*) FILTER (hole) / count(*) * 100 AS pct
        FROM long GROUP BY 1, 2 HAVING count(*) FILTER (hole) > 0)
    SELECT "column", null_count, round(pct, 6) AS pct FROM per_batch
    QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY pct DESC, batch) = 1""")
def null_worst_batch(t: Tables) -> DataFrame:
    worst = P.null_worst_batch(batches(with_holes(t), ["o_orderkey"]), "batch", COLUMNS)
    return worst.select("column", "null_count", F.round("pct", 6).alias("pct"))


@query("""
    SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 100 AS batch FROM events""")
def number_batches(t: Tables) -> DataFrame:
    return batches(t.events.select("ts", "event_id"), ["ts", "event_id"]).select("event_id", "batch")


@query(f"""
    WITH {HOLES}
    SELECT "column", null_count, round(pct, 6) AS pct, pct > 10 AS alert
    FROM profile ORDER BY profile.pct DESC, "column" LIMIT 2""")
def top_null_columns(t: Tables) -> DataFrame:
    top = P.top_null_columns(P.null_profile(with_holes(t), COLUMNS), n=2)
    return top.select("column", "null_count", F.round("pct", 6).alias("pct"), "alert")


COUNTERS = """
    counters AS (
        SELECT 'user_' || user_id AS object_type, count(*)::BIGINT AS records_fetched,
               count(*) FILTER (event_type <> 'error' OR value <= 200)::BIGINT AS records_processed_ok,
               count(*) FILTER (event_type = 'error' AND value > 200)::BIGINT AS records_failed,
               count(DISTINCT event_type)::BIGINT AS association_tables_created,
               count(*) FILTER (event_type = 'signup' AND value > 200)::BIGINT AS db_insert_errors
        FROM events GROUP BY user_id)"""


def counters(t: Tables) -> DataFrame:
    high = F.col("value") > 200
    failed = (F.col("event_type") == "error") & high
    return t.events.groupBy(F.concat(F.lit("user_"), text("user_id")).alias("object_type")).agg(
        F.count(F.lit(1)).alias("records_fetched"),
        F.count_if(~failed).alias("records_processed_ok"),
        F.count_if(failed).alias("records_failed"),
        F.count_distinct("event_type").alias("association_tables_created"),
        F.count_if((F.col("event_type") == "signup") & high).alias("db_insert_errors"),
    )


@query(f"WITH {COUNTERS} SELECT * FROM counters")
def run_counters(t: Tables) -> DataFrame:
    return counters(t)


@query(f"""
    WITH {COUNTERS}
    SELECT object_type, records_failed, db_insert_errors,
           CASE WHEN records_failed = 0 AND db_insert_errors = 0 THEN 'healthy'
                ELSE 'with_errors' END AS status FROM counters""")
def health_status(t: Tables) -> DataFrame:
    return P.health(counters(t)).select("object_type", "records_failed", "db_insert_errors", "status")


@query(f"""
    WITH {COUNTERS}
    SELECT bool_and(records_failed = 0 AND db_insert_errors = 0) AS all_healthy,
           count(*)::BIGINT AS objects, sum(records_processed_ok)::BIGINT AS records_processed_ok,
           sum(records_failed)::BIGINT AS records_failed FROM counters""")
def object_rollup(t: Tables) -> DataFrame:
    return P.roll_up(P.health(counters(t)))
