"""Upserts, tombstones, evolution: a target from early orders meets a load from later ones."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.meta import MetaColumns
from tidemark.operators import merge as M
from tidemark.operators import tombstones as X
from tidemark.operators.evolve import add_columns, align, base_columns, create_database, create_table, stack
from tidemark.session import scratch_database, scratch_dir
from workload.registry import Tables, day, iso, query, text

SPLIT = "1998-06-01"
MARK = datetime(2024, 2, 1)
META = MetaColumns(id="id", synced="synced_at", deleted="deleted")

ORDERS = f"""
    o AS (
        SELECT o_custkey * 10 + CAST(left(o_orderpriority, 1) AS BIGINT) AS id, o_totalprice AS total,
               o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d') AS placed,
               o_orderpriority AS priority, o_orderdate, o_orderkey,
               o_orderdate >= TIMESTAMP '{SPLIT}' AS late
        FROM orders),
    tgt AS (
        SELECT *, CASE status WHEN 'P' THEN true WHEN 'F' THEN false END AS deleted,
               TIMESTAMP '2024-01-01' AS synced_at
        FROM o WHERE NOT late
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
    src AS (
        SELECT *, CASE WHEN status <> 'P' THEN total END AS new_total FROM o WHERE late
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""


def versions(t: Tables) -> DataFrame:
    """Every order as a version of the record (customer, priority)."""
    return t.orders.select(
        (F.col("o_custkey") * 10 + F.left("o_orderpriority", F.lit(1)).cast("bigint")).alias("id"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderstatus").alias("status"),
        day("o_orderdate").alias("placed"),
        F.col("o_orderpriority").alias("priority"),
        F.struct("o_orderdate", "o_orderkey").alias("arrival"),
        (F.col("o_orderdate") >= F.lit(SPLIT).cast("timestamp_ntz")).alias("late"),
    )


def target_and_load(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Target without ``priority``; load without ``status``, with some totals gone null."""
    all_versions = versions(t)
    target = M.keep_last(all_versions.where(~F.col("late")), ["id"], ["arrival"])
    load = M.keep_last(all_versions.where("late"), ["id"], ["arrival"])
    return (
        target.select(
            "id", "total", "status", "placed",
            F.expr("CASE status WHEN 'P' THEN true WHEN 'F' THEN false END").alias("deleted"),
            F.lit("2024-01-01").cast("timestamp_ntz").alias("synced_at"),
        ),
        load.select(
            "id", F.when(F.col("status") != "P", F.col("total")).alias("total"), "placed", "priority"
        ),
    )


@query(f"""
    WITH {ORDERS}
    SELECT coalesce(s.id, t.id) AS id,
           CASE WHEN s.id IS NOT NULL THEN s.new_total ELSE t.total END AS total, t.status,
           CASE WHEN s.id IS NOT NULL THEN s.placed ELSE t.placed END AS placed, s.priority
    FROM tgt t FULL JOIN src s ON s.id = t.id""")
def upsert_present_columns(t: Tables) -> DataFrame:
    target, load = target_and_load(t)
    return M.upsert(target, load, ["id"]).drop("deleted", "synced_at")


@query(f"""
    WITH o AS (
        SELECT o_custkey, o_orderstatus = 'F' AS is_load, o_orderdate, o_orderkey, o_totalprice
        FROM orders),
    tgt AS (SELECT * FROM o WHERE NOT is_load QUALIFY row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
    src AS (SELECT * FROM o WHERE is_load QUALIFY row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT coalesce(s.o_custkey, t.o_custkey) AS customer,
           CASE WHEN t.o_custkey IS NULL OR s.o_orderdate >= t.o_orderdate
                THEN s.o_totalprice ELSE t.o_totalprice END AS total,
           strftime(CASE WHEN t.o_custkey IS NULL OR s.o_orderdate >= t.o_orderdate
                    THEN s.o_orderdate ELSE t.o_orderdate END, '%Y-%m-%d') AS modified
    FROM tgt t FULL JOIN src s ON s.o_custkey = t.o_custkey""")
def upsert_guarded(t: Tables) -> DataFrame:
    rows = t.orders.select(
        F.col("o_custkey").alias("customer"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderdate").alias("modified"),
        "o_orderkey",
        "o_orderstatus",
    )
    loaded = F.col("o_orderstatus") == "F"
    target, load = (
        M.keep_last(rows.where(side), ["customer"], ["modified", "o_orderkey"]).drop("o_orderkey", "o_orderstatus")
        for side in (~loaded, loaded)
    )
    merged = M.upsert(target, load, ["customer"], guard="modified")
    return merged.select("customer", "total", day("modified").alias("modified"))


MARKED = """
    SELECT id, status, ({doomed}) AND deleted IS DISTINCT FROM true AS hit, deleted, synced_at FROM tgt"""
SHOWN = """
    SELECT id, status, CASE WHEN hit THEN true ELSE deleted END AS deleted,
           CASE WHEN hit THEN '2024-02-01' ELSE '2024-01-01' END AS synced_on FROM marked"""


def shown(df: DataFrame) -> DataFrame:
    return df.select("id", "status", "deleted", day("synced_at").alias("synced_on"))


@query(f"WITH {ORDERS}, marked AS ({MARKED.format(doomed='id NOT IN (SELECT id FROM src)')}) {SHOWN}")
def mark_absent(t: Tables) -> DataFrame:
    target, load = target_and_load(t)
    return shown(X.mark_absent(target, load, MARK, META))


@query(f"WITH {ORDERS}, marked AS ({MARKED.format(doomed='id IN (SELECT id FROM src)')}) {SHOWN}")
def mark_listed(t: Tables) -> DataFrame:
    target, load = target_and_load(t)
    return shown(X.mark_listed(target, load, MARK, META))


@query(f"""
    WITH {ORDERS}
    SELECT coalesce(s.id, t.id) AS id,
           CASE WHEN s.id IS NOT NULL THEN s.new_total ELSE t.total END AS total, t.status, s.priority,
           s.id IS NULL AS deleted,
           CASE WHEN s.id IS NOT NULL OR t.deleted IS DISTINCT FROM true THEN '2024-02-01'
                ELSE '2024-01-01' END AS synced_on
    FROM tgt t FULL JOIN src s ON s.id = t.id""")
def upsert_then_tombstone(t: Tables) -> DataFrame:
    target, load = target_and_load(t)
    load = load.select(
        "*", F.lit(False).alias("deleted"), F.lit("2024-02-01").cast("timestamp_ntz").alias("synced_at")
    )
    synced = M.full_sync(target, load, MARK, META, seen=t.orders)
    return synced.select("id", "total", "status", "priority", "deleted", day("synced_at").alias("synced_on"))


@query("""
    SELECT event_id AS id FROM events
    WHERE event_type = 'purchase' OR (event_type = 'error' AND ts > TIMESTAMP '2024-01-15')""")
def archived_since(t: Tables) -> DataFrame:
    feed = t.events.select(
        F.when(F.col("event_type") == "view", F.concat(F.lit("v"), text("event_id")))
        .otherwise(text("event_id"))
        .alias("id"),
        F.col("event_type").isin("error", "view", "purchase").cast("string").alias("archived"),
        F.when(F.col("event_type") == "purchase", F.col("props")).otherwise(iso("ts")).alias("archivedAt"),
    )
    return X.archived_since(feed, datetime(2024, 1, 15), META)


@query("""
    SELECT user_id, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_user(t: Tables) -> DataFrame:
    last = M.keep_last(t.events.select("user_id", "event_id", "value", "ts"), ["user_id"], ["ts", "event_id"])
    return last.select("user_id", "event_id", "value")


@query("""
    SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""")
def evolve_union(t: Tables) -> DataFrame:
    customers = t.customer.select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.supplier.select(
        text("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    return stack(customers, align(suppliers, customers.schema))


@query("""
    SELECT c_custkey AS id, NULL::BOOLEAN AS deleted, c_mktsegment AS segment, NULL::DOUBLE AS balance
    FROM customer
    UNION ALL SELECT s_suppkey, NULL, NULL, s_acctbal FROM supplier""")
def evolved_table(t: Tables) -> DataFrame:
    """A catalog table that gains a column with each of two loads."""
    folder = scratch_dir(t.spark, "evolved")
    database = scratch_database(t.spark, "evolved_" + folder.rsplit("-", 1)[1])
    create_database(t.spark, database, folder)
    table = f"{database}.customer"
    create_table(t.spark, table, base_columns(META))
    loads = [
        t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")),
        t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")),
    ]
    for load in loads:
        add_columns(t.spark, table, load.schema)
        t.spark.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{load}}", load=load)
    return t.spark.table(table).select("id", "deleted", "segment", "balance")
