"""High-water marks and run modes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import parse_instant
from tidemark.operators import state as S
from workload.registry import Tables, iso, query, text

SINCE = datetime(2024, 1, 20, 12)
THRESHOLD = 20


@query("SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' ORDER BY ts")
def modified_since(t: Tables) -> DataFrame:
    feed = t.events.select("event_id", "value", iso("ts").alias("modified"))
    changed = S.modified_since(feed, parse_instant(F.col("modified")), SINCE, ordered=True)
    return changed.select("event_id", "value")


@query(f"""
    SELECT count(*)::BIGINT AS total, count(*) > {THRESHOLD} AS exceeded
    FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00'""")
def cut_off(t: Tables) -> DataFrame:
    feed = t.events.select(iso("ts").alias("modified"))
    changed = S.modified_since(feed, parse_instant(F.col("modified")), SINCE)
    return changed.agg(F.count(F.lit(1)).alias("total")).withColumn("exceeded", F.lit(S.exceeds(changed, THRESHOLD)))


@query(f"""
    WITH counted AS (
        SELECT user_id, count(*) FILTER (ts >= TIMESTAMP '2024-01-20 12:00:00')::BIGINT AS changed,
               min(ts) < TIMESTAMP '2024-01-02' AS known
        FROM events GROUP BY user_id)
    SELECT user_id, changed,
           CASE WHEN NOT known OR changed > {THRESHOLD} THEN 'full' ELSE 'incremental' END AS mode
    FROM counted""")
def mode_choice(t: Tables) -> DataFrame:
    late = F.col("ts") >= F.lit(SINCE.isoformat()).cast("timestamp_ntz")
    known = F.min("ts") < F.lit("2024-01-02").cast("timestamp_ntz")
    counted = t.events.groupBy("user_id").agg(
        F.count_if(late).alias("changed"), F.when(known, F.min("ts")).alias("since")
    )
    mode = S.mode_expr(F.col("since"), F.col("changed"), THRESHOLD, F.lit(False))
    return counted.select("user_id", "changed", mode.alias("mode"))


@query("""
    SELECT 'user_' || user_id AS object_type, epoch_us(ts) AS mark_us, event_id AS records_synced,
           CASE event_type WHEN 'signup' THEN 'full' ELSE 'incremental' END AS sync_mode
    FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1""")
def advance_state(t: Tables) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    mode = F.when(F.col("event_type") == "signup", "full").otherwise("incremental")
    log = t.events.select(
        F.concat(F.lit("user_"), text("user_id")).alias("object_type"),
        at.alias("last_sync_timestamp"),
        F.col("event_id").alias("records_synced"),
        mode.alias("sync_mode"),
        at.alias("updated_at"),
    )
    latest = S.latest_state(log)
    return latest.select(
        "object_type", F.unix_micros("last_sync_timestamp").alias("mark_us"), "records_synced", "sync_mode"
    )
