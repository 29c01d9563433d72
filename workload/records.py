"""Records: envelopes, flattening, typing, rejects."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import (
    convert_columns,
    parse_bool,
    parse_date,
    parse_instant,
    parse_number,
    to_local,
    unify_missing,
)
from tidemark.functions.casts import epoch_ms as epoch_text
from tidemark.functions.naming import plan_columns
from tidemark.meta import MetaColumns
from tidemark.operators.records import (
    classify_error,
    flatten_records,
    offending_digits,
)
from tidemark.sources.pages import active_records, explode_results, parse_pages
from workload.registry import Tables, day, iso, query, text

MARK = datetime(2024, 2, 1)
META = MetaColumns(id="id", synced="synced_at", deleted="deleted")


@query("""
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment,
           '2024-02-01' AS synced_at, false AS deleted
    FROM customer WHERE c_mktsegment <> 'FURNITURE'""")
def json_envelope_roundtrip(t: Tables) -> DataFrame:
    record = F.struct(
        text("c_custkey").alias("id"),
        F.struct(
            F.col("c_name").alias("Name"),
            F.col("c_acctbal").alias("Balance"),
            F.col("c_mktsegment").alias("Segment"),
        ).alias("properties"),
        (F.col("c_mktsegment") == "FURNITURE").alias("archived"),
    )
    body = F.to_json(F.struct(F.array(record).alias("results")))
    pages = parse_pages(t.customer.select("c_custkey", body.alias("body")), "body", "c_custkey")
    columns = plan_columns([("Name", "string"), ("Balance", "number"), ("Segment", "enumeration")])
    active = active_records(explode_results(pages))
    flat = flatten_records(active, columns, MARK, META).drop("_bad_id")
    return flat.withColumn("synced_at", day("synced_at"))


@query("""
    SELECT event_id AS id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
           event_type AS tipo_de_accion, epoch_us(ts) AS ts_us, value, props AS raw,
           '2024-02-01' AS synced_on, event_type = 'error' AS deleted
    FROM events""")
def flatten_props(t: Tables) -> DataFrame:
    properties = F.create_map(
        *[
            x
            for name, value in [
                ("k", F.get_json_object("props", "$.k")),
                ("Tipo de Acción", F.col("event_type")),
                ("ts", iso("ts")),
                ("value", text("value")),
                ("raw", F.col("props")),
            ]
            for x in (F.lit(name), value)
        ]
    )
    records = t.events.select(
        text("event_id").alias("id"),
        properties.alias("properties"),
        F.when(F.col("event_type") == "error", "true").alias("archived"),
    )
    columns = plan_columns(
        [
            ("k", "number"),
            ("Tipo de Acción", "enumeration"),
            ("ts", "datetime"),
            ("value", "number"),
            ("raw", "string"),
        ],
        meta=META,
    )
    flat = flatten_records(records, columns, MARK, META)
    return flat.select(
        "id",
        "k",
        "tipo_de_accion",
        F.unix_micros("ts").alias("ts_us"),
        "value",
        "raw",
        F.date_format("synced_at", "yyyy-MM-dd").alias("synced_on"),
        "deleted",
    )


BAD_ID = """CASE o_orderpriority WHEN '5-LOW' THEN o_orderkey || '.5' WHEN '2-HIGH' THEN '1_' || o_orderkey
            WHEN '3-MEDIUM' THEN ' ' || o_orderkey || ' ' ELSE CAST(o_orderkey AS VARCHAR(30)) END"""


@query(f"""
    WITH ids AS (SELECT o_orderkey, {BAD_ID} AS id, o_orderstatus FROM orders)
    SELECT CASE WHEN regexp_matches(id, '^\\s*[+-]?[0-9]+\\s*$') THEN CAST(trim(id)::BIGINT AS VARCHAR) END AS id,
           o_orderstatus AS status,
           CASE WHEN NOT regexp_matches(id, '^\\s*[+-]?[0-9]+\\s*$') THEN id END AS bad_id
    FROM ids""")
def reject_bad_ids(t: Tables) -> DataFrame:
    properties = F.to_json(F.struct(F.col("o_orderstatus").alias("status")))
    records = t.orders.select(
        F.expr(BAD_ID).alias("id"), properties.alias("properties"), F.lit("false").alias("archived")
    )
    flat = flatten_records(records, plan_columns([("status", "string")]), MARK, META)
    return flat.select(text("id").alias("id"), "status", F.col("_bad_id").alias("bad_id"))


@query("""
    SELECT o_orderkey AS id, CAST(o_custkey AS DOUBLE) AS customer, o_totalprice AS total,
           strftime(o_orderdate, '%Y-%m-%d') AS placed, epoch_us(o_orderdate) AS placed_us,
           CASE o_orderstatus WHEN 'O' THEN true WHEN 'F' THEN false END AS open,
           o_orderpriority AS priority, o_orderstatus AS asoc_status, o_orderstatus AS deleted
    FROM orders""")
def typed_records(t: Tables) -> DataFrame:
    flag = "CASE o_orderstatus WHEN 'O' THEN 'true' WHEN 'F' THEN 'false' ELSE '' END"
    wide = t.orders.select(
        F.col("o_orderkey").alias("id"),
        text("o_custkey").alias("customer"),
        text("o_totalprice").alias("total"),
        iso("o_orderdate").alias("placed"),
        iso("o_orderdate").alias("placed_us"),
        F.expr(flag).alias("open"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("asoc_status"),
        F.col("o_orderstatus").alias("deleted"),
    )
    declared = {
        "customer": "number",
        "total": "number",
        "placed": "date",
        "placed_us": "datetime",
        "open": "bool",
        "priority": "enumeration",
        "asoc_status": "number",
        "deleted": "bool",
    }
    typed = convert_columns(wide, declared, META)
    return typed.select(
        *[
            text(c).alias(c) if c == "placed" else F.unix_micros(c).alias(c) if c == "placed_us" else c
            for c in typed.columns
        ]
    )


NUMBER = """CASE o_orderpriority WHEN '1-URGENT' THEN CAST(o_totalprice AS VARCHAR(40))
            WHEN '2-HIGH' THEN ' ' || o_orderkey || ' '
            WHEN '3-MEDIUM' THEN o_custkey || 'e-2'
            WHEN '5-LOW' THEN CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN 'inf' ELSE 'NaN' END
            ELSE o_orderkey || 'd' END"""


@query(f"""
    WITH texts AS (SELECT o_orderkey, {NUMBER} AS t FROM orders)
    SELECT o_orderkey, CASE WHEN regexp_matches(t, '^\\s*[+-]?[0-9]+\\.?[0-9]*([eE][+-]?[0-9]+)?\\s*$')
                       THEN TRY_CAST(trim(t) AS DOUBLE) END AS value FROM texts""")
def typed_number(t: Tables) -> DataFrame:
    raw = t.orders.select("o_orderkey", F.expr(NUMBER).alias("t"))
    return raw.select("o_orderkey", parse_number(F.col("t")).alias("value"))


BOOL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'true' WHEN '2-HIGH' THEN 'false'
          WHEN '3-MEDIUM' THEN 'True' WHEN '5-LOW' THEN CASE o_orderstatus WHEN 'F' THEN '' END
          ELSE '1' END"""


@query(f"""
    SELECT o_orderkey, CASE {BOOL} WHEN 'true' THEN true WHEN 'false' THEN false END AS flag
    FROM orders""")
def typed_bool_strict(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", parse_bool(F.expr(BOOL)).alias("flag"))


def written_time(day_text: str, iso_text: str) -> str:
    return f"""CASE event_type WHEN 'view' THEN {iso_text} WHEN 'click' THEN {day_text}
               WHEN 'signup' THEN '01/02/2024' WHEN 'error' THEN props
               ELSE CAST(event_id AS VARCHAR(30)) END"""


@query("""
    SELECT event_id,
           CAST(CASE event_type WHEN 'view' THEN epoch_us(ts)
                WHEN 'click' THEN epoch_us(date_trunc('day', ts)::TIMESTAMP) END AS VARCHAR) AS instant_us,
           CASE WHEN event_type IN ('view', 'click') THEN strftime(ts, '%Y-%m-%d') END AS day
    FROM events""")
def typed_datetime(t: Tables) -> DataFrame:
    raw = t.events.select(
        "event_id",
        F.expr(written_time("CAST(CAST(ts AS DATE) AS STRING)", "concat(CAST(ts AS STRING), 'Z')")).alias("t"),
    )
    return raw.select(
        "event_id",
        text(F.unix_micros(parse_instant(F.col("t")))).alias("instant_us"),
        text(parse_date(F.col("t"))).alias("day"),
    )


@query("SELECT event_id, epoch_us(ts - INTERVAL 5 HOUR) AS local_us FROM events")
def local_time(t: Tables) -> DataFrame:
    local = to_local(F.col("ts"))
    return t.events.select("event_id", F.unix_micros(local.cast("timestamp")).alias("local_us"))


@query("""
    SELECT event_id, CASE event_type WHEN 'error' THEN props
                     ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) END AS ms FROM events""")
def epoch_ms(t: Tables) -> DataFrame:
    written = F.when(F.col("event_type") == "error", F.col("props")).otherwise(iso("ts"))
    return t.events.select("event_id", epoch_text(written).alias("ms"))


@query("""
    SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events""")
def missing_values(t: Tables) -> DataFrame:
    holes = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return unify_missing(t.events.select("event_id", holes.alias("value")))


MESSAGE = """CASE event_type WHEN 'error' THEN 'date/time field value out of range: "' || event_id || '"'
             WHEN 'click' THEN 'Duplicate Key in ' || props WHEN 'view' THEN 'no such Column ' || props
             ELSE props END"""
KIND = """CASE WHEN event_type = 'signup' AND user_id > 50 THEN 'IntegrityError'
          WHEN event_type = 'signup' THEN 'ProgrammingError' ELSE 'DataError' END"""


@query("""
    SELECT event_id,
           CASE event_type WHEN 'error' THEN 'data_type' WHEN 'click' THEN 'integrity'
                WHEN 'view' THEN 'schema'
                WHEN 'signup' THEN CASE WHEN user_id > 50 THEN 'integrity' ELSE 'schema' END
                ELSE 'unknown' END AS class,
           CASE event_type WHEN 'error' THEN CAST(event_id AS VARCHAR) ELSE 'unknown' END AS digits
    FROM events""")
def classify_errors(t: Tables) -> DataFrame:
    kind, message = F.expr(KIND), F.expr(MESSAGE)
    return t.events.select(
        "event_id",
        classify_error(kind, message).alias("class"),
        offending_digits(message).alias("digits"),
    )
