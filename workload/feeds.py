"""Whole runs: landed pages to published tables, and the same from a stream."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.sync import Feed, sync_all, sync_object
from tidemark.plans.warehouse import Warehouse, buckets_for
from tidemark.session import scratch_database, scratch_dir
from tidemark.functions.casts import parse_instant
from tidemark.functions.naming import plan_columns
from tidemark.operators.records import flatten_records
from tidemark.streaming.feed import drop_repeats, stream_pages, stream_upsert
from workload.registry import Tables, day, iso, query, text

SPLIT = "1998-06-01"


def fresh_warehouse(t: Tables, purpose: str, sized_like: DataFrame) -> tuple[Warehouse, str]:
    folder = scratch_dir(t.spark, purpose)
    database = scratch_database(t.spark, f"{purpose}_{folder.rsplit('-', 1)[1]}")
    return Warehouse(t.spark, database, f"{folder}/tables", buckets_for(sized_like)), folder


@query("""
    SELECT user_id, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def stream_upsert_latest(t: Tables) -> DataFrame:
    house, folder = fresh_warehouse(t, "stream", t.events)
    landed = t.events.select("user_id", "event_id", "value", "ts")
    landed.write.parquet(f"{folder}/landed")
    rows = (
        t.spark.readStream.schema(landed.schema)
        .option("maxFilesPerTrigger", 2)
        .parquet(f"{folder}/landed")
    )
    stream = stream_upsert(
        rows, house, "latest", ["user_id"], ["ts", "event_id"], f"{folder}/checkpoint", guard="ts"
    )
    stream.awaitTermination()
    return house.read("latest").select("user_id", "event_id", "value")


@query("""
    SELECT user_id, count(*) AS n_events, sum(event_id)::BIGINT AS ids, sum(amount)::BIGINT AS amount
    FROM (SELECT user_id, event_id, CAST(floor(value) AS BIGINT) AS amount FROM events) GROUP BY user_id""")
def stream_dedup_window(t: Tables) -> DataFrame:
    """All events land, then a third of them again: a sink that only appends takes each once."""
    folder = scratch_dir(t.spark, "repeats")
    landed = t.events.select("user_id", "event_id", F.floor("value").alias("amount"))
    landed.write.parquet(f"{folder}/landed")
    landed.where(F.col("event_id") % 3 == 0).write.mode("append").parquet(f"{folder}/landed")
    rows = t.spark.readStream.schema(landed.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/landed")
    once = drop_repeats(rows, ["event_id"], "1 day")
    writer = once.writeStream.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    writer.format("parquet").start(f"{folder}/taken").awaitTermination()
    taken = t.spark.read.schema(landed.schema).parquet(f"{folder}/taken")
    return taken.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("event_id").alias("ids"), F.sum("amount").alias("amount")
    )


def order_states(house: Warehouse) -> DataFrame:
    return house.read("order").select(
        F.col("hs_object_id").alias("id"),
        "total_price",
        "status",
        day("hs_lastmodifieddate").alias("modified"),
        F.col("fivetran_deleted").alias("deleted"),
        day("fivetran_synced").alias("synced_on"),
    )


DECLARED = {"Total Price": "number", "Status": "string", "hs_lastmodifieddate": "datetime"}


def land(
    t: Tables, folder: str, orders: DataFrame, broken: Column | None = None, declared: dict[str, str] = DECLARED
) -> None:
    """Orders as landed pages of records with links to their customers, plus the catalogs.

    Where ``broken`` holds the page stops after half of its text. ``declared`` are the properties that
    the catalog knows. Records that land again add to those in the folder.
    """
    record = F.struct(
        text("o_orderkey").alias("id"),
        F.struct(
            F.col("o_totalprice").alias("Total Price"),
            F.col("o_orderstatus").alias("Status"),
            iso("o_orderdate").alias("hs_lastmodifieddate"),
        ).alias("properties"),
        F.struct(
            F.struct(F.array(F.struct(text("o_custkey").alias("id"), F.lit("1").alias("type"))).alias("results"))
            .alias("Customers")
        ).alias("associations"),
        F.lit(False).alias("archived"),
    )
    page = F.to_json(F.struct(F.array(record).alias("results")))
    if broken is not None:
        page = F.when(broken, page.substr(F.lit(1), F.floor(F.length(page) / 2).cast("int"))).otherwise(page)
    pages = orders.select(page)
    pages.write.mode("append").text(f"{folder}/orders/records")
    gone = t.orders.where(F.col("o_orderstatus") == "P").select(
        F.struct(text("o_orderkey").alias("id"), F.lit(True).alias("archived")).alias("r")
    )
    gone = gone.select(F.to_json(F.struct(F.array("r").alias("results"))))
    gone.write.mode("overwrite").text(f"{folder}/orders/archived")
    catalog = json.dumps({"results": [{"name": name, "type": kind} for name, kind in declared.items()]})
    single = {"properties": catalog, "schema": '{"objectTypeId":"0-1","name":"ORDER"}'}
    for kind, line in single.items():
        t.spark.createDataFrame([(line,)], "value string").write.mode("overwrite").text(f"{folder}/orders/{kind}")


def two_runs(t: Tables) -> tuple[Warehouse, Feed]:
    """A full run over the orders before the split, then an incremental one over all of them."""
    house, folder = fresh_warehouse(t, "sync", t.orders)
    early = F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz")
    land(t, f"{folder}/first", t.orders.where(early))
    land(t, f"{folder}/second", t.orders)
    sync_object(t.spark, Feed.under(f"{folder}/first", "orders"), house, mark=datetime(1998, 6, 1))
    sync_object(t.spark, Feed.under(f"{folder}/second", "orders"), house, mark=datetime(2002, 1, 1))
    return house


@query("""
    SELECT o_orderkey AS id, o_totalprice AS total_price, o_orderstatus AS status,
           strftime(o_orderdate, '%Y-%m-%d') AS modified, o_orderstatus = 'P' AS deleted,
           CASE WHEN o_orderstatus = 'P' OR o_orderdate >= TIMESTAMP '1998-06-01' THEN '2002-01-01'
                ELSE '1998-06-01' END AS synced_on
    FROM orders""")
def sync_two_runs(t: Tables) -> DataFrame:
    return order_states(two_runs(t))


@query("""
    SELECT o_orderkey AS id, o_totalprice AS total_price, o_orderstatus AS status,
           strftime(o_orderdate, '%Y-%m-%d') AS modified, o_orderstatus = 'P' AS deleted,
           CASE WHEN o_orderstatus = 'P' OR o_orderdate >= TIMESTAMP '1998-06-01' THEN '2002-01-01'
                ELSE '1998-06-01' END AS synced_on
    FROM orders""")
def sync_by_file(t: Tables) -> DataFrame:
    """Some orders land before the first run with change times after its mark, the others later; the
    second run opens the files of both by what the first one noted of them."""
    house, folder = fresh_warehouse(t, "files", t.orders)
    ahead = (F.col("o_orderkey") % 10 == 0) & (F.col("o_orderdate") >= F.lit(SPLIT).cast("timestamp_ntz"))
    early = (F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz")) & (F.col("o_orderkey") % 7 != 0)
    feed = Feed.under(folder, "orders")
    land(t, folder, t.orders.where(early))
    land(t, folder, t.orders.where(ahead))
    # Changed before the mark, and there when the run begins.
    land(t, folder, t.orders.where(~early & (F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz"))))
    sync_object(t.spark, feed, house, mark=datetime(1998, 6, 1), by_file=True)
    land(t, folder, t.orders.where(~ahead & (F.col("o_orderdate") >= F.lit(SPLIT).cast("timestamp_ntz"))))
    sync_object(t.spark, feed, house, mark=datetime(2002, 1, 1), by_file=True)
    return order_states(house)


@query("""
    SELECT o_orderkey AS id, o_totalprice AS total_price, o_orderstatus AS status,
           strftime(o_orderdate, '%Y-%m-%d') AS modified FROM orders""")
def variant_props(t: Tables) -> DataFrame:
    """Price and status are declared after most orders have come; nothing is read again for them."""
    house, folder = fresh_warehouse(t, "raw", t.orders)
    early = F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz")
    first = {"hs_lastmodifieddate": "datetime"}
    land(t, f"{folder}/first", t.orders.where(early), declared=first)
    land(t, f"{folder}/second", t.orders.where(~early))
    runs = [("first", datetime(1998, 6, 1)), ("second", datetime(2002, 1, 1))]
    for name, mark in runs:
        sync_object(t.spark, Feed.under(f"{folder}/{name}", "orders"), house, mark=mark, keep_raw=True)
    return house.read("order").select(
        F.col("hs_object_id").alias("id"), "total_price", "status", day("hs_lastmodifieddate").alias("modified")
    )


@query("""
    SELECT o_orderkey AS order_id, o_custkey AS customers_id, '1' AS type_id,
           'HUBSPOT_DEFINED' AS category FROM orders""")
def sync_edge_view(t: Tables) -> DataFrame:
    house = two_runs(t)
    return house.read("order_customers").drop("fivetran_synced")


@query("""
    SELECT count(*) FILTER (early)::BIGINT AS records_fetched, count(*) FILTER (early)::BIGINT AS db_upserts,
           0::BIGINT AS records_failed, 0::BIGINT AS records_deleted,
           count(*) FILTER (early)::BIGINT AS associations_found, 'full' AS sync_mode, 'healthy' AS status
    FROM (SELECT *, o_orderdate < TIMESTAMP '1998-06-01' AS early FROM orders)
    UNION ALL
    SELECT count(*) FILTER (late), count(*) FILTER (late AND o_orderstatus <> 'P'), 0,
           count(*) FILTER (o_orderstatus = 'P'), count(*) FILTER (late), 'incremental', 'healthy'
    FROM (SELECT *, o_orderdate >= TIMESTAMP '1998-06-01' AS late FROM orders)""")
def sync_run_log(t: Tables) -> DataFrame:
    """The counters that two runs wrote down."""
    return two_runs(t).read("sync_runs").select(
        "records_fetched", "db_upserts", "records_failed", "records_deleted", "associations_found", "sync_mode", "status"
    )


LONG = "a_property_whose_name_is_longer_than_the_sixty_three_letters_that_a_column_may_have"


def all_objects(t: Tables) -> Warehouse:
    """Orders and customers in one call, beside an object whose pipelines cannot be loaded; then the same
    again, when more orders have changed than an incremental run may take, but no more customers."""
    house, folder = fresh_warehouse(t, "objects", t.orders)

    def put(kind: str, key: str, rows: DataFrame, properties: list[Column], types: str) -> None:
        record = F.struct(
            text(key).alias("id"),
            F.struct(*properties, F.lit("2001-01-01T00:00:00Z").alias("hs_lastmodifieddate")).alias("properties"),
        )
        rows.select(F.to_json(F.struct(F.array(record).alias("results")))).write.text(f"{folder}/{kind}/records")
        t.spark.createDataFrame([(types,)], "value string").write.text(f"{folder}/{kind}/properties")

    total = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice")).alias("total")
    put("orders", "o_orderkey", t.orders, [total, F.col("o_orderstatus").alias(LONG)],
        f'{{"results":[{{"name":"total","type":"number"}},{{"name":"{LONG}"}},{{"name":"hs_lastmodifieddate","type":"datetime"}}]}}')
    put("customers", "c_custkey", t.customer, [F.col("c_name").alias("name")],
        '{"results":[{"name":"name"},{"name":"missing"},{"name":"hs_lastmodifieddate","type":"datetime"}]}')
    broken = '{"results":[{"label":"no id","stages":[{"id":"s"}]}]}'
    t.spark.createDataFrame([(broken,)], "value string").write.text(f"{folder}/broken/pipelines")
    kinds = ["orders", "customers", "broken"]
    sync_all(t.spark, folder, kinds, house, mark=datetime(2000, 6, 1))
    # Ten customers to an order at least, in every table given.
    sync_all(t.spark, folder, kinds, house, mark=datetime(2002, 1, 1), max_changes=t.customer.count())
    return house


@query(f"""
    WITH nulls(object_type, "column", null_count, n) AS (
        SELECT 'orders', 'total', (SELECT count(*) FROM orders WHERE o_orderkey % 4 = 0), (SELECT count(*) FROM orders)
        UNION ALL SELECT 'customers', 'missing', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer))
    SELECT run, object_type, "column", null_count, round(100.0 * null_count / n, 6) AS pct, true AS alert,
           CASE WHEN object_type = 'orders' THEN '{LONG[:63]}' END AS truncated
    FROM nulls, (VALUES (1::BIGINT), (2)) AS runs(run)""")
def sync_health(t: Tables) -> DataFrame:
    """What two runs wrote down about empty columns and names that were cut."""
    house = all_objects(t)

    def of_run(name: str) -> DataFrame:
        # The runs of one object by when they ended.
        return house.read(name).withColumn("run", F.dense_rank().over(Window.partitionBy("object_type").orderBy("finished_at")).cast("long"))

    cut = of_run("sync_truncated").select("object_type", "run", F.col("final").alias("truncated"))
    nulls = of_run("sync_nulls").withColumn("pct", F.round("pct", 6)).drop("finished_at")
    return nulls.join(cut, ["object_type", "run"], "left")


@query("""
    SELECT run, false AS all_healthy, 3::BIGINT AS objects, 1::BIGINT AS objects_failed, 0::BIGINT AS records_failed,
           (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer) AS records_processed_ok,
           'full' AS orders_mode, CASE run WHEN 1 THEN 'full' ELSE 'incremental' END AS customers_mode,
           'ValueError' AS error_type, 'broken' AS error_object
    FROM (VALUES (1::BIGINT), (2)) AS runs(run)""")
def sync_all_objects(t: Tables) -> DataFrame:
    """The roll-up of two calls over three objects, with the modes that the objects were run in."""
    house = all_objects(t)
    order = Window.orderBy("finished_at")
    # Two rows, one for each call.
    ups = house.read("sync_rollups").withColumn("run", F.row_number().over(order).cast("long")).drop("finished_at")
    by_object = Window.partitionBy("object_type").orderBy("finished_at")
    runs = house.read("sync_runs").withColumn("run", F.row_number().over(by_object).cast("long"))
    modes = runs.groupBy("run").pivot("object_type", ["orders", "customers"]).agg(F.first("sync_mode"))
    failed = house.read("sync_rejects").where("id_text IS NULL").withColumn(
        "run", F.row_number().over(Window.partitionBy("object_type").orderBy("rejected_at")).cast("long")
    )
    modes = modes.select("run", F.col("orders").alias("orders_mode"), F.col("customers").alias("customers_mode"))
    return ups.join(modes, "run").join(failed.select("run", "error_type", F.col("object_type").alias("error_object")), "run")


def incomplete_run(t: Tables) -> Warehouse:
    """A sound full run, then a full run in which orders are missing and pages are broken."""
    house, folder = fresh_warehouse(t, "incomplete", t.orders)
    early = F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz")
    land(t, f"{folder}/first", t.orders.where(early))
    key = F.col("o_orderkey")
    land(t, f"{folder}/second", t.orders.where(key % 5 != 0), broken=key % 7 == 0)
    sync_object(t.spark, Feed.under(f"{folder}/first", "orders"), house, mark=datetime(1998, 6, 1))
    second = Feed.under(f"{folder}/second", "orders")
    sync_object(t.spark, second, house, force_full=True, mark=datetime(2002, 1, 1))
    return house


@query("""
    WITH o AS (SELECT *, o_orderdate < TIMESTAMP '1998-06-01' AS early,
                      o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AS seen FROM orders)
    SELECT o_orderkey AS id, false AS deleted,
           CASE WHEN seen THEN '2002-01-01' ELSE '1998-06-01' END AS synced_on,
           o_custkey AS customer, CASE WHEN seen THEN '2002-01-01' ELSE '1998-06-01' END AS edge_synced_on,
           '1998-06-01' AS saved_mark
    FROM o WHERE early OR seen""")
def sync_incomplete_run(t: Tables) -> DataFrame:
    """Nothing is marked, no edge of an unseen record goes, and the mark stays."""
    house = incomplete_run(t)
    edges = house.read("order_customers").select(
        F.col("order_id").alias("id"), F.col("customers_id").alias("customer"), day("fivetran_synced").alias("edge_synced_on")
    )
    saved = house.read("sync_state").agg(day(F.max("last_sync_timestamp")).alias("saved_mark"))
    main = house.read("order").select(
        F.col("hs_object_id").alias("id"),
        F.col("fivetran_deleted").alias("deleted"),
        day("fivetran_synced").alias("synced_on"),
    )
    # One row: the saved mark of one object type.
    return main.join(edges, "id", "left").withColumn("saved_mark", F.lit(saved.first().saved_mark))


@query("""
    SELECT o_orderkey AS id, 'JSONDecodeError' AS error_type, 'unknown' AS class, '2002-01-01' AS rejected_on
    FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 = 0""")
def sync_rejects(t: Tables) -> DataFrame:
    rejects = incomplete_run(t).read("sync_rejects")
    return rejects.select(
        F.regexp_extract("content", '"id":"([0-9]+)"', 1).cast("bigint").alias("id"),
        "error_type",
        "class",
        day("rejected_at").alias("rejected_on"),
    )


def order_page(
    version: str, days: int, archived: bool = False, archived_days: int | None = None, customer: Column | None = None
) -> Column:
    """A page of one order: a version so many days after the order, with a link to ``customer`` if given."""

    def moment(n: int) -> Column:
        at = F.col("o_orderdate") + F.expr(f"INTERVAL {n} DAYS")
        return F.concat(F.replace(at.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))

    props = F.struct(F.lit(version).alias("version"), moment(days).alias("hs_lastmodifieddate"))
    parts = [text("o_orderkey").alias("id"), props.alias("properties"), F.lit(archived).alias("archived")]
    if archived_days is not None:
        parts.append(moment(archived_days).alias("archivedAt"))
    if customer is not None:
        results = F.array(F.struct(customer.cast("string").alias("id"), F.lit("1").alias("type"))).alias("results")
        parts.append(F.struct(F.struct(results).alias("Customers")).alias("associations"))
    return F.to_json(F.struct(F.array(F.struct(*parts)).alias("results")))


def streamed(t: Tables, *landings: Column, edges: bool = False) -> Warehouse:
    """Pages (arrays of lines) of all orders, landed one after the other, taken in small batches."""
    house, folder = fresh_warehouse(t, "pages", t.orders)
    columns = plan_columns([("version", "string"), ("hs_lastmodifieddate", "datetime")])
    carry = ("_ord", "_corrupt", "archivedAt", *(("id", "associations") if edges else ()))
    for lines in landings:
        t.orders.select(F.array_join(F.array_compact(lines), "\n")).write.mode("append").text(f"{folder}/records")
        pages = stream_pages(t.spark, f"{folder}/records", files_per_batch=2)
        stream = stream_upsert(
            flatten_records(pages, columns, datetime(2002, 1, 1), carry=carry), house, "orders", ["hs_object_id"],
            ["hs_lastmodifieddate", "_ord"], f"{folder}/checkpoint", guard="hs_lastmodifieddate",
            archived=F.col("fivetran_deleted"), archived_at=parse_instant(F.col("archivedAt")), rejects="rejects", edges=edges,
        )
        stream.awaitTermination()
    return house


@query("""
    SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'restored' ELSE 'second' END AS version,
           o_orderstatus = 'P' OR o_orderkey % 3 = 1 AND o_orderkey % 2 = 0 AS deleted FROM orders""")
def stream_pages_sync(t: Tables) -> DataFrame:
    """A stream of pages: two versions with one time, archived and restored ones in one file and over
    several, late tombstones of either side of what they meet, and broken pages between."""
    key, none = F.col("o_orderkey"), F.lit(None).cast("string")
    early = F.array(
        order_page("first", 0),
        F.when(key % 7 == 0, F.lit('{"results": [{"id": "1", ')),
        order_page("second", 0),
        # Archived and restored in one file, or archived here and restored in a later one.
        F.when(key % 3 == 0, order_page("gone", 2, archived=True)),
        F.when(key % 6 == 0, order_page("restored", 3)),
        F.when(F.col("o_orderstatus") == "P", order_page("gone", 0, archived=True, archived_days=9)),
    )
    late = F.array(
        F.when(key % 6 == 3, order_page("restored", 3)),
        # A tombstone that is older than the version it meets, and one that is newer.
        F.when(key % 3 == 1, order_page("gone", -1, archived=True)),
        F.when((key % 3 == 1) & (key % 2 == 0), order_page("gone", 1, archived=True)),
        none,
    )
    return streamed(t, early, late).read("orders").select(
        F.col("hs_object_id").alias("id"), "version", F.col("fivetran_deleted").alias("deleted")
    )


@query("""
    SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey + 1 ELSE o_custkey END AS customer_id,
           CASE WHEN o_orderkey % 2 = 0 THEN 'second' ELSE 'first' END AS version,
           (SELECT count(*) FROM orders WHERE o_orderkey % 7 = 0) AS rejects FROM orders""")
def stream_edges_sync(t: Tables) -> DataFrame:
    """One stream into main table, edges and rejects: a newer version takes its links along, an older one
    that comes later does not."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    early = F.array(order_page("first", 5, customer=customer), F.when(key % 7 == 0, F.lit('{"results": [{"id": "1", ')))
    late = F.array(
        F.when(key % 2 == 0, order_page("second", 6, customer=customer + 1)),
        F.when(key % 2 == 1, order_page("stale", 4, customer=customer + 2)),
    )
    house = streamed(t, early, late, edges=True)
    edges = house.read("orders_customers").select(F.col("orders_id").alias("order_id"), F.col("customers_id").alias("customer_id"))
    versions = house.read("orders").select(F.col("hs_object_id").alias("order_id"), "version")
    # One row: the number of rejects.
    rejects = house.read("rejects").count()
    return edges.join(versions, "order_id").withColumn("rejects", F.lit(rejects).cast("bigint"))


@query("""
    SELECT event_id, '{"kind":"' || event_type || '","user":' || user_id || '}' AS nested FROM events""")
def nested_property(t: Tables) -> DataFrame:
    """A nested value in JSON text stays JSON text."""
    nested = F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("user"))
    records = t.events.select(
        text("event_id").alias("id"),
        F.to_json(F.struct(nested.alias("nested"))).alias("properties"),
        F.lit("false").alias("archived"),
    )
    flat = flatten_records(records, plan_columns([("nested", "string")]), datetime(2002, 1, 1))
    return flat.select(F.col("hs_object_id").alias("event_id"), "nested")


def linked_run(t: Tables) -> Warehouse:
    """A full run with link batches and with pipelines and stages made of regions and nations."""
    house, folder = fresh_warehouse(t, "linked", t.orders)
    land(t, folder, t.orders)
    none = F.lit(None).cast("string")
    kinds = F.array(
        *[F.struct(F.lit(k).alias("typeId"), c.alias("category")) for k, c in (("7", none), ("8", F.lit("USER")))]
    )
    batch = F.struct(
        F.struct(text("o_orderkey").alias("id")).alias("from"),
        F.array(F.struct(text("o_custkey").alias("toObjectId"), kinds.alias("associationTypes"))).alias("to"),
    )
    pages = t.orders.select(F.to_json(F.struct(F.array(batch).alias("results"))))
    pages.write.text(f"{folder}/orders/links/to_type=2-9")
    stage = F.struct(text("n_nationkey").alias("id"), F.col("n_name").alias("label"))
    trees = (
        t.nation.groupBy("n_regionkey").agg(F.collect_list(stage).alias("stages")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    tree = F.struct(text("r_regionkey").alias("id"), F.col("r_name").alias("label"), "stages")
    trees.select(F.to_json(F.struct(F.array(tree).alias("results")))).write.text(f"{folder}/orders/pipelines")
    sync_object(t.spark, Feed.under(folder, "orders"), house, mark=datetime(2002, 1, 1))
    return house


@query("""
    SELECT o_orderkey AS order_id, o_custkey AS target_id, k.type_id, k.category FROM orders,
    (VALUES ('7', 'HUBSPOT_DEFINED'), ('8', 'USER')) AS k(type_id, category)""")
def sync_link_batches(t: Tables) -> DataFrame:
    return linked_run(t).read("order_2_9").select(
        "order_id", F.col("`2_9_id`").alias("target_id"), "type_id", "category"
    )


def link_page(target: Column) -> Column:
    """A link page of one order: to ``target``, or without links where that is null."""
    kinds = F.array(F.struct(F.lit("7").alias("typeId")))
    to = F.struct(target.cast("string").alias("toObjectId"), kinds.alias("associationTypes"))
    batch = F.struct(
        F.struct(text("o_orderkey").alias("id")).alias("from"),
        F.filter(F.array(to), lambda x: x["toObjectId"].isNotNull()).alias("to"),
    )
    return F.to_json(F.struct(F.array(batch).alias("results")))


@query("""
    WITH o AS (SELECT *, o_orderdate < TIMESTAMP '1998-06-01' AS early FROM orders)
    SELECT o_orderkey AS order_id, 'customers' AS to_type, o_custkey AS to_id FROM o
    UNION ALL
    SELECT o_orderkey, '2_9', CASE WHEN o_orderkey % 5 = 0 AND o_orderstatus <> 'P' THEN o_custkey + 1 ELSE o_custkey END
    FROM o WHERE CASE WHEN o_orderstatus = 'P' THEN early ELSE NOT (o_orderkey % 5 <> 0 AND o_orderkey % 7 = 0) END""")
def sync_edges_incremental(t: Tables) -> DataFrame:
    """Link pages of all orders land before the late ones come; later ones tell other links, or none, of
    orders most of which have not changed. Every order's own link to its customer stays throughout. Orders that
    are archived by then keep what they had."""
    house, folder = fresh_warehouse(t, "edges", t.orders)
    early = F.col("o_orderdate") < F.lit(SPLIT).cast("timestamp_ntz")
    land(t, f"{folder}/first", t.orders.where(early))
    land(t, f"{folder}/second", t.orders)
    t.orders.select(link_page(F.col("o_custkey"))).write.text(f"{folder}/first/orders/links/to_type=2-9")
    key = F.col("o_orderkey")
    told = F.when(key % 5 == 0, F.col("o_custkey") + 1)
    later = t.orders.where((key % 5 == 0) | (key % 7 == 0)).select(link_page(told))
    later.write.text(f"{folder}/second/orders/links/to_type=2-9")
    sync_object(t.spark, Feed.under(f"{folder}/first", "orders"), house, mark=datetime(1998, 6, 1))
    sync_object(t.spark, Feed.under(f"{folder}/second", "orders"), house, mark=datetime(2002, 1, 1))
    inline = house.read("order_customers").select("order_id", F.lit("customers").alias("to_type"), F.col("customers_id").alias("to_id"))
    fed = house.read("order_2_9").select("order_id", F.lit("2_9").alias("to_type"), F.col("`2_9_id`").alias("to_id"))
    return inline.union(fed)


@query("""
    SELECT r_regionkey::VARCHAR AS pipeline_id, r_name AS pipeline, n_nationkey::VARCHAR AS stage_id, n_name AS stage
    FROM nation JOIN region ON n_regionkey = r_regionkey""")
def sync_pipeline_stages(t: Tables) -> DataFrame:
    house = linked_run(t)
    pipelines = house.read("order_pipeline").select("pipeline_id", F.col("label").alias("pipeline"))
    stages = house.read("order_pipeline_stage").select("pipeline_id", "stage_id", F.col("label").alias("stage"))
    return stages.join(pipelines, "pipeline_id").select("pipeline_id", "pipeline", "stage_id", "stage")
