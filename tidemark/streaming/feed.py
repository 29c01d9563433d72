"""Continuous upkeep of a table from a stream of versions of its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.meta import EDGE_ORIGIN, INLINE, MetaColumns
from tidemark.operators.edges import normalize_edges, usable_edges
from tidemark.operators.merge import apply_changes, apply_versions, keep_last, newest_tombstones, upsert
from tidemark.operators.records import REJECT, at, instant, reject_rows, run_mark
from tidemark.operators.tombstones import mark_listed
from tidemark.plans.sync import publish_edges
from tidemark.plans.warehouse import Warehouse
from tidemark.session import scratch_scope, write_once
from tidemark.sources.pages import RECORD, page_type

#: What rows may carry besides the table's columns.
HELPERS = ("_ord", "archivedAt")


def stream_pages(spark: SparkSession, path: str, result: str = RECORD, files_per_batch: int = 1000) -> DataFrame:
    """Landed pages as a stream; results keep their file.

    A page that cannot be read comes as a row of its own with its text in ``_corrupt``. The order of
    results within a file is that in which the rows of a micro-batch come (see :func:`stream_upsert`).
    """
    pages = (
        spark.readStream.schema(page_type(result))
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )
    page = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )
    placed = pages.select(
        page.alias("_page"), "_corrupt", F.posexplode_outer("results").alias("_pos", "_result")
    ).where(F.col("_pos").isNotNull() | F.col("_corrupt").isNotNull())
    return placed.select("_result.*", F.struct("_page").alias("_ord"), "_corrupt")


def drop_repeats(rows: DataFrame, unique: list[str], within: str) -> DataFrame:
    """The stream without rows whose ``unique`` columns have come before, up to ``within`` (an interval) ago.

    The state holds a key for ``within`` from its first arrival and no longer, so it does not grow with the
    stream; what comes again after that is left to the merge behind (see ``guard`` in :func:`stream_upsert`).
    Time is the time of the micro-batch, not a time in the data: so no row is ever too late, and rows
    without a time are like any other. Nulls in ``unique`` equal each other.
    """
    arrived = rows.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
    return arrived.dropDuplicatesWithinWatermark(unique).drop("_arrived")


def stream_upsert(
    rows: DataFrame,
    house: Warehouse,
    table: str,
    keys: list[str],
    order: list[str],
    checkpoint: str,
    guard: str | None = None,
    archived: Column | None = None,
    archived_at: Column | None = None,
    meta: MetaColumns = MetaColumns(),
    available_now: bool = True,
    rejects: str | None = None,
    edges: bool = False,
) -> StreamingQuery:
    """Start upserting a stream into ``house``.``table``; late rows lose against ``guard``.

    Each micro-batch is reduced to its last row per key and merged; rows that tie in ``order`` rank by
    their place in the batch, which within a file is that in the file. With ``rejects`` rows that carry
    ``_bad_id`` or ``_corrupt`` go to that table instead.

    Rows for which ``archived`` holds only mark their target row as deleted; such a table is keyed by its
    id column. With ``guard`` a tombstone has the time ``archived_at``, else that of ``guard``, else the
    time at which it is read, and deletes the versions up to that time; tombstones are kept in
    ``<table>_archived``, so versions and tombstones may come in any order and any batches. Without
    ``guard`` the last to come decides.

    With ``edges`` the rows carry ``id``, ``associations`` and ``_ord``; links of the versions that the table
    takes replace those that earlier versions told of, in the edge table and its views.

    Every table that is published names the batch that it has last taken, and every reject its batch; a
    batch that is replayed after a failure goes on where it had stopped.
    """
    if archived is not None and keys != [meta.id]:
        raise ValueError(f"archived rows need the key {meta.id}")
    spark = rows.sparkSession

    def publish(new: DataFrame, name: str, source: str) -> None:
        house.publish(new, name, keys, source=source, placed=house.exists(name))

    def in_buckets(rows: DataFrame) -> DataFrame:
        # An aggregate leaves its rows in as many partitions as the session shuffles to; without this a join
        # would move the written table there instead of these few rows to its buckets.
        return rows.repartition(house.buckets, *keys)

    def merged(live: DataFrame, batch: DataFrame, target: DataFrame | None, source: str) -> DataFrame:
        mark = run_mark()
        if archived is None:
            return live if target is None else upsert(target, live, keys, guard)
        if guard is None:
            last = keep_last(batch, keys, [*order, "_seq"])
            gone = last.where(archived).select(meta.id)
            return mark_listed(live, gone, mark, meta) if target is None else apply_changes(target, live, gone, mark, meta)
        told = archived_at if archived_at is not None else F.lit(None).cast("timestamp")
        when = F.coalesce(told, F.col(guard), instant(mark)).alias("gone_at")
        gone, name = batch.where(archived).select(meta.id, when), f"{table}_archived"
        if house.source(name) != source and (house.exists(name) or not gone.isEmpty()):
            latest = in_buckets(newest_tombstones(None, gone, meta.id))
            publish(newest_tombstones(house.read(name), latest, meta.id), name, source)
        tombstones = house.read(name)
        if tombstones is None:
            return live if target is None else upsert(target, live, keys, guard)
        return apply_versions(target, live, tombstones, guard, mark, meta)

    def take_edges(load: DataFrame, target: DataFrame | None, source: str) -> None:
        """Links of the versions that the target takes, or has just taken."""
        if house.source(f"{table}_edges") == source:
            return
        if target is not None and guard is not None:
            held = target.select(F.col(meta.id).alias("_key"), F.col(guard).alias("_held"))
            newer = F.col("_held").isNull() | F.coalesce(F.col(guard) >= F.col("_held"), F.lit(False))
            load = load.join(held, F.col(meta.id) == F.col("_key"), "left").where(newer)
        found = usable_edges(normalize_edges(load)).withColumn(EDGE_ORIGIN, F.lit(INLINE))
        found = write_once(found.withColumn(meta.synced, at(run_mark())), "edges")
        told = load.where(F.ltrim("associations").startswith("{")).select(F.col(meta.id).alias("from_id"))
        publish_edges(house, table, found, told.withColumn(EDGE_ORIGIN, F.lit(INLINE)), meta=meta, source=source)

    def apply(batch: DataFrame, batch_id: int) -> None:
        source = f"{checkpoint}#{batch_id}"
        if house.source(table) == source:
            return
        with scratch_scope(spark):
            batch = write_once(batch.withColumn("_seq", F.monotonically_increasing_id()), "micro-batch")
            if rejects:
                # One append, which is there as a whole or not at all.
                if house.log(rejects, REJECT).where(F.col("source") == source).isEmpty():
                    house.append(reject_rows(batch, table, run_mark(), source), rejects, REJECT)
                batch = batch.where("_bad_id IS NULL").drop("_bad_id", "_corrupt")
            live = batch if archived is None else batch.where(~archived)
            load = keep_last(live, keys, [*order, "_seq"]).drop("_seq")
            target = house.read(table)
            if edges:
                load = write_once(load, "last-versions")
                take_edges(load, target, source)
                load = load.drop("id", "associations")
            publish(merged(in_buckets(load.drop(*HELPERS)), batch, target, source), table, source)

    writer = rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
