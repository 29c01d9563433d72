"""One object type from landed pages to published tables, and many of them in a row."""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import parse_id, parse_instant
from tidemark.functions.naming import (
    ColumnPlan,
    edge_columns,
    fit_names,
    normalize_expr,
    normalize_name,
    plan_columns,
)
from tidemark.meta import EDGE_ORIGIN, EDGE_PLACE, INLINE, RAW, MetaColumns
from tidemark.operators import edges as E
from tidemark.operators import hierarchy as H
from tidemark.operators import merge as M
from tidemark.operators import profile as P
from tidemark.operators import resolve as R
from tidemark.operators import state as S
from tidemark.operators import tombstones as X
from tidemark.operators.evolve import align, new_columns
from tidemark.operators.records import (
    REJECT,
    at,
    declare_late,
    failure_rows,
    flatten_records,
    reject_rows,
    run_mark,
    split_rejects,
)
from tidemark.plans.warehouse import Warehouse
from tidemark.session import collect_catalog, write_once
from tidemark.sources import pages as G


@dataclass(frozen=True)
class Feed:
    """Where the pages of one object type have landed."""

    object_type: str
    records: str
    properties: str
    schema: str
    schemas: str
    links: str
    pipelines: str
    archived: str

    @classmethod
    def under(cls, root: str, object_type: str) -> Feed:
        base = f"{root.rstrip('/')}/{object_type}"
        kinds = ["records", "properties", "schema", "links", "pipelines", "archived"]
        paths = {kind: f"{base}/{kind}" for kind in kinds}
        return cls(object_type, schemas=f"{root.rstrip('/')}/schemas", **paths)


@dataclass(frozen=True)
class Catalog:
    """What a run knows about an object type before it reads a record."""

    table: str
    columns: list[ColumnPlan]
    link_names: DataFrame
    trees: DataFrame


def _own_schema(spark: SparkSession, path: str) -> DataFrame:
    shaped = T.StructType.fromDDL(G.OBJECT_SCHEMA.removeprefix("struct<").removesuffix(">"))
    try:
        df = spark.read.schema(shaped).json(path)
    except G.AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], shaped)
    return df.select(
        F.col("objectTypeId").alias("type_id"),
        "name",
        "associations",
        F.monotonically_increasing_id().alias("_ord"),
    )


def read_catalog(spark: SparkSession, feed: Feed, meta: MetaColumns = MetaColumns()) -> Catalog:
    listed = G.explode_results(G.read_pages(spark, feed.properties, G.PROPERTY))
    declared = sorted(collect_catalog(G.property_catalog(listed)), key=lambda r: r["_first"])

    own = _own_schema(spark, feed.schema)
    named = own.where(F.col("name") != "").select(F.lower("name").alias("name")).take(1)
    table = normalize_name(named[0].name if named else feed.object_type)

    trees = G.explode_results(G.read_pages(spark, feed.pipelines, G.PIPELINE))
    stages = trees.select("_ord", F.posexplode("stages").alias("_at", "s")).select(
        F.col("s.id").alias("stage_id"), F.struct("_ord", "_at").alias("stage_ord")
    )
    rename = {}
    if not stages.isEmpty():
        names = spark.createDataFrame([(r.name,) for r in declared], "name string")
        rename = {r.property: r.renamed for r in collect_catalog(H.stage_rename_map(names, stages))}

    everyone = G.explode_results(G.read_pages(spark, feed.schemas, G.OBJECT_SCHEMA)).select(
        F.col("objectTypeId").alias("type_id"), "name", "_ord"
    )
    targets = G.association_targets(own).select(F.col("to_type_id").alias("type_id"))
    link_names = R.resolve_names(
        targets, R.names_from_associations(own), R.names_from_schemas(everyone)
    )
    columns = plan_columns([(r.name, r.type) for r in declared], rename, meta)
    return Catalog(table, columns, link_names, trees)


LINK = ["from_id", "to_type", "to_id", "type_id", "category", EDGE_ORIGIN]


@dataclass(frozen=True)
class Links:
    """What link pages say: their links, every (from_id, origin) that they name, and unreadable pages."""

    found: DataFrame
    told: DataFrame
    unreadable: DataFrame


def read_links(
    spark: SparkSession,
    feed: Feed,
    names: DataFrame,
    landed_after: str | None = None,
    files: list[str] | None = None,
) -> Links:
    """Link-batch pages, which land per target type id (``to_type=<id>`` folders), parsed once.

    For each record and target type that file counts which landed last; what one file says adds up.
    """
    pages = G.read_pages(spark, feed.links, G.LINK_BATCH, landed_after=landed_after, landed=True, files=files)
    if "to_type" not in pages.columns:
        pages = pages.withColumn("to_type", F.lit(None).cast("string"))
    raw = F.col("to_type").cast("string")
    origin = F.concat(F.lit("feed "), F.coalesce(raw, F.lit(""))).alias(EDGE_ORIGIN)
    results = F.posexplode_outer("results").alias("_pos", "_result")
    each = pages.select(raw.alias("_type_id"), origin, "_landed", "_corrupt", "_page", results)
    each = each.withColumn("_corrupt", F.when(F.coalesce("_pos", F.lit(0)) == 0, F.col("_corrupt")))
    batches = each.select("_result.*", "_type_id", EDGE_ORIGIN, "_landed", "_corrupt", F.struct("_page", "_pos").alias("_ord"))
    carry = ("_type_id", EDGE_ORIGIN, "_landed", "_corrupt")
    rows = E.flatten_links(batches, F.lit(None).cast("string"), carry=carry).drop("to_type")
    staged = write_once(rows.where("from_id IS NOT NULL OR _corrupt IS NOT NULL"), "links")

    broken = staged.where("_corrupt IS NOT NULL").select(F.col("_ord._rec").alias("_ord"), "_corrupt").distinct()
    said = staged.where("from_id IS NOT NULL").withColumn("_file", F.struct("_landed", "_ord._rec._page.file"))
    # Files by number, one row each: the numbers are compared and kept as such, not the names.
    files = said.select("_file").distinct().withColumn("_nth", F.row_number().over(Window.orderBy("_file")))
    said = said.join(write_once(files, "link-files"), "_file").drop("_file")
    told = said.groupBy("from_id", EDGE_ORIGIN).agg(F.max("_nth").alias("_last"), F.min("_nth").alias("_first"))
    told = write_once(told, "told-links")
    last = said.where("to_id IS NOT NULL")
    # Links that several files tell of are few, if any: the others need not meet their file.
    torn = told.where("_first < _last").drop("_first")
    if not torn.isEmpty():
        torn = write_once(torn, "torn-links")
        last = last.join(torn, ["from_id", EDGE_ORIGIN], "left").where("_last IS NULL OR _nth = _last")
    # Type names meet the links by a join: there may be any number of link types.
    named = names.select(F.col("type_id").alias("_type_id"), normalize_expr(F.col("name")).alias("_type_name"))
    found = last.join(named.dropDuplicates(["_type_id"]), "_type_id", "left")
    found = found.withColumn("to_type", F.coalesce("_type_name", normalize_expr(F.col("_type_id"))))
    return Links(found.select(*LINK, "_ord"), told.select("from_id", EDGE_ORIGIN), broken)


def publish_pipelines(house: Warehouse, catalog: Catalog, mark: datetime, meta: MetaColumns) -> tuple[int, int]:
    """Replace pipelines and stages together; without pipelines both stay as they are."""
    if catalog.trees.isEmpty():
        return 0, 0
    pipelines = H.flatten_pipelines(catalog.trees, mark, meta)
    stages = H.flatten_stages(catalog.trees, mark, meta)
    if not H.orphan_stages(stages, pipelines).isEmpty():
        raise ValueError("stages without a pipeline")
    p = house.publish(pipelines, f"{catalog.table}_pipeline", ["pipeline_id"])
    s = house.publish(stages, f"{catalog.table}_pipeline_stage", ["pipeline_id", "stage_id"])
    return p.count(), s.count()


def publish_edges(
    house: Warehouse,
    table: str,
    found: DataFrame,
    touched: DataFrame | None,
    whole: bool = False,
    meta: MetaColumns = MetaColumns(),
    source: str = "",
) -> int:
    """All edges of the object in one table, and a view per target type under its own names.

    ``found`` is a written table. A ``whole`` load replaces the table; any other one replaces what it ``touched``: a record's edges of
    one origin, whether it brought links for them or not. Without ``touched`` no edge goes. The views
    show an edge once, however many origins tell of it.
    """
    name = f"{table}_edges"
    fresh = E.dedupe_written_edges(found)
    current = house.read(name)
    if current is not None and EDGE_ORIGIN not in current.columns:
        current = current.withColumn(EDGE_ORIGIN, F.lit(INLINE))
    merge = current is not None and not whole
    placed = merge and touched is not None
    if merge and touched is None:
        # An empty folder name reads back as null, which would meet nothing.
        held, load = (d.withColumn("to_type", F.coalesce("to_type", F.lit(""))) for d in (current, E.salted(fresh)))
        fresh = E.merge_edges(held, align(load, current.schema))
    elif merge:
        fresh = E.salted(fresh).repartition(house.buckets, *EDGE_PLACE)
        fresh = E.replace_edges_of(current, fresh, touched)
    else:
        fresh = E.salted(fresh)
    # The views are planned before anything is switched.
    held = fresh if current is None else current.select("to_type").union(found.select("to_type"))
    listed = collect_catalog(held.select("to_type").distinct())
    types = sorted({r.to_type or "" for r in listed})
    taken = [name, f"{table}_pipeline", f"{table}_pipeline_stage", f"{table}_links_waiting"]
    views = fit_names([f"{table}_{t}" for t in types], taken=taken)
    house.publish(fresh, name, EDGE_PLACE, source=source, placed=placed, partition_by=["to_type"])
    for to_type, view in zip(types, views):
        from_col, to_col = edge_columns(table, to_type)
        # An empty folder name reads back as null.
        of_type = f"to_type = '{to_type}'" if to_type else "to_type IS NULL"
        house.spark.sql(
            f"CREATE OR REPLACE VIEW {house.qualified(view)} AS SELECT from_id AS `{from_col}`,"
            f" to_id AS `{to_col}`, type_id, max_by(category, struct(`{meta.synced}`, {EDGE_ORIGIN} <> '{INLINE}'))"
            f" AS category, max(`{meta.synced}`) AS `{meta.synced}`"
            f" FROM {house.qualified(name)} WHERE {of_type} GROUP BY from_id, _salt, to_id, type_id"
        )
    return len(types)


class Landed:
    """The landed files of one run, by kind, as they were listed at its start.

    A run opens the files that its log says it needs (see :func:`~tidemark.operators.state.files_to_open`) and
    notes at its end, if it is complete, those that it read for the first time. Their names pass the
    driver, as they do in any scan.
    """

    def __init__(self, house: Warehouse, feed: Feed) -> None:
        self.house, self.feed = house, feed
        self.listed: dict[str, DataFrame] = {}

    def choose(self, kind: str, since: datetime | None) -> list[str] | None:
        """Paths to read of one kind; ``None`` for all there are."""
        seen = self.house.log("sync_files", S.FILES)
        seen = seen.where((F.col("object_type") == self.feed.object_type) & (F.col("kind") == kind))
        files = S.files_to_open(G.list_files(self.house.spark, getattr(self.feed, kind)), seen, since)
        self.listed[kind] = write_once(files, f"files-{kind}")
        return [r.path for r in self.listed[kind].where("wanted").select("path").collect()]

    def note(self, zones: DataFrame) -> None:
        for kind, files in self.listed.items():
            own = files.where("unseen").drop("unseen", "wanted", "path")
            own = own.join(zones if kind == "records" else zones.limit(0), "file", "left")
            rows = own.select(
                F.lit(self.feed.object_type).alias("object_type"), F.lit(kind).alias("kind"), *S.FILE_KEY,
                F.coalesce("records", F.lit(0)).alias("records"), "oldest", "newest",
                F.coalesce("undated", F.lit(0)).alias("undated"),
            )
            self.house.append(rows, "sync_files", S.FILES)


def sync_object(
    spark: SparkSession,
    feed: Feed,
    house: Warehouse,
    force_full: bool = False,
    max_changes: int | None = None,
    mark: datetime | None = None,
    overlap: timedelta | None = timedelta(days=1),
    meta: MetaColumns = MetaColumns(),
    keep_raw: bool = False,
    by_file: bool = False,
) -> Row:
    """Bring one object's tables up to date and return its run summary.

    Data is published first and the mark saved last, so a failed run is simply repeated. All
    counters are read off written tables and stay right when tasks are retried.

    An incremental run opens only files that landed since the saved mark less ``overlap`` (all, if
    that is ``None``). Rows without a readable change time count as changed. Unreadable pages (of
    records, links or, in an incremental run, archived records) and
    unusable ids go to ``sync_rejects``; a run that met any is incomplete: it marks no vanished rows,
    replaces only edges of records that it saw (none, if a link page was unreadable), and leaves the mark
    where it was, so the next run reads the same span again. A full load without a row changes neither records
    nor edges. Links from pages join any live record of the table; those of records that are not there
    wait in ``<table>_links_waiting`` for a later run.

    With ``keep_raw`` the table keeps all properties of a record, declared or not, in a ``VARIANT`` column;
    a property that a later run finds declared is filled from it. A table that has the column keeps it.

    With ``by_file`` the times at which files landed do not matter and ``overlap`` is not used: ``sync_files``
    keeps a row for each file that complete runs have read, with the span of change times in it, and a
    run opens the files that are not there or hold changes since the mark. Files of links and archived
    records are read once; a file counts as landed when it is first seen.
    """
    started = time.monotonic()
    mark = mark or run_mark()
    catalog = read_catalog(spark, feed, meta)
    since = S.last_mark(house.log("sync_state", S.STATE), feed.object_type)

    files = Landed(house, feed)
    modified = parse_instant(F.get_json_object("properties", f"$.{meta.modified}"))

    def landed(after: str | None, since: datetime | None = None) -> DataFrame:
        chosen = files.choose("records", since) if by_file else None
        pages = G.read_pages(spark, feed.records, landed_after=after, files=chosen)
        records = G.active_records(G.explode_results(pages, keep_unreadable=True))
        return records.withColumn("_modified", modified) if by_file else records

    mode, after = S.choose_mode(since, force_full=force_full), None
    if mode == "incremental":
        after = (since - overlap).strftime("%Y-%m-%dT%H:%M:%S") if overlap is not None and not by_file else None
        records = opened = landed(after, since)
        records = S.modified_since(records, modified, since, undated=True)
        mode = S.choose_mode(since, S.exceeds(records, max_changes))
    if mode == "full":
        after = None
        records = opened = landed(None)

    target = house.read(catalog.table)
    raw = keep_raw or (target is not None and RAW in target.columns)
    # The pages are parsed once; everything after reads this table.
    carry = ("id", "associations", "_ord", "_corrupt")
    if by_file:
        # The span of change times in a file is that of all its records.
        flat = flatten_records(opened, catalog.columns, mark, meta, carry=(*carry, "_modified"), raw=raw)
        everything = write_once(flat, "staged")
        staged = everything
        if mode == "incremental":
            staged = S.modified_since(staged, F.col("_modified"), since, undated=True)
        staged = staged.drop("_modified")
    else:
        flat = flatten_records(records, catalog.columns, mark, meta, carry=carry, raw=raw)
        staged = write_once(flat, "staged")
    good, _ = split_rejects(staged)
    load = M.keep_last_written(good.drop("id", "associations", "_corrupt"), [meta.id], ["_ord"]).drop("_ord")
    tally = staged.agg(
        F.count(F.lit(1)).alias("fetched"),
        F.count_if(F.col("_bad_id").isNotNull() | F.col("_corrupt").isNotNull()).alias("failed"),
    ).first()
    # A mark of the far future: only files that were never read.
    unread_only = datetime.max if mode == "incremental" else None
    link_files = files.choose("links", unread_only) if by_file else None
    links = read_links(spark, feed, catalog.link_names, after, link_files)
    unread = links.unreadable.withColumn("of_links", F.lit(True))
    if mode == "incremental":
        gone_files = files.choose("archived", unread_only) if by_file else None
        archived = G.read_pages(spark, feed.archived, landed_after=after, files=gone_files)
        archived = write_once(G.explode_results(archived, keep_unreadable=True), "archived")
        broken = archived.where("_corrupt IS NOT NULL AND coalesce(_ord._pos, 0) = 0").select("_ord", "_corrupt")
        unread = unread.union(broken.withColumn("of_links", F.lit(False)))
    unread = unread.withColumn("_bad_id", F.lit(None).cast("string"))
    pages = unread.agg(F.count(F.lit(1)).alias("n"), F.count_if("of_links").alias("of_links")).first()
    fetched, failed = tally.fetched, tally.failed + pages.n
    complete = failed == 0
    if failed:
        rejects = reject_rows(staged, feed.object_type, mark)
        rejects = rejects.unionByName(reject_rows(unread, feed.object_type, mark))
        house.append(rejects, "sync_rejects", REJECT)

    pipelines, stages = publish_pipelines(house, catalog, mark, meta)

    added = []
    if target is None:
        new = load
    else:
        added = new_columns(target.schema, load.schema)
        target = declare_late(target, catalog.columns)
        load = align(load, target.schema)
        if mode == "incremental":
            gone = X.archived_since(archived, since, meta)
            new = M.apply_changes(target, load, gone, mark, meta)
        elif complete:
            new = M.full_sync(target, load, mark, meta, seen=good)
        else:
            new = M.upsert(target, load, [meta.id])
    published = house.publish(new, catalog.table, [meta.id], placed=target is not None)

    whole = mode == "full" and complete
    waiting = None if whole else house.read(f"{catalog.table}_links_waiting")
    live = published.where(~F.col(meta.deleted)).select(meta.id)
    linked, spoken, later = E.settle_links(links.found, links.told, waiting, live, meta.id)
    inline = E.normalize_edges(good).withColumn(EDGE_ORIGIN, F.lit(INLINE))
    found = E.usable_edges(inline.unionByName(linked)).withColumn(meta.synced, at(mark))
    found = write_once(found, "edges")
    # Records whose links this run has read, even if there were none.
    told = good.where(F.ltrim("associations").startswith("{")).select(parse_id(F.col("id")).alias("from_id"))
    told = told.where("from_id is not null").withColumn(EDGE_ORIGIN, F.lit(INLINE))
    touched = told.union(spoken) if not pages.of_links else None
    seen = not good.isEmpty()
    tables = 0
    # A full load without a record is taken for a failed read.
    if seen or mode == "incremental" or house.read(f"{catalog.table}_edges") is None:
        tables = publish_edges(house, catalog.table, found, touched, whole and seen, meta)
        later = write_once(later.select(*LINK).distinct(), "links-waiting")
        if house.exists(f"{catalog.table}_links_waiting") or not later.isEmpty():
            house.publish(later, f"{catalog.table}_links_waiting", ["from_id"])

    of_run = published.where(F.col(meta.synced) == at(mark))
    counts = of_run.agg(
        F.count_if(F.col(meta.deleted)).alias("deleted"),
        F.count_if(~F.col(meta.deleted)).alias("live"),
    ).first()
    summary = Row(
        object_type=feed.object_type,
        status="healthy" if complete else "with_errors",
        duration_seconds=round(time.monotonic() - started, 2),
        records_fetched=fetched,
        records_processed_ok=fetched - tally.failed,
        records_failed=failed,
        db_upserts=counts.live,
        db_insert_errors=0,
        pipelines_loaded=pipelines,
        stages_loaded=stages,
        association_tables_created=tables,
        associations_found=found.count(),
        schema_changes=len(added),
        columns_truncated=sum(c.truncated for c in catalog.columns),
        records_deleted=counts.deleted,
        sync_mode=mode,
        finished_at=run_mark(),
    )
    if complete:
        state = spark.createDataFrame([(feed.object_type, fetched, mode)], "o string, n bigint, m string")
        saved = at(mark).cast("timestamp")
        house.append(
            state.select("o", saved.alias("t"), "n", "m", F.current_timestamp().alias("u")),
            "sync_state",
            S.STATE,
        )
        if by_file:
            files.note(S.file_zones(everything))
    house.append(spark.createDataFrame([summary], P.SUMMARY), "sync_runs", P.SUMMARY)
    _log_health(house, summary, catalog, good)
    return summary


def _log_health(house: Warehouse, summary: Row, catalog: Catalog, good: DataFrame) -> None:
    """The load's emptiest columns, and the names that were cut, of one run."""
    spark = house.spark
    of_run = [F.lit(summary.object_type).alias("object_type"), at(summary.finished_at).alias("finished_at")]
    columns = [c.final for c in catalog.columns]
    if columns:
        top = P.top_null_columns(P.null_profile(good, columns))
        house.append(top.select(*of_run, "column", "null_count", "pct", "alert"), "sync_nulls", P.NULLS)
    cut = [(c.normalized, c.final) for c in catalog.columns if c.truncated]
    if cut:
        names = spark.createDataFrame(cut, "original string, final string")
        house.append(names.select(*of_run, "original", "final"), "sync_truncated", P.TRUNCATED)


def sync_all(
    spark: SparkSession, root: str, object_types: list[str], house: Warehouse, **options
) -> tuple[list[Row], list[dict[str, str]]]:
    """Sync object types one after the other; a failing one does not stop the rest.

    A failure goes to ``sync_rejects`` with its class, and ``sync_rollups`` gets one row for them all.
    """
    done, errors = [], []
    for object_type in object_types:
        try:
            done.append(sync_object(spark, Feed.under(root, object_type), house, **options))
        except Exception as error:  # noqa: BLE001 - reported per object
            errors.append(
                {"object_type": object_type, "error": type(error).__name__, "detail": str(error)}
            )
    mark = run_mark()
    if errors:
        told = spark.createDataFrame([(e["object_type"], e["error"], e["detail"]) for e in errors], "o string, e string, d string")
        house.append(failure_rows(told, F.col("o"), F.col("e"), F.col("d"), mark), "sync_rejects", REJECT)
    runs = P.roll_up(spark.createDataFrame(done, P.SUMMARY))
    failed = F.lit(len(errors)).cast("long")
    row = runs.select(
        at(mark).alias("finished_at"),
        (F.coalesce("all_healthy", F.lit(True)) & (failed == 0)).alias("all_healthy"),
        (F.col("objects") + failed).alias("objects"),
        F.coalesce("records_processed_ok", F.lit(0)).alias("records_processed_ok"),
        F.coalesce("records_failed", F.lit(0)).alias("records_failed"),
        failed.alias("objects_failed"),
    )
    house.append(row, "sync_rollups", P.ROLL_UP)
    return done, errors
