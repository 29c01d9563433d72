"""Soft deletes: rows that vanished from a full load, rows named by an archive feed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import parse_id, parse_instant
from tidemark.meta import MetaColumns
from tidemark.operators.records import at, instant
from tidemark.sources.pages import is_archived


def _mark(target: DataFrame, doomed: Column, mark: datetime, meta: MetaColumns) -> list[Column]:
    hit = doomed & ~F.col(meta.deleted).eqNullSafe(True)
    new = {
        meta.deleted: F.when(hit, F.lit(True)).otherwise(F.col(meta.deleted)),
        meta.synced: F.when(hit, at(mark)).otherwise(F.col(meta.synced)),
    }
    return [new[c].alias(c) if c in new else F.col(c) for c in target.columns]


def _flagged(target: DataFrame, ids: DataFrame, meta: MetaColumns) -> DataFrame:
    listed = ids.select(F.col(meta.id).alias("_listed")).distinct()
    return target.join(listed, F.col(meta.id) == F.col("_listed"), "left")


def mark_absent(
    target: DataFrame, ids: DataFrame, mark: datetime, meta: MetaColumns = MetaColumns()
) -> DataFrame:
    """Mark live rows whose id is not among ``ids``; no ids at all mark nothing."""
    if ids.isEmpty():
        return target
    doomed = F.col("_listed").isNull()
    return _flagged(target, ids, meta).select(*_mark(target, doomed, mark, meta))


def mark_listed(
    target: DataFrame, ids: DataFrame, mark: datetime, meta: MetaColumns = MetaColumns()
) -> DataFrame:
    """Mark live rows whose id is among ``ids``."""
    doomed = F.col("_listed").isNotNull()
    return _flagged(target, ids, meta).select(*_mark(target, doomed, mark, meta))


def archived_since(
    records: DataFrame, since: datetime | None, meta: MetaColumns = MetaColumns()
) -> DataFrame:
    """Ids of archived records newer than ``since``; an unknown archive time counts as newer."""
    when = parse_instant(F.col("archivedAt"))
    newer = F.lit(True) if since is None else when.isNull() | (when > instant(since))
    ids = records.where(is_archived() & newer).select(parse_id(F.col("id")).alias(meta.id))
    return ids.where(F.col(meta.id).isNotNull())
