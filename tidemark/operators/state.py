"""High-water marks and the choice between full and incremental runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.merge import keep_last
from tidemark.operators.records import instant

STATE = (
    "object_type STRING, last_sync_timestamp TIMESTAMP, records_synced BIGINT,"
    " sync_mode STRING, updated_at TIMESTAMP"
)

#: One row per landed file that a complete run has read: when it landed and, for files of records, the
#: least and greatest change time in it and how many of its records have none.
FILES = (
    "object_type STRING, kind STRING, file STRING, landed_at TIMESTAMP, bytes BIGINT, records BIGINT,"
    " oldest TIMESTAMP, newest TIMESTAMP, undated BIGINT"
)
FILE_KEY = ["file", "landed_at", "bytes"]


def latest_state(log: DataFrame) -> DataFrame:
    """One row per object: the state it last saved."""
    return keep_last(log, ["object_type"], ["updated_at", "last_sync_timestamp"])


def last_mark(log: DataFrame, object_type: str) -> datetime | None:
    """Saved mark of an object, as UTC without zone; null before its first run."""
    own = log.where(F.col("object_type") == object_type)
    mark = F.max_by("last_sync_timestamp", "updated_at").cast("timestamp_ntz")
    return own.agg(mark.alias("mark")).first()["mark"]


def modified_since(
    records: DataFrame, modified: Column, since: datetime, ordered: bool = False, undated: bool = False
) -> DataFrame:
    """Records changed at or after ``since``; sorted by change time only on request.

    Merges do not need the order, so the global sort is left out by default. With ``undated`` rows
    without a readable time count as changed, unreadable pages among them.
    """
    recent = modified >= instant(since)
    # ``modified`` is evaluated once a row: it may be parsed out of JSON.
    changed = records.where(F.coalesce(recent, F.lit(True)) if undated else recent)
    return changed.orderBy(modified) if ordered else changed


def file_zones(staged: DataFrame) -> DataFrame:
    """``file, records, oldest, newest, undated`` of every file in ``staged`` (``_ord``, ``_modified``)."""
    when = F.col("_modified")
    return staged.groupBy(F.col("_ord._page.file").alias("file")).agg(
        F.count(F.lit(1)).alias("records"),
        F.min(when).alias("oldest"),
        F.max(when).alias("newest"),
        F.count_if(when.isNull()).alias("undated"),
    )


def files_to_open(listed: DataFrame, seen: DataFrame, since: datetime | None) -> DataFrame:
    """``listed`` files with ``unseen`` and ``wanted``: those to open for changes at or after ``since``.

    Wanted are files that no run has read, however long ago they landed, and known ones with a record
    changed since or without a time. A file that was rewritten is another file. Without ``since`` all
    files are wanted.
    """
    zones = seen.groupBy(*FILE_KEY).agg(F.max("newest").alias("_newest"), F.max("undated").alias("_undated"))
    met = listed.join(zones.withColumn("_seen", F.lit(True)), FILE_KEY, "left")
    unseen = F.col("_seen").isNull()
    recent = F.lit(True) if since is None else F.col("_newest") >= instant(since)
    wanted = unseen | F.coalesce(recent, F.lit(False)) | (F.coalesce("_undated", F.lit(0)) > 0)
    return met.select(*listed.columns, unseen.alias("unseen"), wanted.alias("wanted"))


def exceeds(changed: DataFrame, threshold: int | None) -> bool:
    """Whether there are more than ``threshold`` rows; reading stops soon after."""
    return threshold is not None and changed.limit(threshold + 1).count() > threshold


def choose_mode(since: datetime | None, over_threshold: bool = False, force_full: bool = False) -> str:
    return "full" if since is None or over_threshold or force_full else "incremental"


def mode_expr(since: Column, changed: Column, threshold: int, force_full: Column) -> Column:
    """The same choice for many objects at once."""
    full = since.isNull() | (changed > threshold) | force_full
    return F.when(full, "full").otherwise("incremental")
