"""Keyed merges as pure functions: target and load in, new target out."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.meta import MetaColumns
from tidemark.operators.records import at
from tidemark.session import write_once


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key in ``order``, which must be a total order within a key.

    An aggregate with map-side combine: each task ships at most one row per key, so a key holding
    a third of all rows costs no more than any other. The row is the greatest struct that starts
    with the order columns; only values without an order of their own (maps) ride beside it.
    """
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.distinct()
    ranked = F.struct(*order, *[c for c in rest if _orderable(df.schema[c].dataType)])
    loose = [c for c in rest if not _orderable(df.schema[c].dataType)]
    picks = [F.max(ranked).alias("_last")]
    if loose:
        picks.append(F.max_by(F.struct(*loose), ranked).alias("_beside"))
    source = {f.name: f.metadata for f in df.schema}

    def value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        held = "_beside" if c in loose else "_last"
        return F.col(held).getField(c).alias(c, metadata=source[c])

    return df.groupBy(*keys).agg(*picks).select(*[value(c) for c in df.columns])


def keep_last_written(written: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """:func:`keep_last` of a written table of which few keys, if any, come more than once.

    One pass over the key columns counts rows per hash of a key. Rows whose hash comes once need no ranking and stay
    where they are, without a sort or a shuffle of whole rows; only the others are ranked (keys that merely share a
    hash among them, so the result is exact). Where they are more than a quarter, all rows are.
    """
    counts = written.groupBy(F.xxhash64(*keys).alias("_hash")).agg(F.count(F.lit(1)).alias("_rows"))
    often = counts.where("_rows > 1")
    met = often.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")).first().n
    if not met:
        return written
    if met * 4 > written.count():
        return keep_last(written, keys, order)
    often = write_once(often.select("_hash"), "repeated-keys")
    hashed = written.withColumn("_hash", F.xxhash64(*keys))
    once = hashed.join(often, "_hash", "left_anti").drop("_hash")
    return once.unionByName(keep_last(hashed.join(often, "_hash", "left_semi").drop("_hash"), keys, order))


def _incoming(load: DataFrame) -> DataFrame:
    renamed = [F.col(c).alias(f"_in_{c}") for c in load.columns]
    return load.select(*renamed, F.lit(True).alias("_in"))


def _same_key(keys: list[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_in_{k}"))
    return on


def _merged(
    target: DataFrame, load: DataFrame, keys: list[str], takes: Column
) -> dict[str, Column]:
    """Value per column after a match: where ``takes`` holds the load's columns overwrite the
    target's, nulls included; columns the load lacks keep the target's value."""
    held, given = set(target.columns), set(load.columns)
    values: dict[str, Column] = {}
    for c in [*target.columns, *[c for c in load.columns if c not in held]]:
        if c in keys:
            values[c] = F.coalesce(F.col(c), F.col(f"_in_{c}"))
        elif c not in given:
            values[c] = F.col(c)
        elif c not in held:
            values[c] = F.when(takes, F.col(f"_in_{c}"))
        else:
            values[c] = F.when(takes, F.col(f"_in_{c}")).otherwise(F.col(c))
    return values


def _newer(guard: str | None) -> Column:
    """Whether the load's row is not older than the target's; an absent or undated row is older."""
    if guard is None:
        return F.lit(True)
    held, given = F.col(guard), F.col(f"_in_{guard}")
    return held.isNull() | F.coalesce(given >= held, F.lit(False))


def _tombstone(
    values: dict[str, Column], doomed: Column, mark: datetime, meta: MetaColumns
) -> dict[str, Column]:
    hit = doomed & ~values[meta.deleted].eqNullSafe(True)
    return {
        **values,
        meta.deleted: F.when(hit, F.lit(True)).otherwise(values[meta.deleted]),
        meta.synced: F.when(hit, at(mark)).otherwise(values[meta.synced]),
    }


def _select(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    return df.select(*[v.alias(c) for c, v in values.items()])


def upsert(
    target: DataFrame, load: DataFrame, keys: list[str], guard: str | None = None
) -> DataFrame:
    """Insert new keys and overwrite the load's columns of known ones, in one full outer join.

    Both sides must be unique on ``keys`` (see :func:`keep_last`), so no key can be hot. With
    ``guard`` a load row older than its target row is ignored.
    """
    joined = target.join(_incoming(load), _same_key(keys), "full_outer")
    takes = F.col("_in").isNotNull() & _newer(guard)
    return _select(joined, _merged(target, load, keys, takes))


def full_sync(
    target: DataFrame,
    load: DataFrame,
    mark: datetime,
    meta: MetaColumns = MetaColumns(),
    seen: DataFrame | None = None,
) -> DataFrame:
    """Upsert a complete load and mark the rows it lacks as deleted, in the same join.

    An empty load changes nothing: it is taken for a failed read, not for an empty source.
    ``seen`` may name a cheaper frame to look for a first row in, such as the raw scan.
    """
    if (load if seen is None else seen).isEmpty():
        return target
    keys = [meta.id]
    joined = target.join(_incoming(load), _same_key(keys), "full_outer")
    loaded = F.col("_in").isNotNull()
    return _select(joined, _tombstone(_merged(target, load, keys, loaded), ~loaded, mark, meta))


def apply_changes(
    target: DataFrame,
    load: DataFrame,
    gone: DataFrame,
    mark: datetime,
    meta: MetaColumns = MetaColumns(),
    guard: str | None = None,
) -> DataFrame:
    """Upsert changed rows, then mark the ids in ``gone`` as deleted, in one pass over the target.

    The changes meet the target in a full outer join, in which a bucketed target is not shuffled.
    ``guard`` is that of :func:`upsert`.
    """
    key = meta.id
    listed = gone.select(F.col(key).alias("_gone_id")).distinct()
    changes = _incoming(load).join(listed, F.col(f"_in_{key}") == F.col("_gone_id"), "full_outer")
    changes = changes.withColumn(f"_in_{key}", F.coalesce(f"_in_{key}", "_gone_id"))
    loaded, doomed = F.col("_in").isNotNull(), F.col("_gone_id").isNotNull()
    values = _tombstone(_merged(target, load, [key], loaded & _newer(guard)), doomed, mark, meta)

    joined = target.withColumn("_cur", F.lit(True)).join(changes, _same_key([key]), "full_outer")
    return _select(joined.where(F.col("_cur").isNotNull() | loaded), values)


def newest_tombstones(held: DataFrame | None, gone: DataFrame, key: str) -> DataFrame:
    """``key, gone_at``: the latest time at which each row was archived, over ``held`` and ``gone``."""
    fresh = gone.groupBy(key).agg(F.max("gone_at").alias("gone_at"))
    if held is None:
        return fresh
    both = held.join(_incoming(fresh), _same_key([key]), "full_outer")
    return both.select(
        F.coalesce(key, f"_in_{key}").alias(key), F.greatest("gone_at", "_in_gone_at").alias("gone_at")
    )


def apply_versions(
    target: DataFrame | None,
    load: DataFrame,
    tombstones: DataFrame,
    guard: str,
    mark: datetime,
    meta: MetaColumns = MetaColumns(),
) -> DataFrame:
    """Upsert versions of rows under ``guard`` and delete the rows whose tombstone (see
    :func:`newest_tombstones`) is not older than the version that they end with.

    All that counts is the newest version and the newest tombstone of a key, so any order in which they
    come and any cut into loads end in the same rows. Tombstones of rows that never came wait in their
    own table. A target and tombstones bucketed by the key both stay in place.
    """
    key = meta.id
    times = tombstones.select(F.col(key).alias("_gone_key"), F.col("gone_at"))
    given = _incoming(load).join(times, F.col(f"_in_{key}") == F.col("_gone_key"), "left")
    given = given.drop("_gone_key").withColumnRenamed("gone_at", "_in_gone")
    if target is None:
        target = load.limit(0)
    held = target.join(times, F.col(key) == F.col("_gone_key"), "left").drop("_gone_key")
    joined = held.withColumnRenamed("gone_at", "_held_gone").join(given, _same_key([key]), "full_outer")
    values = _merged(target, load, [key], F.col("_in").isNotNull() & _newer(guard))
    gone = F.coalesce("_held_gone", "_in_gone")
    doomed = gone.isNotNull() & F.coalesce(gone >= values[guard], F.lit(True))
    return _select(joined, _tombstone(values, doomed, mark, meta))


def replace_where_listed(target: DataFrame, load: DataFrame, on: list[str], listed: DataFrame) -> DataFrame:
    """Swap all target rows whose ``on`` values are listed for the load's rows."""
    values = listed.select(*on).distinct()
    return target.join(values, on, "left_anti").unionByName(load, allowMissingColumns=True)
