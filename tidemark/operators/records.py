"""Nested records to flat, typed rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import parse_id, typed
from tidemark.functions.naming import ColumnPlan
from tidemark.meta import RAW, MetaColumns
from tidemark.session import collect_catalog
from tidemark.sources.pages import is_archived


def run_mark() -> datetime:
    """UTC now in whole seconds, without zone: taken once per run and used as a literal."""
    return datetime.now(timezone.utc).replace(microsecond=0, tzinfo=None)


def at(mark: datetime) -> Column:
    return F.lit(mark.isoformat(sep=" ")).cast("timestamp_ntz")


def instant(moment: datetime) -> Column:
    """A literal instant; a datetime without zone is UTC."""
    return F.lit(moment.isoformat()).cast("timestamp")


def present_properties(records: DataFrame) -> list[str]:
    """Property names that occur in the load (records whose ``properties`` are JSON text)."""
    keys = F.explode(F.json_object_keys("properties"))
    return sorted(r.name for r in collect_catalog(records.select(keys.alias("name")).distinct()))


def _reader(records: DataFrame, names: list[str]) -> tuple[DataFrame, Callable[[str], Column]]:
    """Give access to properties by name for JSON text, map or struct columns.

    JSON text is parsed once per record into one text field per name (nested values stay JSON
    text); names that differ only in case go through positional field names.
    """
    kind = records.schema["properties"].dataType
    if isinstance(kind, T.MapType):
        return records, lambda name: F.col("properties")[name]
    if isinstance(kind, T.StructType):
        known = set(kind.fieldNames())
        return records, lambda name: (
            F.col("properties").getField(name) if name in known else F.lit(None)
        ).cast("string")
    fields = T.StructType([T.StructField(n, T.StringType()) for n in names])
    slots = {name: f"p{i}" for i, name in enumerate(names)}
    by_slot = T.StructType([T.StructField(slots[n], T.StringType()) for n in names])
    parsed = F.from_json("properties", fields).cast(by_slot)
    return records.withColumn("_p", parsed), lambda name: F.col(f"_p.{slots[name]}")


def flatten_records(
    records: DataFrame,
    columns: list[ColumnPlan],
    mark: datetime,
    meta: MetaColumns = MetaColumns(),
    dates_as_instants: bool = False,
    carry: tuple[str, ...] = (),
    raw: bool = False,
) -> DataFrame:
    """One wide row per record: id, a typed column per property, synced-at and deleted.

    A property named like the id column takes the place of the record's own id. Rows whose id is
    no whole number keep their text in ``_bad_id``; the others have null there. Each property
    column carries its original name as metadata. ``carry`` names columns to pass along. With ``raw``
    all properties come along as one ``VARIANT``, for :func:`declare_late`; it is null for text that is
    no JSON or names a property twice.
    """
    names = [c.original for c in columns]
    df, read = _reader(records, [*names, meta.id])
    own, override = F.col("id"), read(meta.id)
    good = parse_id(own).isNotNull() & (override.isNull() | parse_id(override).isNotNull())
    properties = [
        typed(read(c.original), c.declared, dates_as_instants).alias(
            c.final, metadata={"source": c.original}
        )
        for c in columns
    ]
    return df.select(
        F.when(good, parse_id(F.coalesce(override, own))).alias(meta.id),
        *properties,
        at(mark).alias(meta.synced),
        is_archived().alias(meta.deleted),
        F.when(~good, F.coalesce(own, F.lit(""))).alias("_bad_id"),
        *carry,
        *([_variant(df).alias(RAW)] if raw else []),
    )


def _variant(records: DataFrame) -> Column:
    is_text = isinstance(records.schema["properties"].dataType, T.StringType)
    return F.try_parse_json(F.col("properties") if is_text else F.to_json("properties"))


def raw_text(name: str) -> Column:
    """A property out of the :data:`~tidemark.meta.RAW` column, as text; nested values are JSON text."""
    quote = "'" if '"' in name else '"'
    if not name or quote in name:
        # Paths cannot spell these names.
        return F.from_json(F.to_json(RAW), T.MapType(T.StringType(), T.StringType()))[name]
    return F.try_variant_get(F.col(RAW), f"$[{quote}{name}{quote}]", "string")


def declare_late(target: DataFrame, columns: list[ColumnPlan]) -> DataFrame:
    """The target with those of ``columns`` that it lacks, filled from the properties that its rows keep.

    Nothing is read again for a property that is declared after its records came. Rows without kept
    properties have null, as in a column that is added without them.
    """
    held = {name.lower() for name in target.columns}
    late = [c for c in columns if c.final.lower() not in held]
    if not late or RAW not in held:
        return target
    values = [typed(raw_text(c.original), c.declared).alias(c.final, metadata={"source": c.original}) for c in late]
    return target.select("*", *values)


def split_rejects(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a usable id, rows without)."""
    good = flat.where(F.col("_bad_id").isNull()).drop("_bad_id")
    return good, flat.where(F.col("_bad_id").isNotNull())


REJECT = (
    "object_type STRING, rejected_at TIMESTAMP_NTZ, id_text STRING, page STRING, error_type STRING,"
    " message STRING, class STRING, content STRING, source STRING"
)


def reject_rows(staged: DataFrame, object_type: str, mark: datetime, source: str = "") -> DataFrame:
    """What a load could not take, one row each, as :data:`REJECT`: unusable ids, unreadable pages.

    ``source`` names the load, so that one that is repeated can tell its own rows.
    ``staged`` is the output of :func:`flatten_records` with ``_ord`` and ``_corrupt`` carried along.
    """
    broken = F.col("_corrupt").isNotNull()
    kind = F.when(broken, "JSONDecodeError").otherwise("ValueError")
    message = F.when(broken, "unreadable page").otherwise(
        F.concat(F.lit('no whole number: "'), F.col("_bad_id"), F.lit('"'))
    )
    return staged.where(broken | F.col("_bad_id").isNotNull()).select(
        F.lit(object_type).alias("object_type"),
        at(mark).alias("rejected_at"),
        F.col("_bad_id").alias("id_text"),
        F.col("_ord._page.file").alias("page"),
        kind.alias("error_type"),
        message.alias("message"),
        classify_error(kind, message).alias("class"),
        F.col("_corrupt").alias("content"),
        F.lit(source).alias("source"),
    )


def failure_rows(failures: DataFrame, object_type: Column, kind: Column, message: Column, mark: datetime) -> DataFrame:
    """Objects that could not be loaded at all, one row each, as :data:`REJECT`."""
    none = F.lit(None).cast("string")
    return failures.select(
        object_type.alias("object_type"), at(mark).alias("rejected_at"), none.alias("id_text"), none.alias("page"),
        kind.alias("error_type"), message.alias("message"), classify_error(kind, message).alias("class"),
        none.alias("content"), F.lit("").alias("source"),
    )


def classify_error(kind: Column, message: Column) -> Column:
    """Load-error class from an error's type name and message; the first class that fits wins."""
    text = F.lower(message)
    return (
        F.when(
            kind.contains("DatetimeFieldOverflow")
            | message.contains("date/time field value out of range"),
            "data_type",
        )
        .when(kind.contains("IntegrityError") | text.contains("duplicate key"), "integrity")
        .when(kind.contains("ProgrammingError") | text.contains("column"), "schema")
        .otherwise("unknown")
    )


def offending_digits(message: Column) -> Column:
    """Digits in double quotes inside a message, or ``unknown``."""
    return F.coalesce(
        F.nullif(F.regexp_extract(message, '"([0-9]+)"', 1), F.lit("")), F.lit("unknown")
    )
