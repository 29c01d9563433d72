"""Declared property types: reading text as values and choosing storage types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.meta import LOCAL_ZONE, MetaColumns

# Declared type -> Spark storage type; anything else is stored as text.
STORAGE_TYPES = {
    "string": "string",
    "number": "double",
    "date": "date",
    "datetime": "timestamp",
    "bool": "boolean",
    "enumeration": "string",
    "phone_number": "string",
}
DECIMAL_NUMBER = "decimal(38,9)"

_PLAIN_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"
_ISO_START = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}([T ].*)?\s*\z"


def _whole_match(text: Column, pattern: str) -> Column:
    """Text that fits a pattern anchored at both ends, else the empty text, which no cast takes; ``text`` is
    evaluated once, which matters where it is read out of JSON."""
    return F.regexp_extract(text, pattern, 0)


def parse_id(text: Column) -> Column:
    """Whole numbers only; ``1.5`` or ``1_0`` are not ids."""
    return text.cast("string").try_cast("bigint")


def parse_number(text: Column, storage: str = "double") -> Column:
    """Decimal or exponent notation; bad text, overflow, NaN and infinities become null."""
    value = _whole_match(text, _PLAIN_NUMBER).try_cast(storage)
    if storage == "double":
        return F.when(F.abs(value) < F.lit(float("inf")), value)
    return value


def parse_instant(text: Column) -> Column:
    """ISO-8601 text as an instant, each value on its own; a missing zone means the session's (UTC)."""
    return _whole_match(text, _ISO_START).try_cast("timestamp")


def parse_date(text: Column) -> Column:
    return parse_instant(text).cast("date")


def parse_bool(text: Column) -> Column:
    """Exactly ``true`` or ``false``; every other spelling is null."""
    return F.when(text == "true", F.lit(True)).when(text == "false", F.lit(False))


def typed(text: Column, declared: str | None, dates_as_instants: bool = False) -> Column:
    """Value of a text property under its declared type; undeclared types stay text."""
    if declared == "number":
        return parse_number(text)
    if declared == "decimal":
        return parse_number(text, DECIMAL_NUMBER)
    if declared == "datetime" or (declared == "date" and dates_as_instants):
        return parse_instant(text)
    if declared == "date":
        return parse_date(text)
    if declared == "bool":
        return parse_bool(text)
    return text


def storage_type(declared: str | None) -> T.DataType:
    return T.DataType.fromDDL(STORAGE_TYPES.get(declared or "", "string"))


def storage_type_expr(declared: Column) -> Column:
    """Storage type of a column of declared types."""
    by_name = F.create_map(*[F.lit(x) for pair in STORAGE_TYPES.items() for x in pair])
    return F.coalesce(by_name[declared], F.lit("string"))


def declared_types(columns: DataFrame, catalog: DataFrame) -> DataFrame:
    """(final, original) names joined to the catalog: declared and storage type per column."""
    types = catalog.select(F.col("name").alias("original"), F.col("type").alias("declared"))
    return columns.join(types, "original", "left").withColumn(
        "storage", storage_type_expr(F.col("declared"))
    )


def convert_columns(
    df: DataFrame, declared: dict[str, str], meta: MetaColumns = MetaColumns()
) -> DataFrame:
    """Type the text columns of a flat table in one select.

    Bookkeeping columns, ``asoc_`` columns and columns without a declared type pass through.
    """

    def convert(name: str) -> Column:
        fixed = name in meta.reserved or name.startswith("asoc_") or name not in declared
        return F.col(name) if fixed else typed(F.col(name), declared[name]).alias(name)

    return df.select(*[convert(c) for c in df.columns])


def to_local(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """Wall clock in ``zone`` of a UTC timestamp without zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def epoch_ms(text: Column) -> Column:
    """Epoch milliseconds, as text, of ISO text; text that is no instant passes through."""
    return F.coalesce(F.unix_millis(parse_instant(text)).cast("string"), text)


def unify_missing(df: DataFrame) -> DataFrame:
    """NaN in floating-point columns becomes null."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[F.nanvl(F.col(c), F.lit(None)).alias(c) if c in floats else F.col(c) for c in df.columns]
    )
