"""Column and table names: normalising, fitting to a length, lineage."""

from __future__ import annotations

import re
import string
import unicodedata
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.meta import MAX_NAME, MetaColumns
from tidemark.operators.ordinal import occurrence_number
from tidemark.session import write_once

_KEPT = set(string.ascii_lowercase + string.digits + "_")


def _ascii_base(ch: str) -> str:
    return unicodedata.normalize("NFD", ch).encode("ascii", "ignore").decode()


def _translate_table() -> tuple[str, str]:
    """Lower-case letters outside ASCII whose decomposition has an ASCII base, plus blank and dash."""
    source, target = [" ", "-"], ["_", "_"]
    for code in range(0x80, 0x10000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        ch = chr(code)
        base = _ascii_base(ch)
        if len(base) == 1 and base in _KEPT:
            source.append(ch)
            target.append(base)
    return "".join(source), "".join(target)


_FROM, _TO = _translate_table()


def normalize_expr(text: Column) -> Column:
    """snake_case ASCII form of a text column; null becomes the empty name.

    Text that is ASCII already needs no table of letters, and short words with single marks between them
    no more than lower case.
    """
    ascii_only = F.translate(F.lower(text), " -", "__")
    folded = F.when(text.rlike(r"\A[\x00-\x7F]*\z"), ascii_only).otherwise(F.translate(F.lower(text), _FROM, _TO))
    kept = F.regexp_replace(folded, "[^a-z0-9_]", "")
    squeezed = F.regexp_replace(kept, "_{2,}", "_")
    done = F.coalesce(F.btrim(squeezed, F.lit("_")), F.lit(""))
    # The pattern is for short text only: Java matches repeated groups by recursion.
    plain = (F.length(text) <= 200) & text.rlike(r"\A[A-Za-z0-9]+([ _-][A-Za-z0-9]+)*\z")
    return F.when(plain, ascii_only).otherwise(done)


def normalize_name(text: object) -> str:
    """Driver-side twin of :func:`normalize_expr`, for catalog names."""
    if text is None:
        return ""
    if not isinstance(text, str):
        return str(text)
    folded = "".join("_" if ch in " -" else _ascii_base(ch) for ch in text.lower())
    return re.sub("_+", "_", "".join(ch for ch in folded if ch in _KEPT)).strip("_")


def fit_names(
    names: Iterable[str], limit: int = MAX_NAME, taken: Iterable[str] = (), reserve: bool = False
) -> list[str]:
    """Cut names to ``limit`` and number repeats, trying on until a name is free.

    A name that comes later may find its own given to a repeat; with ``reserve`` it never does, as no
    repeat takes a name that any other holds as its own. The first form suits lists that grow at their
    end, whose names should not change; the second does not depend on where a name stands.
    """
    used = set(taken)
    cuts = [(name or f"col_{position}")[:limit] for position, name in enumerate(names, start=1)]
    kept = set(cuts) if reserve else set()
    fitted = []
    for base in cuts:
        candidate, n = base, 1
        while candidate in used or n > 1 and candidate in kept:
            n += 1
            candidate = f"{base[: limit - len(f'_{n}')]}_{n}"
        used.add(candidate)
        fitted.append(candidate)
    return fitted


#: Digits of the largest number that a frame of names may need.
MAX_DIGITS = 10


def fit_names_frame(
    df: DataFrame, name: str, position: str, out: str = "final", limit: int = MAX_NAME
) -> DataFrame:
    """The ``reserve`` form of :func:`fit_names` over a column of names; ``position`` must be unique.

    The first holder of a cut name keeps it. The others draw numbers from the pool of names that start
    alike: the r-th of them takes the r-th number that no cut name holds. A cut name has one pool of
    all numbers if the longest suffix fits behind it; where suffixes shorten it, every suffix length has a
    pool of its own, which cut names with the same head share. So the number of passes does not
    depend on how many repeats there are, but for the digits of their count. Only positions and cut
    names take part; rows are joined to their numbers once.
    """
    cut = df.select(F.col(position).alias("_at"), F.substring(F.col(name), 1, limit).alias("_cut"))
    numbered = occurrence_number(cut, ["_cut"], ["_at"], out="_nth", costly=True)
    numbered = write_once(numbered, "cut-names")
    firsts, again = numbered.where("_nth = 1").select("_cut"), numbered.where("_nth > 1")
    suffix = r"_([1-9][0-9]{0,8})\z"
    literal = firsts.where(F.col("_cut").rlike(suffix)).select(
        F.regexp_replace("_cut", suffix, "").alias("_key"), F.regexp_extract("_cut", suffix, 1).cast("long").alias("_k")
    )
    short = F.length("_cut") <= limit - MAX_DIGITS - 1
    pool = again.where(short).select("_at", "_cut", F.col("_cut").alias("_key"), (F.col("_nth") - 2).alias("_r"))
    given = [_drawn(pool, literal, 2)]
    rest = again.where(~short).select("_at", "_cut")
    for digits in range(1, MAX_DIGITS):
        if rest.isEmpty():
            break
        low, high = max(2, 10 ** (digits - 1)), 10**digits - 1
        keyed = rest.withColumn("_key", F.substring("_cut", 1, limit - digits - 1))
        pool = occurrence_number(keyed, ["_key"], ["_at"], out="_r").withColumn("_r", F.col("_r") - 1)
        drawn = write_once(_drawn(pool, literal.where(F.col("_k").between(low, high)), low), "drawn-names")
        given.append(drawn.where(F.col("_n") <= high))
        rest = drawn.where(F.col("_n") > high).select("_at", "_cut")
    numbers = reduce(DataFrame.unionByName, given).select(
        F.col("_at").alias("_given_at"), F.concat("_key", F.lit("_"), F.col("_n").cast("string")).alias("_given")
    )
    final = F.coalesce("_given", "_cut").alias(out)
    fitted = numbered.join(numbers, F.col("_at") == F.col("_given_at"), "left").select("_at", final)
    # What made the names is not computed again, unless they are asked for.
    return df.join(fitted, F.col(position) == F.col("_at"), "left").select(*df.columns, out)


def _drawn(pool: DataFrame, literal: DataFrame, low: int) -> DataFrame:
    """``pool`` (rank ``_r`` from 0 within ``_key``) with ``_n``, the rank-th number from ``low`` on that is
    not among the ``literal`` ones (``_key, _k``).

    A literal number with ``g`` free ones below it stands before the rank ``g``; so numbers are the
    places in which ranks and literal numbers come when both are sorted together.
    """
    held = literal.where(F.col("_k") >= low).join(pool.select("_key").distinct(), "_key", "left_semi")
    held = write_once(held, "held-numbers")
    if held.isEmpty():
        return pool.select("_at", "_cut", "_key", (F.col("_r") + low).alias("_n"))
    ranked = occurrence_number(held, ["_key"], ["_k"], out="_j")
    none = F.lit(None)
    before = ranked.select(
        none.cast(pool.schema["_at"].dataType).alias("_at"), none.cast("string").alias("_cut"), "_key",
        (F.col("_k") - low - F.col("_j") + 1).alias("_r"), F.lit(0).alias("_kind"), F.col("_k").alias("_tie"),
    )
    both = before.unionByName(pool.select("_at", "_cut", "_key", "_r", F.lit(1).alias("_kind"), F.lit(0).cast("long").alias("_tie")))
    placed = occurrence_number(both, ["_key"], ["_r", "_kind", "_tie"], out="_n")
    return placed.where("_kind = 1").select("_at", "_cut", "_key", (F.col("_n") - 1 + low).alias("_n"))


@dataclass(frozen=True)
class ColumnPlan:
    """One property on its way to becoming a table column."""

    original: str
    renamed: str
    normalized: str
    final: str
    declared: str | None

    @property
    def truncated(self) -> bool:
        return len(self.normalized) > MAX_NAME


def plan_columns(
    catalog: Iterable[tuple[str, str | None]],
    rename: dict[str, str] | None = None,
    meta: MetaColumns = MetaColumns(),
) -> list[ColumnPlan]:
    """Final column per property, by position: rename, normalise, fit around the reserved names."""
    rename = rename or {}
    entries = [(name, declared) for name, declared in catalog if name not in meta.reserved]
    renamed = [rename.get(name, name) for name, _ in entries]
    normalized = [normalize_name(name) for name in renamed]
    final = fit_names(normalized, taken=meta.reserved)
    return [
        ColumnPlan(name, new, norm, last, declared)
        for (name, declared), new, norm, last in zip(entries, renamed, normalized, final)
    ]


def column_lineage(df: DataFrame, original: str, renamed: Column, position: str) -> DataFrame:
    """The same journey for names held in a DataFrame: original, renamed, normalised, final."""
    steps = df.select(
        position,
        F.col(original).alias("original"),
        renamed.alias("renamed"),
        normalize_expr(renamed).alias("normalized"),
    )
    named = F.when(
        F.col("normalized") == "", F.concat(F.lit("col_"), F.col(position).cast("string"))
    ).otherwise(F.col("normalized"))
    return fit_names_frame(steps.withColumn("_named", named), "_named", position).drop("_named")


def edge_columns(own: str, to_type: str) -> tuple[str, str]:
    """Id columns of an edge table; both ends of the same type get from/to prefixes."""
    own, to_type = normalize_name(own), normalize_name(to_type)
    if own == to_type:
        return f"from_{own}_id", f"to_{to_type}_id"
    return f"{own}_id", f"{to_type}_id"


def table_name(schema_name: Column, object_type: Column) -> Column:
    """Schema name in lower case, else the requested object type."""
    return F.coalesce(F.lower(F.nullif(schema_name, F.lit(""))), object_type)
