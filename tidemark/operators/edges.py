"""Many-to-many links as rows: normalising, de-duplicating, replacing, naming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import parse_id
from tidemark.functions.naming import edge_columns, normalize_expr
from tidemark.meta import DEFAULT_CATEGORY, EDGE_KEY, EDGE_ORIGIN, EDGE_PLACE, EDGE_SALTS
from tidemark.operators.merge import keep_last, keep_last_written, replace_where_listed, upsert
from tidemark.session import write_once


ITEM = "struct<id:string, type:string, category:string>"
LINKS = f"map<string, struct<results:array<{ITEM}>>>"


def _links(text: Column, strict: Column) -> Column:
    """Association JSON as a map of item lists.

    One strict parse does for sound text. Where that leaves a gap (a value that is no object, an
    item that is none), the text is taken apart level by level, so that only the odd part is lost.
    """
    gap = F.exists(F.map_values(strict), lambda v: v.isNotNull() & v["results"].isNull())
    loose = F.transform_values(
        F.from_json(text, "map<string,string>"),
        lambda _, value: F.when(
            F.ltrim(value).startswith("{"),
            F.struct(
                F.transform(
                    F.from_json(value, "struct<results:array<string>>")["results"],
                    lambda item: F.from_json(item, ITEM),
                ).alias("results")
            ),
        ),
    )
    return F.when(strict.isNotNull() & ~gap, strict).otherwise(loose)


def normalize_edges(records: DataFrame, order: str = "_ord") -> DataFrame:
    """Record x link type x linked item -> (from_id, to_type, to_id, type_id, category, _ord).

    ``associations`` is JSON text of an object of lists; values that are no object and items
    without an id are passed over.
    """
    # The strict parse has a projection of its own, so that the generator reads it and parses nothing.
    parsed = records.select(
        parse_id(F.col("id")).alias("from_id"),
        F.col(order).alias("_rec"),
        "associations",
        F.from_json("associations", LINKS).alias("_strict"),
    )
    entries = parsed.select(
        "from_id",
        "_rec",
        F.explode_outer(_links(F.col("associations"), F.col("_strict"))).alias("_type", "_value"),
    ).where(F.col("_type").isNotNull())
    # Names are normalised per entry, below the second generator.
    named = entries.select("from_id", "_rec", "_type", normalize_expr(F.col("_type")).alias("to_type"), "_value")
    items = named.select(
        "from_id",
        "_rec",
        "_type",
        "to_type",
        F.posexplode_outer("_value.results").alias("_at", "_i"),
    )
    return items.where(F.col("_i.id").isNotNull()).select(
        "from_id",
        "to_type",
        parse_id(F.col("_i.id")).alias("to_id"),
        F.coalesce("_i.type", F.lit("")).alias("type_id"),
        F.coalesce("_i.category", F.lit(DEFAULT_CATEGORY)).alias("category"),
        F.struct("_rec", "_type", "_at", F.lit(0).alias("_k")).alias("_ord"),
    )


def usable_edges(edges: DataFrame) -> DataFrame:
    """Edges with whole-number ids on both ends."""
    return edges.where(F.col("from_id").isNotNull() & F.col("to_id").isNotNull())


def flatten_links(
    batches: DataFrame, to_type: Column | str, order: str = "_ord", carry: tuple[str, ...] = ()
) -> DataFrame:
    """Link batches (one from-id, many targets, several link types each) to edge rows.

    ``carry`` names columns to pass along; with any, a batch without links (or without a from-id)
    still gives a row, whose ``to_id`` is null.
    """
    target = F.lit(to_type) if isinstance(to_type, str) else to_type
    named = batches if carry else batches.where(F.coalesce(F.col("from.id"), F.lit("")) != "")
    each = named.select(
        *carry,
        F.col("from.id").alias("_from"),
        target.alias("to_type"),
        F.col(order).alias("_rec"),
        F.posexplode_outer("to").alias("_at", "_to"),
    )
    kinds = each.select(
        *carry,
        "_from",
        "to_type",
        F.col("_to.toObjectId").alias("_to_id"),
        "_rec",
        "_at",
        F.posexplode_outer("_to.associationTypes").alias("_k", "_kind"),
    )
    found = F.col("_k").isNotNull()
    return (kinds if carry else kinds.where(found)).select(
        *carry,
        parse_id(F.col("_from")).alias("from_id"),
        "to_type",
        F.when(found, parse_id(F.col("_to_id"))).alias("to_id"),
        F.coalesce("_kind.typeId", F.lit("")).alias("type_id"),
        F.coalesce("_kind.category", F.lit(DEFAULT_CATEGORY)).alias("category"),
        F.struct("_rec", F.lit("").alias("_type"), "_at", "_k").alias("_ord"),
    )


def attach_edges(edges: DataFrame, records: DataFrame, record_id: str) -> DataFrame:
    """Edges that start at a record of the load, still one row each (never a list per record)."""
    ids = records.select(F.col(record_id).alias("from_id"))
    return edges.join(ids, "from_id", "left_semi")


def edge_counts(edges: DataFrame) -> DataFrame:
    """Edges per target type."""
    return edges.groupBy("to_type").agg(F.count(F.lit(1)).alias("edges"))


def _key(edges: DataFrame) -> list[str]:
    return [*EDGE_KEY, EDGE_ORIGIN] if EDGE_ORIGIN in edges.columns else EDGE_KEY


def dedupe_edges(edges: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One edge per (from, type, to, link type) and origin, if there is one: the last to arrive."""
    return keep_last(edges, _key(edges), order or ["_ord"])


def dedupe_written_edges(edges: DataFrame) -> DataFrame:
    """:func:`dedupe_edges` of a written table, without ``_ord``: edges that come once are not moved."""
    return keep_last_written(edges, _key(edges), ["_ord"]).drop("_ord")


def replace_edge_types(target: DataFrame, load: DataFrame, declared: list[str]) -> DataFrame:
    """Full mode: every declared type holds exactly the load's edges, none if it brings none."""
    kept = target.where(~F.col("to_type").isin(declared))
    return kept.unionByName(load.where(F.col("to_type").isin(declared)))


def merge_edges(target: DataFrame, load: DataFrame) -> DataFrame:
    """Incremental mode: update known edges, add new ones."""
    return upsert(target, load, _key(target))


def salted(edges: DataFrame) -> DataFrame:
    """Edges with ``_salt``: the edges of one record lie in up to ``EDGE_SALTS`` buckets."""
    return edges.withColumn("_salt", F.pmod(F.xxhash64("to_id"), F.lit(EDGE_SALTS)).cast("int"))


def replace_edges_of(target: DataFrame, load: DataFrame, changed: DataFrame) -> DataFrame:
    """All edges of the changed records (column ``from_id``) become the load's edges.

    Where ``changed`` names origins too, only a record's edges of that origin are replaced. A target
    with salts is met on both columns that it is bucketed by, so its edges stay in place: of a listed record
    come the salts that it has in the target (few, if any), not all there are. Finding them moves narrow rows,
    at most one for each record and salt of the target.
    """
    of = [c for c in ("from_id", EDGE_ORIGIN) if c in changed.columns]
    if "_salt" not in target.columns:
        return replace_where_listed(target, load, of, changed)
    place = [*EDGE_PLACE, *of[1:]]
    held = target.select(*place).distinct().join(changed.select(*of), of, "left_semi")
    return target.join(held, place, "left_anti").unionByName(salted(load), allowMissingColumns=True)


def settle_links(
    links: DataFrame, told: DataFrame, waiting: DataFrame | None, records: DataFrame, record_id: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(links of known records, the (from_id, origin) that they replace, links that wait on).

    ``told`` lists what the feed has spoken about, with links or without; it supersedes what has been
    ``waiting`` for its record since earlier loads. Every link's record must be told of. The known records, which
    may be many and bucketed by their id, are met by one row for each from-id and stay where they are; the links
    meet the records that are not there, which are few, if any.
    """
    pairs = told.select("from_id", EDGE_ORIGIN)
    if waiting is not None:
        old = waiting.join(pairs, ["from_id", EDGE_ORIGIN], "left_anti")
        links = links.unionByName(old, allowMissingColumns=True)
        pairs = pairs.union(old.select("from_id", EDGE_ORIGIN)).distinct()
    ids = pairs.select("from_id").distinct()
    absent = write_once(ids.join(records, F.col("from_id") == F.col(record_id), "left_anti"), "absent-records")
    attached = links.where("from_id IS NOT NULL").join(absent, "from_id", "left_anti")
    return attached, pairs.join(absent, "from_id", "left_anti"), links.join(absent, "from_id", "left_semi")


def edge_table(edges: DataFrame, own: str, to_type: str) -> DataFrame:
    """The edges to one type under that pair's column names."""
    from_col, to_col = edge_columns(own, to_type)
    renamed = {"from_id": from_col, "to_id": to_col}
    part = edges.where(F.col("to_type") == to_type).drop("to_type")
    return part.select(*[F.col(c).alias(renamed.get(c, c)) for c in part.columns])
