"""Links between records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import edges as E
from tidemark.operators import resolve as R
from tidemark.sources.pages import LINK_BATCH, explode_results, parse_pages
from workload.registry import Tables, query, text

SPLIT = "1998-06-01"
FIELDS = ["from_id", "to_type", "to_id", "type_id", "category"]
ARRIVAL = [
    "l_shipdate",
    "l_linenumber",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


def linked(**fields: Column) -> Column:
    item = F.struct(*[c.alias(name) for name, c in fields.items()])
    return F.struct(F.array(item).alias("results"))


@query("""
    SELECT l_orderkey AS from_id, 'parts_used' AS to_type, l_partkey AS to_id,
           l_linestatus AS type_id,
           CASE l_returnflag WHEN 'R' THEN 'USER_DEFINED' ELSE 'HUBSPOT_DEFINED' END AS category
    FROM lineitem
    UNION ALL
    SELECT l_orderkey, 'suppliers', l_suppkey, '', 'HUBSPOT_DEFINED' FROM lineitem""")
def edges_flat(t: Tables) -> DataFrame:
    category = F.when(F.col("l_returnflag") == "R", "USER_DEFINED")
    links = F.struct(
        linked(id=text("l_partkey"), type=F.col("l_linestatus"), category=category).alias("Parts-Used"),
        linked(id=text("l_suppkey")).alias("Suppliers"),
    )
    records = t.lineitem.select(
        text("l_orderkey").alias("id"), F.to_json(links).alias("associations"), "l_linenumber"
    )
    return E.normalize_edges(records, "l_linenumber").select(*FIELDS)


@query("""
    SELECT l_orderkey AS from_id, 'parts' AS to_type, l_partkey AS to_id
    FROM lineitem WHERE l_returnflag = 'A'
    UNION ALL
    SELECT l_orderkey, 'suppliers', l_suppkey FROM lineitem WHERE l_linestatus = 'F'""")
def edges_bad_values(t: Tables) -> DataFrame:
    part = """CASE l_returnflag WHEN 'A' THEN concat('{"results":[{"id":', l_partkey, '}]}')
              WHEN 'N' THEN '"text"' ELSE concat('[', l_partkey, ']') END"""
    supplier = """CASE l_linestatus WHEN 'F' THEN concat('{"results":[{"x":1},{"id":"', l_suppkey, '"}]}')
                  ELSE '{"results":[{"type":"1"}]}' END"""
    links = F.format_string('{"parts":%s,"suppliers":%s,"none":null}', F.expr(part), F.expr(supplier))
    records = t.lineitem.select(
        text("l_orderkey").alias("id"), links.alias("associations"), "l_linenumber"
    )
    return E.normalize_edges(records, "l_linenumber").select("from_id", "to_type", "to_id")


@query("""
    WITH named AS (SELECT * FROM lineitem WHERE NOT (l_linestatus = 'O' AND l_returnflag = 'N'))
    SELECT l_orderkey AS from_id, 'things' AS to_type, l_partkey AS to_id, '1' AS type_id,
           'HUBSPOT_DEFINED' AS category FROM named
    UNION ALL SELECT l_orderkey, 'things', l_partkey, '42', 'USER_DEFINED' FROM named
    UNION ALL SELECT l_orderkey, 'things', l_suppkey, '', 'HUBSPOT_DEFINED' FROM named""")
def edges_v4(t: Tables) -> DataFrame:
    nameless = (F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")
    kind = "struct<typeId:int,category:string>"
    to = F.array(
        F.struct(
            F.col("l_partkey").alias("toObjectId"),
            F.expr(f"from_json('[{{\"typeId\":1}},{{\"typeId\":42,\"category\":\"USER_DEFINED\"}}]', 'array<{kind}>')").alias("associationTypes"),
        ),
        F.struct(
            F.col("l_suppkey").alias("toObjectId"),
            F.expr(f"from_json('[{{}}]', 'array<{kind}>')").alias("associationTypes"),
        ),
    )
    batch = F.struct(
        F.struct(F.when(nameless, "").otherwise(text("l_orderkey")).alias("id")).alias("from"),
        to.alias("to"),
    )
    body = F.to_json(F.struct(F.array(batch).alias("results"))).alias("body")
    pages = parse_pages(t.lineitem.select("l_linenumber", body), "body", "l_linenumber", LINK_BATCH)
    return E.flatten_links(explode_results(pages), "things").select(*FIELDS)


def part_edges(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("from_id"),
        F.concat(F.lit("part_"), F.lower("l_returnflag")).alias("to_type"),
        F.col("l_partkey").alias("to_id"),
        F.col("l_linestatus").alias("type_id"),
        F.concat(F.lit("line "), text("l_linenumber")).alias("category"),
        F.struct(*ARRIVAL).alias("arrival"),
    )


PART_EDGES = f"""
    arrived AS (
        SELECT l_orderkey AS from_id, 'part_' || lower(l_returnflag) AS to_type, l_partkey AS to_id,
               l_linestatus AS type_id, 'line ' || l_linenumber AS category, l_extendedprice AS price,
               l_shipdate >= TIMESTAMP '{SPLIT}' AS late,
               row({', '.join(ARRIVAL)}) AS arrival
        FROM lineitem)"""


def last_of(where: str = "true") -> str:
    return f"""
        SELECT * FROM arrived WHERE {where}
        QUALIFY row_number() OVER (
            PARTITION BY from_id, to_type, to_id, type_id ORDER BY arrival DESC) = 1"""


@query(f"WITH {PART_EDGES} SELECT from_id, to_type, to_id, type_id, category, price FROM ({last_of()})")
def edges_keep_last(t: Tables) -> DataFrame:
    kept = E.dedupe_edges(part_edges(t), ["arrival"])
    return kept.select(*FIELDS, F.col("arrival.l_extendedprice").alias("price"))


def halves(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Edges shipped before the split and since, each de-duplicated."""
    late = F.col("arrival.l_shipdate") >= F.lit(SPLIT).cast("timestamp_ntz")
    edges = part_edges(t)
    return tuple(
        E.dedupe_edges(edges.where(side), ["arrival"]).drop("arrival") for side in (~late, late)
    )


@query(f"""
    WITH {PART_EDGES},
    old AS ({last_of(where='NOT late')}), new AS ({last_of(where='late')})
    SELECT coalesce(n.from_id, o.from_id) AS from_id, coalesce(n.to_type, o.to_type) AS to_type,
           coalesce(n.to_id, o.to_id) AS to_id, coalesce(n.type_id, o.type_id) AS type_id,
           CASE WHEN n.from_id IS NOT NULL THEN n.category ELSE o.category END AS category
    FROM old o FULL JOIN new n USING (from_id, to_type, to_id, type_id)""")
def edges_merge(t: Tables) -> DataFrame:
    old, new = halves(t)
    return E.merge_edges(old, new).select(*FIELDS)


@query(f"""
    WITH {PART_EDGES},
    old AS ({last_of(where='NOT late')}), new AS ({last_of(where='late')})
    SELECT from_id, to_type, to_id, type_id, category FROM old o
    WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.from_id = o.from_id)
    UNION ALL SELECT from_id, to_type, to_id, type_id, category FROM new""")
def edges_replace_changed(t: Tables) -> DataFrame:
    old, new = halves(t)
    return E.replace_edges_of(old, new, new).select(*FIELDS)


def typed_edges(t: Tables) -> DataFrame:
    """Both link types of each line item, with the day it shipped."""
    ends = F.array(
        F.struct(F.lit("parts").alias("to_type"), F.col("l_partkey").alias("to_id")),
        F.struct(F.lit("suppliers").alias("to_type"), F.col("l_suppkey").alias("to_id")),
        F.struct(
            F.concat(F.lit("kind_"), F.lower("l_returnflag")).alias("to_type"),
            F.col("l_partkey").alias("to_id"),
        ),
    )
    return t.lineitem.select(
        F.col("l_orderkey").alias("from_id"), "l_shipdate", F.inline(ends)
    )


@query(f"""
    WITH e AS (
        SELECT l_orderkey AS from_id, 'parts' AS to_type, l_partkey AS to_id, l_shipdate FROM lineitem
        UNION ALL SELECT l_orderkey, 'suppliers', l_suppkey, l_shipdate FROM lineitem
        UNION ALL SELECT l_orderkey, 'kind_' || lower(l_returnflag), l_partkey, l_shipdate FROM lineitem)
    SELECT from_id, to_type, to_id FROM e
    WHERE (l_shipdate < TIMESTAMP '{SPLIT}' AND to_type NOT IN ('parts', 'suppliers', 'kind_a'))
       OR (l_shipdate >= TIMESTAMP '{SPLIT}' AND to_type IN ('parts', 'kind_a'))""")
def edges_replace_all(t: Tables) -> DataFrame:
    edges = typed_edges(t)
    late = F.col("l_shipdate") >= F.lit(SPLIT).cast("timestamp_ntz")
    target, load = edges.where(~late), edges.where(late & (F.col("to_type") != "suppliers"))
    replaced = E.replace_edge_types(target, load, ["parts", "suppliers", "kind_a"])
    return replaced.select("from_id", "to_type", "to_id")


@query("""
    SELECT 'orders_' || to_type AS edge_table, count(*)::BIGINT AS edges FROM (
        SELECT 'parts' AS to_type FROM lineitem UNION ALL SELECT 'suppliers' FROM lineitem
        UNION ALL SELECT 'kind_' || lower(l_returnflag) FROM lineitem)
    GROUP BY 1 ORDER BY 1""")
def edges_by_type(t: Tables) -> DataFrame:
    counts = E.edge_counts(typed_edges(t))
    named = counts.select(F.concat(F.lit("orders_"), "to_type").alias("edge_table"), "edges")
    return named.orderBy("edge_table")


@query("""
    SELECT l_orderkey AS from_id, l_partkey AS to_id, l_linestatus AS type_id FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""")
def attach_edges(t: Tables) -> DataFrame:
    active = t.orders.where(F.col("o_orderstatus") != "P")
    return E.attach_edges(part_edges(t), active, "o_orderkey").select("from_id", "to_id", "type_id")


@query("""
    SELECT o_orderkey AS from_orders_id, o_orderkey + 1 AS to_orders_id, o_orderstatus AS type_id,
           'HUBSPOT_DEFINED' AS category FROM orders""")
def self_edges(t: Tables) -> DataFrame:
    links = F.struct(
        linked(id=F.col("o_orderkey") + 1, type=F.col("o_orderstatus")).alias("Orders"),
        linked(id=F.col("o_custkey")).alias("Customers"),
    )
    records = t.orders.select(
        text("o_orderkey").alias("id"), F.to_json(links).alias("associations"), "o_orderdate"
    )
    edges = E.normalize_edges(records, "o_orderdate").drop("_ord")
    return E.edge_table(edges, "Orders", "orders")


NAMES = """
    found AS (
        SELECT DISTINCT 'part-' || l_partkey AS type_id, 'part_' || l_partkey AS name FROM lineitem
        WHERE l_quantity = 50
        UNION SELECT DISTINCT 'supplier-' || l_suppkey, 'maker_' || l_suppkey FROM lineitem
        WHERE l_linestatus = 'F'),
    listed AS (
        SELECT 'part-' || p_partkey AS type_id, lower(p_name) || p_partkey AS name FROM part
        WHERE p_size > 10
        UNION ALL SELECT 'supplier-' || s_suppkey, lower(s_name) FROM supplier),
    wanted AS (
        SELECT DISTINCT 'part-' || l_partkey AS type_id FROM lineitem
        UNION SELECT DISTINCT 'supplier-' || l_suppkey FROM lineitem
        UNION SELECT DISTINCT 'order-' || l_orderkey FROM lineitem),
    resolved AS (
        SELECT type_id, coalesce(f.name, l.name, replace(type_id, '-', '_')) AS name,
               coalesce(f.name, l.name) IS NOT NULL AS resolved
        FROM wanted LEFT JOIN found f USING (type_id) LEFT JOIN listed l USING (type_id))"""


def resolved(t: Tables) -> DataFrame:
    def id_of(kind: str, key: str) -> Column:
        return F.concat(F.lit(f"{kind}-"), text(key))

    own, name = id_of("order", "l_orderkey"), F.concat(F.lit("Order"), text("l_orderkey"))
    named = F.col("l_quantity") == 50
    out = F.concat(name, F.lit("_to_Part_"), text("l_partkey"))
    back = F.concat(F.lit("Maker_"), text("l_suppkey"), F.lit("_to_"), name)
    links = F.array(
        F.struct(
            own.alias("fromObjectTypeId"),
            id_of("part", "l_partkey").alias("toObjectTypeId"),
            F.when(named, out).otherwise("misc").alias("name"),
        ),
        F.struct(
            id_of("supplier", "l_suppkey").alias("fromObjectTypeId"),
            own.alias("toObjectTypeId"),
            F.when(F.col("l_linestatus") == "F", back).otherwise(name).alias("name"),
        ),
    )
    schemas = t.lineitem.select(
        own.alias("type_id"), name.alias("name"), links.alias("associations"),
        F.col("l_linenumber").alias("_ord"),
    )
    parts = t.part.select(
        id_of("part", "p_partkey").alias("type_id"),
        F.when(F.col("p_size") > 10, F.concat(F.upper("p_name"), text("p_partkey"))).alias("name"),
        F.col("p_partkey").alias("_ord"),
    )
    suppliers = t.supplier.select(
        id_of("supplier", "s_suppkey"), F.col("s_name"), F.col("s_suppkey")
    )
    kinds = [("part", "l_partkey"), ("supplier", "l_suppkey"), ("order", "l_orderkey")]
    wanted = t.lineitem.select(F.explode(F.array(*[id_of(*k) for k in kinds])).alias("type_id"))
    return R.resolve_names(
        wanted, R.names_from_associations(schemas), R.names_from_schemas(parts.union(suppliers))
    )


@query(f"WITH {NAMES} SELECT type_id, name, resolved FROM resolved")
def resolve_type_names(t: Tables) -> DataFrame:
    return resolved(t)


@query(f"""
    WITH {NAMES}
    SELECT count(*) FILTER (resolved)::BIGINT AS resolved, count(*)::BIGINT AS wanted FROM resolved""")
def name_coverage(t: Tables) -> DataFrame:
    return R.name_coverage(resolved(t))


