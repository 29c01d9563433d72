"""Not-modified revisits of a web archive, resolved to the response whose body they stand for.

A revisit (a 304 answer) belongs to the latest full response of the same canonical URL before it.
The match counts only if their validators agree: entity tags, compared weakly, where both have one,
else dates of modification, else payload digests. A resolved revisit has the response's headers, in
which those that a 304 may change are replaced by its own (all but the ones about the body and the
connection).

The join in time is a range sort by (URL, time), a look back inside each partition, and the last
response of each earlier partition carried forward, so a URL with any share of the captures spreads
over tasks. Headers are joined by row number afterwards, and never sorted.

``status`` of a revisit is ``etag``, ``modified`` or ``digest`` for what agreed, ``mismatch`` if
validators differ, ``unverified`` if there is none in common, ``missing`` without a response before it
or without URL or time. Responses at the same time as a revisit are not before it; of several at one
time the one with the largest id, then digest, is the latest. Responses without URL or time are never matched. Header
names count in lower case, the last of repeated ones. Rows that repeat are answered each; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import table
from tidemark.session import write_once

# Headers that a 304 answer leaves as the response had them.
KEPT_HEADERS = [
    "connection",
    "content-encoding",
    "content-length",
    "content-md5",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "proxy-authorization",
    "proxy-connection",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
]
VALIDATORS = ["etag", "modified", "digest"]


def canonical_url(url: Column) -> Column:
    """Without scheme, ``www``, default port, fragment, tracking parameters and closing slash; host in
    lower case, parameters sorted."""
    plain = F.regexp_replace(F.btrim(url), "#.*$", "")
    plain = F.regexp_replace(plain, r"^(?i)[a-z][a-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(plain, r"^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www[0-9]*\.", "")
    path = F.regexp_replace(F.regexp_extract(plain, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.split(F.regexp_extract(plain, r"\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike("^(utm_[a-z]+|ref|fbclid|gclid)(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def plain_headers(headers: Column) -> Column:
    names = F.array_distinct(F.transform(F.map_keys(headers), F.lower))
    entries = F.map_entries(headers)

    def last(name: Column) -> Column:
        return F.element_at(F.filter(entries, lambda e: F.lower(e["key"]) == name), -1)["value"]

    return F.map_from_arrays(names, F.transform(names, last))


def merged_headers(response: Column, revisit: Column) -> Column:
    """Of two maps with plain names: the response's, with what the revisit may change."""
    new = F.map_filter(revisit, lambda k, _: ~k.isin(KEPT_HEADERS))
    old = F.map_filter(response, lambda k, _: ~F.array_contains(F.map_keys(new), k))
    return F.map_concat(old, new)


def _latest_before(rows: DataFrame) -> DataFrame:
    """``rid`` of every revisit with the number and validators of the latest response before it."""
    by = ["site", "ts", "kind", "record_id", "digest", "rid"]
    sorted_rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = write_once(sorted_rows.withColumn("_part", F.spark_partition_id()), "captures")
    answer = F.when(F.col("kind") == 1, F.struct("rid", *VALIDATORS))
    inside = Window.partitionBy("_part", "site").orderBy(*by[1:]).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("site").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    lasts = placed.groupBy("_part", "site").agg(
        F.max(F.when(F.col("kind") == 1, F.struct(*by[1:5], F.col("rid").alias("_at"), answer.alias("answer")))).alias("m")
    )
    lasts = lasts.withColumn("_carried", F.last("m.answer", ignorenulls=True).over(earlier)).drop("m")
    seen = placed.withColumn("_near", F.last(answer, ignorenulls=True).over(inside)).where("kind = 0")
    found = seen.join(lasts, ["_part", "site"]).withColumn("answer", F.coalesce("_near", "_carried"))
    return found.select("rid", *VALIDATORS, "answer")


def _status() -> Column:
    def weak(tag: Column) -> Column:
        return F.regexp_replace(F.btrim(tag), "^W/", "")

    status = F.lit("unverified")
    for name in reversed(VALIDATORS):
        own, other = F.col(name), F.col(f"answer.{name}")
        same = weak(own) == weak(other) if name == "etag" else own == other
        status = F.when(own.isNotNull() & other.isNotNull(), F.when(same, name).otherwise("mismatch")).otherwise(status)
    return F.when(F.col("answer").isNull(), "missing").otherwise(status)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Every revisit of ``records``: ``record_id, site, ts, status, refers_to, digest, headers``.

    ``records`` has ``record_id, url, ts, is_revisit, etag, modified, digest`` and ``headers``, a map.
    ``refers_to``, the response's digest and the merged headers are null unless resolved.
    """
    base = write_once(
        records.select(
            F.monotonically_increasing_id().alias("rid"),
            "record_id",
            canonical_url(F.col("url")).alias("site"),
            "ts",
            F.when(F.col("is_revisit"), 0).otherwise(1).alias("kind"),
            *VALIDATORS,
            plain_headers(F.col("headers")).alias("headers"),
        ),
        "archive-records",
    )
    placed = base.where("site is not null and ts is not null").drop("headers")
    found = _latest_before(placed).withColumn("status", _status())
    good = F.col("status").isin(VALIDATORS)
    found = found.select("rid", "status", F.when(good, F.col("answer.rid")).alias("_to"))
    revisits = base.where("kind = 0").select("rid", "record_id", "site", "ts", F.col("headers").alias("_own"))
    answers = base.where("kind = 1").select(
        F.col("rid").alias("_to"), F.col("record_id").alias("refers_to"), "digest", F.col("headers").alias("_kept")
    )
    none = F.create_map().cast("map<string,string>")
    merged = merged_headers(F.coalesce("_kept", none), F.coalesce("_own", none))
    return (
        revisits.join(found, "rid", "left")
        .join(answers, "_to", "left")
        .select(
            "record_id",
            "site",
            "ts",
            F.coalesce("status", F.lit("missing")).alias("status"),
            "refers_to",
            "digest",
            F.when(F.col("_to").isNotNull(), merged).alias("headers"),
        )
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """Two captures for each page, by a rule: it is a full response of its host's index in its
    language, and there is a 304 answer of that index at another time, a fifth of them earlier.

    A third of the answers have the page's entity tag, a third its date of modification only, and the
    rest a tag of their own.
    """
    n, md5 = F.col("page_id"), F.md5("html")
    url = F.regexp_extract("url", "^[^/]*//[^/]*/[a-z]*", 0).alias("url")
    asked = n * 10 + 5 + (n % 5 - 1) * 20
    tag = F.concat(F.lit('"'), md5, F.lit('"'))
    text = n.cast("string")
    response = pages.select(
        (n * 2).alias("record_id"),
        url,
        (n * 10).alias("ts"),
        F.lit(False).alias("is_revisit"),
        tag.alias("etag"),
        text.alias("modified"),
        md5.alias("digest"),
        F.create_map(
            F.lit("Content-Type"), F.lit("text/html"),
            F.lit("Content-Length"), F.octet_length("html").cast("string"),
            F.lit("ETag"), tag,
            F.lit("Cache-Control"), F.concat(F.lit("max-age="), (n % 7).cast("string")),
        ).alias("headers"),
    )
    own = F.when(n % 3 == 0, F.concat(F.lit("W/"), tag)).when(n % 3 == 2, F.concat(F.lit('"x'), text, F.lit('"')))
    revisit = pages.select(
        (n * 2 + 1).alias("record_id"),
        url,
        asked.alias("ts"),
        F.lit(True).alias("is_revisit"),
        own.alias("etag"),
        F.when(n % 3 == 1, text).alias("modified"),
        F.lit(None).cast("string").alias("digest"),
        F.create_map(
            F.lit("Content-Length"), F.lit("0"),
            F.lit("CACHE-CONTROL"), F.lit("no-cache"),
            F.lit("Date"), asked.cast("string"),
        ).alias("headers"),
    )
    return response.unionByName(revisit)


def op1_revisits(spark: SparkSession, folder: str) -> DataFrame:
    resolved = resolve_revisits(captures_of(table(spark, folder, "pages")))
    lines = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return resolved.withColumn("headers", F.array_join(F.array_sort(lines), "\n"))


OP1_SQL = r"""
WITH named AS (
  SELECT *, regexp_replace(regexp_replace(trim(regexp_extract(url, '^[^/]*//[^/]*/[a-z]*')), '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://', '') AS u
  FROM pages
), cut AS (
  SELECT page_id, html,
    regexp_replace(regexp_replace(lower(regexp_extract(u, '^[^/?]*')), ':(80|443)$', ''), '^www[0-9]*\.', '') AS host,
    regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS params
  FROM named
), sites AS (
  SELECT page_id, md5(html) AS digest, strlen(html) AS n_bytes,
    host || path || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS site
  FROM cut
), captures AS (
  SELECT page_id * 2 AS record_id, site, page_id * 10 AS ts, 1 AS kind, page_id, digest, n_bytes FROM sites
  UNION ALL
  SELECT page_id * 2 + 1, site, page_id * 10 + 5 + (page_id % 5 - 1) * 20, 0, page_id, digest, n_bytes FROM sites
), looked AS (
  SELECT *, last_value(CASE WHEN kind = 1 THEN page_id END IGNORE NULLS) OVER (
    PARTITION BY site ORDER BY ts, kind, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r
  FROM captures
), met AS (
  SELECT v.record_id, v.site, v.ts, v.page_id AS p, a.page_id AS r, a.digest, a.n_bytes, v.digest AS own
  FROM looked v LEFT JOIN sites a ON v.r = a.page_id WHERE v.kind = 0
), judged AS (
  SELECT *, CASE WHEN r IS NULL THEN 'missing'
    WHEN p % 3 = 0 THEN CASE WHEN own = digest THEN 'etag' ELSE 'mismatch' END
    WHEN p % 3 = 2 THEN 'mismatch'
    WHEN p = r THEN 'modified' ELSE 'mismatch' END AS status
  FROM met
)
SELECT record_id, site, ts, status,
  CASE WHEN status IN ('etag', 'modified') THEN r * 2 END AS refers_to,
  CASE WHEN status IN ('etag', 'modified') THEN digest END AS digest,
  CASE WHEN status IN ('etag', 'modified') THEN 'cache-control: no-cache' || chr(10)
    || 'content-length: ' || n_bytes || chr(10) || 'content-type: text/html' || chr(10)
    || 'date: ' || ts || chr(10) || 'etag: "' || digest || '"' END AS headers
FROM judged
"""
