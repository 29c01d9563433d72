"""Dropping lines that many documents share. DataFrame and SQL functions only.

A line's key is the line without white space at its ends, in ASCII lower case; keys shorter than
``min_chars`` code points never drop. The keys of all lines are hashed once, into a written table that
is dealt into batches of ids, the largest ids first. What is known of the keys lies in *runs*: tables of
(key hash, number of documents, largest document), bucketed and sorted by hash. Every batch is summed
up to one row per key and merge-anti-joins the runs. A key that no run holds enters the batch's new run
with its largest document, which is the largest of all, as later batches hold smaller ids. A known key
enters with its count alone, and one that ``min_docs`` documents are known to hold does not enter at
all. When a level holds ``fanout`` runs, they are merged into one run of the next level. Runs of one
bucket count merge where they lie, without a shuffle.

After the last batch the runs say which keys ``min_docs`` documents hold. The lines are then
anti-joined with those keys, on the hash and a smaller document than the largest; the join is
made as its complement, as far fewer lines drop than stay, and a text is rebuilt from the numbers of
its dropped lines.

A hot line costs a row per document at its first exchange, which is by (key, document), one row per
task at the second, and in the join AQE splits it. Hashes have 128 bits.

Null or empty text is one empty line, and null becomes the empty text. A null id counts as one
document, smaller than all others. Rows that repeat an id are one document; batches keep them
together, as they are ranges of ids. An empty table gives no rows. The runs lie in a scratch database,
which goes with them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import documents
from tidemark.session import scratch_database, scratch_dir, write_once

# ASCII white space, and the letters that fold.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

KEY = ["h1", "h2"]
RUN = [*KEY, "docs", "top"]


def lines_of(text: str | Column) -> Column:
    return F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def keyed_lines(docs: DataFrame, min_chars: int, *carry: str) -> DataFrame:
    """One row per line long enough to drop: its number, its hash, its document and ``carry``."""
    lines = docs.select("doc_id", *carry, F.posexplode(lines_of("text")).alias("line_no", "_line"))
    keys = lines.select("doc_id", *carry, "line_no", line_key(F.col("_line")).alias("_key"))
    return keys.where(F.char_length("_key") >= min_chars).select(
        "doc_id",
        *carry,
        "line_no",
        F.xxhash64("_key").alias("h1"),
        F.xxhash64(F.lit(1), "_key").alias("h2"),
    )


class LineRuns:
    """Levelled sorted runs of line hashes, as bucketed tables of a scratch database.

    Of the runs that hold a key exactly one, the oldest, names its largest document.
    """

    def __init__(self, spark: SparkSession, min_chars: int = 20, min_docs: int = 3, fanout: int = 4) -> None:
        self.spark = spark
        self.min_chars = min_chars
        self.min_docs = min_docs
        self.fanout = fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.database = scratch_database(spark, f"line_runs_{uuid.uuid4().hex}")
        spark.sql(f"CREATE DATABASE `{self.database}` LOCATION '{scratch_dir(spark, 'line-runs')}'")
        self.made = 0
        self.levels: list[list[str]] = [[]]

    def _write(self, rows: DataFrame, level: int) -> None:
        name = f"{self.database}.run_{self.made}"
        self.made += 1
        placed = rows.select(*RUN).repartition(self.buckets, *KEY)
        writer = placed.write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY)
        writer.saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def tables(self) -> list[str]:
        """The runs, oldest first: levels above hold what came before."""
        return [name for level in reversed(self.levels) for name in level]

    def _merged(self, names: list[str]) -> DataFrame:
        """One row per key of several runs: a chain of merge joins on the bucket columns."""
        whole = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).toDF(*KEY, "_docs", "_top")
            whole = whole.join(other, KEY, "full_outer").select(
                *KEY,
                (F.coalesce("docs", F.lit(0)) + F.coalesce("_docs", F.lit(0))).alias("docs"),
                F.coalesce("top", "_top").alias("top"),
            )
        return whole

    def news(self, keys: DataFrame) -> DataFrame:
        """What a batch of ``doc_id, h1, h2`` adds to the runs: rows of a run.

        Keys that ``min_docs`` documents are known to hold are anti-joined away; of the others only
        those that no run holds name a document.
        """
        held = keys.select("doc_id", *KEY).distinct()
        own = held.groupBy(*KEY).agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("top"))
        known, before = F.lit(False), F.lit(0).cast("long")
        for n, name in enumerate(self.tables()):
            run = self.spark.table(name).select(*KEY, F.col("docs").alias(f"_docs{n}"))
            own = own.join(run, KEY, "left")
            known = known | F.col(f"_docs{n}").isNotNull()
            before = before + F.coalesce(f"_docs{n}", F.lit(0))
        own = own.where(before < self.min_docs)
        return own.withColumn("top", F.when(~known, F.col("top"))).select(*RUN)

    def add(self, keys: DataFrame) -> None:
        """Add a batch of ``doc_id, h1, h2``; its ids must be smaller than those of all earlier batches."""
        self._write(self.news(keys), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._write(self._merged(full), level + 1)
            self._drop(full)
            level += 1

    def shared(self) -> DataFrame:
        """Keys that at least ``min_docs`` documents hold, with their largest document."""
        if not self.tables():
            return self.spark.createDataFrame([], "h1 long, h2 long, top long")
        return self._merged(self.tables()).where(F.col("docs") >= self.min_docs).select(*KEY, "top")

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")
        self.levels = [[]]


def id_cuts(docs: DataFrame, batches: int) -> list[int]:
    """Ids that cut the rows into ``batches`` ranges of about equal size, or fewer."""
    shares = [i / batches for i in range(1, batches)]
    cuts = docs.select(F.percentile_approx("doc_id", shares, 1000)).first()[0] if shares else []
    return sorted(set(cuts or []))


def batch_of(cuts: list[int]) -> Column:
    """The number of a row's batch: the largest ids are batch 0, a null id goes with the last."""
    above = [F.when(F.col("doc_id") > cut, n) for n, cut in enumerate(reversed(cuts))]
    return F.coalesce(*above, F.lit(len(cuts)))


def write_keys(docs: DataFrame, min_chars: int, cuts: list[int]) -> DataFrame:
    """``doc_id, _text, line_no, h1, h2, batch`` of every line long enough to drop, in a folder per batch."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_text"))
    keys = keyed_lines(rows, min_chars, "_text").withColumn("batch", batch_of(cuts))
    path = scratch_dir(docs.sparkSession, "line-keys")
    keys.write.partitionBy("batch").parquet(path)
    return docs.sparkSession.read.schema(keys.schema).parquet(path)


def drop_shared_lines(docs: DataFrame, lines: DataFrame, shared: DataFrame) -> DataFrame:
    """``doc_id``, the kept text and the counts of lines, for rows of ``doc_id, text`` and their keyed lines."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_text"))
    lost = lines.join(
        shared,
        (lines["h1"] == shared["h1"])
        & (lines["h2"] == shared["h2"])
        & (lines["doc_id"].isNull() | (lines["doc_id"] < shared["top"])),
        "left_semi",
    )
    # Distinct numbers: rows that repeat id and text name the same lines.
    gone = lost.groupBy("doc_id", "_text").agg(F.sort_array(F.collect_set("line_no")).alias("_gone"))
    split = rows.withColumn("_lines", lines_of("text")).alias("a")
    met = split.join(
        gone.alias("b"),
        F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a._text") == F.col("b._text")),
        "left",
    ).select(
        "a.doc_id", "_lines", F.coalesce("_gone", F.array().cast("array<int>")).alias("_gone")
    )
    # The stretches between dropped lines: linear in the lines of a text, whatever drops.
    bounds = F.concat(F.array(F.lit(-1)), F.col("_gone"), F.array(F.size("_lines")))
    stretches = F.zip_with(
        F.slice(bounds, 1, F.size("_gone") + 1),
        F.slice(bounds, 2, F.size("_gone") + 1),
        lambda a, b: F.slice(F.col("_lines"), a + 2, b - a - 1),
    )
    return met.select(
        "doc_id",
        F.array_join(F.flatten(stretches), "\n").alias("text"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size("_gone").cast("long").alias("n_dropped"),
    )


def dedup_lines(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 6, fanout: int = 4
) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped`` of every row, with shared lines dropped."""
    docs = docs.select("doc_id", "text")
    cuts = id_cuts(docs, batches)
    lines = write_keys(docs, min_chars, cuts)
    runs = LineRuns(docs.sparkSession, min_chars, min_docs, fanout)
    try:
        for n in range(len(cuts) + 1):
            runs.add(lines.where(F.col("batch") == n))
        shared = write_once(runs.shared(), "shared-lines")
    finally:
        runs.close()
    return drop_shared_lines(docs, lines.drop("batch"), shared)


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = dedup_lines(documents(spark, folder))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no
  FROM documents
), keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[ \x09-\x0D]+', ''), '[ \x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), shared AS (
  SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT d.*, coalesce(d.doc_id < s.top, false) AS gone FROM keyed d LEFT JOIN shared s USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
