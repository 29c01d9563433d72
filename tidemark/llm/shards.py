"""Shards of near-equal bytes by histogram sort. DataFrame functions only.

Rows are ordered by a key of two words: 60 bits of the MD5 of the text, so equal texts are
neighbours, then 60 bits of the MD5 of the id. Splitters are found by counting: every pass sums the
exact bytes of the rows in the bins of a radix grid, only inside the intervals where a splitter is
still open, and the driver sees those sums alone (at most 4,096 bins first, then 64 for each open
splitter). A splitter is settled at the grid edge nearest to its target once that edge is within the
tolerance, at the latest at the edge of a single (text, id). So a group of equal texts is cut only
where the law of equal bytes demands it, and a group of any size can be cut. Then all rows are
exchanged once.

Each shard is made of cells, as many in all as there are shuffle partitions; a task holds a cell,
never a whole shard. Slots are row numbers in a cell plus the exact count of rows before it.

Null text counts as an empty one, a null id as an empty id text. Rows that repeat both text and id
stay together. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import documents
from tidemark.session import write_once

WORD_BITS = 60
FIRST_BITS, MORE_BITS = 12, 6
#: (word, bits of it that the grid tells apart) of every pass, coarse to fine.
LEVELS = [
    (word, bits)
    for word in ("_h", "_t")
    for bits in range(FIRST_BITS, WORD_BITS + 1, MORE_BITS)
]
#: How far a shard's edge, and that of a cell inside it, may be off, in shards and in cells.
SHARD_TOLERANCE = (1, 100)
CELL_TOLERANCE = (1, 4)


def key_word(value: Column) -> Column:
    """60 bits of the MD5 of a text, as a long that is not negative."""
    return F.conv(F.substring(F.md5(F.coalesce(value, F.lit(""))), 1, 15), 16, 10).cast("long")


def text_bytes(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def key_columns(key: str = "doc_id", text: str = "text") -> list[Column]:
    return [
        key_word(F.col(text)).alias("_h"),
        key_word(F.col(key).cast("string")).alias("_t"),
        text_bytes(text).alias("_size"),
    ]


@dataclass
class Splitter:
    """One edge between cells while it is sought: its interval's prefix and what lies below that."""

    index: int
    prefix: tuple[int, ...] = ()
    below: int = 0
    rows_below: int = 0
    edge: tuple[int, int] | None = None


def _prefix(word: str, bits: int) -> Column:
    return F.shiftright(F.col(word), WORD_BITS - bits)


def _counts(rows: DataFrame, level: int, active: list[tuple[int, ...]]) -> dict:
    """Bytes and rows of every grid bin in the active intervals, by interval."""
    word, bits = LEVELS[level]
    names: list[str] = []
    if level:
        last, before = LEVELS[level - 1]
        wide = {"_p0": F.col("_h") if word == "_t" else _prefix(last, before)}
        if word == "_t" and last == "_t":
            wide["_p1"] = _prefix("_t", before)
        names = list(wide)
        # One row for each open splitter at most: bounded by the number of cells.
        seek = rows.sparkSession.createDataFrame(
            active, ", ".join(f"{n} long" for n in names)
        ).distinct()
        rows = rows.withColumns(wide).join(F.broadcast(seek), names, "left_semi")
    found = (
        rows.groupBy(*names, _prefix(word, bits).alias("_bin"))
        .agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
        .collect()
    )
    bins: dict[tuple, list] = {}
    for r in found:
        bins.setdefault(tuple(r[n] for n in names), []).append((r["_bin"], r["_bytes"], r["_rows"]))
    return {k: sorted(v) for k, v in bins.items()}


def _edge(level: int, prefix: tuple[int, ...], at: int) -> tuple[int, int]:
    """The key at which a grid bin begins."""
    word, bits = LEVELS[level]
    low = at << (WORD_BITS - bits)
    return (low, 0) if word == "_h" else (prefix[0], low)


def find_splitters(rows: DataFrame, n_shards: int, per_shard: int) -> tuple[list[Splitter], int, int]:
    """Splitters between ``n_shards * per_shard`` cells of ``rows`` (``_h``, ``_t``, ``_size``).

    Returns them in order, with all bytes and all rows. The arithmetic is in whole numbers.
    """
    cells = n_shards * per_shard
    todo = [Splitter(i) for i in range(1, cells)]
    done: list[Splitter] = []
    total, n_rows, level = 0, 0, 0
    while True:
        bins = _counts(rows, level, [s.prefix for s in todo])
        if level == 0:
            total, n_rows = (sum(b[k] for b in bins.get((), [])) for k in (1, 2))
        still = []
        for s in todo:
            aim = total * s.index
            off, of = SHARD_TOLERANCE if s.index % per_shard == 0 else CELL_TOLERANCE
            scale = n_shards if s.index % per_shard == 0 else cells
            below, rows_below, inside = s.below, s.rows_below, bins.get(s.prefix, [])
            for n, (at, size, count) in enumerate(inside):
                if cells * (below + size) >= aim or n == len(inside) - 1:
                    break
                below, rows_below = below + size, rows_below + count
            if not inside:
                s.edge = (0, 0)
                done.append(s)
                continue
            low, high = aim - cells * below, cells * (below + size) - aim
            near = low if low <= high else high
            if near * of * scale <= off * total * cells or level == len(LEVELS) - 1:
                s.edge = _edge(level, s.prefix, at if low <= high else at + 1)
                s.below = below if low <= high else below + size
                s.rows_below = rows_below if low <= high else rows_below + count
                done.append(s)
            else:
                word, bits = LEVELS[level]
                if word == "_h":
                    s.prefix = (at,)
                else:
                    s.prefix = (s.prefix[0], at)
                s.below, s.rows_below = below, rows_below
                still.append(s)
        todo, level = still, level + 1
        if not todo:
            return sorted(done, key=lambda s: s.index), total, n_rows


def _cell_column(spark: SparkSession, rows: DataFrame, edges: list[tuple[int, int]]) -> DataFrame:
    """``_cell``: the number of edges at or below a row's key.

    The edges are dealt to the 4,096 coarse bins, so a row is compared with those of its bin only.
    """
    first: dict[int, list] = {}
    table, passed = [], 0
    for h, t in edges:
        first.setdefault(min(h >> (WORD_BITS - FIRST_BITS), (1 << FIRST_BITS) - 1), []).append((h, t))
    for b in range(1 << FIRST_BITS):
        inside = first.get(b, [])
        table.append((b, passed, inside))
        passed += len(inside)
    # 4,096 rows and the edges: bounded by the number of cells.
    bins = spark.createDataFrame(table, "_coarse long, _base int, _edges array<struct<h: long, t: long>>")
    at_or_below = F.size(
        F.filter(
            "_edges",
            lambda e: (e["h"] < F.col("_h")) | ((e["h"] == F.col("_h")) & (e["t"] <= F.col("_t"))),
        )
    )
    return (
        rows.withColumn("_coarse", _prefix("_h", FIRST_BITS))
        .join(F.broadcast(bins), "_coarse")
        .withColumn("_cell", F.col("_base") + at_or_below)
        .drop("_coarse", "_base", "_edges")
    )


def histogram_shards(rows: DataFrame, keyed: DataFrame, n_shards: int) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``.

    ``keyed`` holds the key words and sizes of the same rows in a written table, which every pass
    reads; ``rows`` (with ``_h`` and ``_t``) may be that table or carry texts as well.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    per_shard = max(1, -(-parts // n_shards))
    splitters, _, _ = find_splitters(keyed, n_shards, per_shard)
    placed = _cell_column(spark, rows, [s.edge for s in splitters])
    starts = [0, *(s.rows_below for s in splitters)]
    first = [(c, starts[c] - starts[c - c % per_shard]) for c in range(len(starts))]
    offsets = spark.createDataFrame(first, "_cell int, _before long")
    order = Window.partitionBy("_cell").orderBy("_h", "_t")
    return (
        placed.withColumn("_n", F.row_number().over(order).cast("long") - 1)
        .join(F.broadcast(offsets), "_cell")
        .withColumn("shard", F.floor(F.col("_cell") / per_shard).cast("int"))
        .withColumn("slot", F.col("_n") + F.col("_before"))
        .drop("_cell", "_n", "_before")
    )


def shard_documents(docs: DataFrame, n_shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs``, its columns first, with ``shard`` and ``slot``; texts move once.

    Columns of ``docs`` with those two names are replaced.
    """
    kept = docs.drop("shard", "slot")
    full = kept.select(F.struct("*").alias("_row"), *key_columns(key, text))
    keyed = write_once(kept.select(*key_columns(key, text)), "shard-keys")
    return histogram_shards(full, keyed, n_shards).select("_row.*", "shard", "slot")


def op5_histogram_shards(spark: SparkSession, folder: str, n_shards: int = 16) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    crc = F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32")
    keyed = write_once(docs.select("doc_id", crc, *key_columns()), "shard-keys")
    return histogram_shards(keyed, keyed, n_shards).select(
        "doc_id",
        F.col("_size").alias("size"),
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
