"""Mixing sources to target weights.

The words of a source, document after document in the order of their ids, are one stream that is
packed into blocks of ``block`` words; only a source's last block may be shorter. Every source gets
a whole number of words, its rounded target, and so a number of slots: whole passes over its blocks,
then part of one, whose last slot is trimmed to the word. Slot j of a source takes the block to
which a pseudorandom permutation of the block numbers (a Feistel network with a key for each source
and pass) sends it, so no block comes a second time before all came once, and no document exceeds
three times its words. Output shards have fixed lengths, at most one slot apart. Shard after shard
draws how many of its slots each source fills, a multinomial draw by the slots that the sources have
left; what exceeds a source's rest is drawn again among the others, so in the end every source has all
its slots. A source's slots in the order of j are its counts in shard 0, then in shard 1, and so on, and
a permutation for each shard mixes the sources within it. Slots and blocks are then joined by index.
Seeds are parameters and nothing depends on the partitions, so reruns agree.

A hot source spreads: offsets of words come from a range sort by (source, id) with sums for each
partition, slots are made in chunks of ``CHUNK``, and the join key is (source, block). Only the table of sources,
one row each, is dealt in one task, which refuses more than ``MAX_SOURCES``.

A text without words or null takes no part and takes 0; so does a source without words. Null sources
are one source, last in order; null ids come first in theirs. Rows that repeat an id are documents of
their own. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tables import documents
from tidemark.session import write_once

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 256
CHUNK = 1 << 16
#: No source takes more than this many times its words.
MOST_PASSES = 3
ROUNDS = 4
#: The draws of the shards hold one number for each source and shard; more sources are refused.
MAX_SOURCES = 1_000_000


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _mixed(x: np.ndarray, key: np.uint64) -> np.ndarray:
    x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permuted(at: np.ndarray, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """Where a keyed permutation of ``range(n)`` sends each number of ``at``."""
    if n < 2:
        return np.zeros(len(at), np.int64)
    half = np.uint64((max(2, (n - 1).bit_length()) + 1) // 2)
    mask = np.uint64((1 << int(half)) - 1)
    with np.errstate(over="ignore"):
        base = np.uint64(seed % (1 << 64))
        keys = [_mixed(np.array([base + np.uint64(i)], np.uint64), np.uint64(i))[0] for i in range(ROUNDS)]

        def once(x: np.ndarray) -> np.ndarray:
            left, right = x >> half, x & mask
            for key in reversed(keys) if inverse else keys:
                if inverse:
                    left, right = right ^ (_mixed(left, key) & mask), left
                else:
                    left, right = right, left ^ (_mixed(right, key) & mask)
            return (left << half) | right

        out = once(at.astype(np.uint64))
        # Numbers that leave the range are sent on until they come back.
        while (far := out >= np.uint64(n)).any():
            out[far] = once(out[far])
    return out.astype(np.int64)


def source_targets(sizes: DataFrame, most: int = MOST_PASSES) -> DataFrame:
    """``source, source_size`` (one row each) with ``sid, weight, target``.

    Weights are 1, 2, 3, repeating, in code point order, null last. Targets share the sum of all
    sizes by weight up to ``most`` times the own size. Sources in the order of cap / weight are at
    their cap up to the first whose cap is above its share of what is left; all later ones get their
    share. One row per source: small enough for one ordered window.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn("sid", F.row_number().over(named).cast("long")).withColumn(
        "weight", F.pmod(F.col("sid") - 1, F.lit(3)) + 1
    )
    cap = F.col("source_size") * most
    order = Window.orderBy(cap / F.col("weight"), "sid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    rows = rows.withColumns(
        {
            "_left": F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0)),
            "_share": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    level = F.col("_left") / F.col("_share")
    free = F.when(cap / F.col("weight") >= level, F.struct(cap / F.col("weight"), "sid", "_left", "_share"))
    rows = rows.withColumn("_at", F.min(free).over(whole))
    share = F.col("weight") * F.col("_at._left") / F.col("_at._share")
    target = F.least(cap.cast("double"), F.coalesce(share, cap.cast("double")))
    return rows.select("source", "source_size", "sid", "weight", target.alias("target"))


def _slots_of(source: str | None, size: int, target: float, block: int, seed: int) -> tuple:
    """Slots of a source, its key, and the words that its last slot takes."""
    key = (zlib.crc32(b"" if source is None else b"=" + source.encode()) << 20) + seed
    words, blocks = min(int(target + 0.5), MOST_PASSES * size), -(-size // block)
    if not words:
        return 0, key, 0
    passes, rest = divmod(words, size)
    if not rest:
        return passes * blocks, key, block
    short = size - (blocks - 1) * block
    # Where in this pass the short block comes.
    at = int(permuted(np.array([blocks - 1]), blocks, key + (passes << 8), inverse=True)[0])
    slots = -(-rest // block)
    if at < slots:
        slots = max(at, -(-(rest - short) // block)) + 1
    held = (slots - 1) * block if slots - 1 <= at else (slots - 2) * block + short
    return passes * blocks + slots, key, rest - held


def deal_slots(slots: np.ndarray, n_shards: int, seed: int) -> np.ndarray:
    """How many of its slots each source (row) has in each shard (column)."""
    draw = np.random.Generator(np.random.Philox(seed))
    total = int(slots.sum())
    left = slots.astype(np.int64)
    dealt = np.zeros((len(slots), n_shards), np.int64)
    for shard in range(n_shards):
        need = total // n_shards + (shard < total % n_shards)
        while need:
            some = np.flatnonzero(left)
            took = np.minimum(draw.multinomial(need, left[some] / left.sum()), left[some])
            left[some] -= took
            dealt[some, shard] += took
            need -= int(took.sum())
    return dealt


def plan_slots(sources: DataFrame, n_shards: int, block: int, seed: int) -> DataFrame:
    """``sid, source_size, slots, key, last`` and, as lists over the shards, how many slots the source has
    in each (``dealt``), where they start (``starts``) and the shards' lengths (``lengths``)."""

    def plan(b: pd.DataFrame) -> pd.DataFrame:
        if len(b) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources")
        b = b.sort_values("sid")
        rows = []
        for r in b.itertuples():
            name = None if pd.isna(r.source) else r.source
            rows.append((r.sid, r.source_size, *_slots_of(name, r.source_size, r.target, block, seed)))
        out = pd.DataFrame(rows, columns=["sid", "source_size", "slots", "key", "last"])
        dealt = deal_slots(out["slots"].to_numpy(np.int64), n_shards, seed)
        lengths = dealt.sum(axis=0)
        starts = np.cumsum(dealt, axis=0) - dealt
        return out.assign(dealt=list(dealt), starts=list(starts), lengths=[lengths] * len(out))

    shape = "sid long, source_size long, slots long, key long, last long"
    return sources.select("sid", "source", "source_size", "target").groupBy().applyInPandas(
        plan, f"{shape}, dealt array<long>, starts array<long>, lengths array<long>"
    )


def draw_slots(plans: DataFrame, block: int, seed: int) -> DataFrame:
    """``sid, block, epoch, take, shard, slot``: every slot, with the block that it takes."""

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                first, n = r.chunk * CHUNK, -(-r.source_size // block)
                j = np.arange(first, min(first + CHUNK, r.slots))
                epoch = j // n
                taken = np.empty(len(j), np.int64)
                for e in np.unique(epoch):
                    own = epoch == e
                    taken[own] = permuted(j[own] % n, n, r.key + (int(e) << 8))
                words = np.where(taken == n - 1, r.source_size - (n - 1) * block, block)
                words[j == r.slots - 1] = np.minimum(words[j == r.slots - 1], r.last)
                ends = np.cumsum(r.dealt)
                shard = np.searchsorted(ends, j, side="right")
                slot = (r.starts - ends + r.dealt)[shard] + j
                for k in np.unique(shard):
                    own = shard == k
                    slot[own] = permuted(slot[own], int(r.lengths[k]), (seed << 20) + int(k))
                yield pd.DataFrame(
                    {"sid": r.sid, "block": taken, "epoch": epoch, "take": words, "shard": shard, "slot": slot}
                )

    chunks = plans.where("slots > 0").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(slots - 1) div {CHUNK}")))
    )
    parts = int(plans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return chunks.repartition(parts).mapInPandas(
        draw, "sid long, block long, epoch long, take long, shard long, slot long"
    )


def pack_blocks(rows: DataFrame, block: int) -> DataFrame:
    """``sid, rid, block, at, words, doc_at``: the pieces of documents that blocks are packed of.

    ``rows`` (``sid, rid, size, doc_id, _x``) is a written table. A piece has its first word's place
    in the block and in the document. Documents without words have no piece.
    """
    order = ["doc_id", "size", "_x", "rid"]
    sized = rows.where("size > 0")
    ranged = sized.repartitionByRange("sid", *order).sortWithinPartitions("sid", *order)
    placed = write_once(ranged.withColumn("_part", F.spark_partition_id()), "mix-order")
    earlier = Window.partitionBy("sid").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        placed.groupBy("sid", "_part")
        .agg(F.sum("size").alias("_words"))
        .withColumn("_before", F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
        .drop("_words")
    )
    running = Window.partitionBy("sid", "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("_before") + F.col("_upto") - F.col("size")
    placed = (
        placed.withColumn("_upto", F.sum("size").over(running))
        .join(parts, ["sid", "_part"])
        .select("sid", "rid", "size", start.alias("_start"))
    )
    piece = F.explode(F.sequence(F.expr(f"_start div {block}"), F.expr(f"(_start + size - 1) div {block}")))
    first = F.greatest("_start", F.col("block") * block)
    end = F.least(F.col("_start") + F.col("size"), (F.col("block") + 1) * block)
    return placed.withColumn("block", piece).select(
        "sid",
        "rid",
        "block",
        (first - F.col("block") * block).alias("at"),
        (end - first).alias("words"),
        (first - F.col("_start")).alias("doc_at"),
    )


def mix(rows: DataFrame, n_shards: int = 16, block: int = BLOCK, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """The mix of ``rows`` (``rid, doc_id, source, size, _x``, a written table).

    Returns the sources with their targets, and every drawn piece of a document: ``rid, shard, slot,
    sid, block, epoch, doc_at, words``.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = write_once(source_targets(sizes), "mix-sources")
    named = sources.select(F.col("source").alias("_source"), "sid")
    sided = rows.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "source")
    pieces = pack_blocks(sided, block)
    slots = draw_slots(plan_slots(sources, n_shards, block, seed), block, seed)
    words = F.least(F.col("at") + F.col("words"), "take") - F.least("at", "take")
    drawn = pieces.join(slots, ["sid", "block"]).withColumn("words", words).where("words > 0")
    return sources, drawn.select("rid", "shard", "slot", "sid", "block", "epoch", "doc_at", "words")


def sized_rows(docs: DataFrame, *carry: Column) -> DataFrame:
    return write_once(
        docs.select(
            "doc_id",
            "source",
            n_words("text").alias("size"),
            F.xxhash64("text").alias("_x"),
            F.monotonically_increasing_id().alias("rid"),
            *carry,
        ),
        "mix-rows",
    )


@F.pandas_udf(T.StringType())
def cut_words(texts: pd.Series, pieces: pd.Series) -> pd.Series:
    """The stretches of words that ``pieces`` (first word, words) name, with the white space inside."""

    def cut(text: str | None, wanted) -> str | None:
        if text is None:
            return None
        spans = [m.span() for m in re.finditer(WORD, text)]
        found = sorted((p["doc_at"], p["words"]) for p in wanted)
        joined: list[list[int]] = []
        for at, n in found:
            if joined and joined[-1][1] == at:
                joined[-1][1] = at + n
            else:
                joined.append([at, at + n])
        return "\n".join(text[spans[a][0] : spans[b - 1][1]] for a, b in joined)

    return pd.Series([cut(t, p) for t, p in zip(texts, pieces)], dtype=object)


def mixed_documents(docs: DataFrame, n_shards: int = 16, block: int = BLOCK, seed: int = 1) -> DataFrame:
    """The mix as documents, with the columns of ``docs``.

    A row stands for what one pass took of a document: its whole text as it was, or the words taken
    from it. ``n_chars`` follows the text where there is such a column.
    """
    rows = sized_rows(docs, F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    _, drawn = mix(rows.drop("_row"), n_shards, block, seed)
    taken = drawn.groupBy("rid", "epoch").agg(
        F.sum("words").alias("_taken"), F.collect_list(F.struct("doc_at", "words")).alias("_pieces")
    )
    met = taken.join(rows.select("rid", "size", "_row"), "rid")
    part = F.col("_taken") < F.col("size")
    met = met.withColumn(
        "_cut", cut_words(F.when(part, F.col("_row.text")), F.when(part, F.col("_pieces")))
    )
    text = F.coalesce("_cut", "_row.text")
    columns = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return met.select(*[columns.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Besides the columns of the contract ``shards``, the output shards that hold words of the document."""
    rows = sized_rows(documents(spark, folder))
    sources, drawn = mix(rows)
    taken = drawn.groupBy("rid").agg(
        F.sum("words").alias("_taken"), F.sort_array(F.collect_set(F.col("shard").cast("int"))).alias("_shards")
    )
    named = sources.withColumnRenamed("source", "_source")
    return (
        rows.join(taken, "rid", "left")
        .join(named, F.col("source").eqNullSafe(F.col("_source")))
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            F.coalesce("_taken", F.lit(0)).cast("long").alias("taken"),
            F.coalesce("_shards", F.array().cast("array<int>")).alias("shards"),
        )
    )
