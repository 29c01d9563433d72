"""Connected components of a graph that no task holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import write_once


def _tally(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for the nodes of ``edges`` (``a, b``, longs): the least node reachable.

    Alternating large and small stars: every node hangs its larger neighbours, then its smaller ones
    and itself, on the least node that it sees, until nothing moves. Each step is written down.
    A node with many neighbours is summed up before it is joined, and its join is one that AQE can
    split. Loops and null ends are ignored.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = write_once(pairs.distinct(), "edges")
    before = _tally(pairs)
    while True:
        both = pairs.union(pairs.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.where("a <> b").union(low).distinct()
        pairs = write_once(small, "edges")
        now = _tally(pairs)
        if now == before:
            break
        before = now
    ends = pairs.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return write_once(ends.union(pairs.select("b", "b")).distinct(), "components")
