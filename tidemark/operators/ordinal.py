"""Exact row numbers without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import write_once


def occurrence_number(
    df: DataFrame,
    group: list[str],
    order: list[str],
    out: str = "n",
    partitions: int | None = None,
    costly: bool = False,
) -> DataFrame:
    """``row_number() OVER (PARTITION BY group ORDER BY order)``, for groups of any size.

    Rows are range-partitioned and sorted by (group, order), so a hot group spreads over many
    partitions. The sorted rows are written once with their partition and running position; each
    row's number is then its distance from the start of its group's run in that partition, plus
    the rows of the group in earlier partitions. ``order`` must be a total order in each group.

    A range sort computes its input twice, first to sample it; with ``costly`` the input is written
    down before.
    """
    df = write_once(df, "unnumbered") if costly else df
    by = [F.col(c) for c in [*group, *order]]
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    placed = ranged.sortWithinPartitions(*by).select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().alias("_seq"),
    )
    placed = write_once(placed, "occurrences")

    runs = placed.groupBy(*group, "_part").agg(
        F.min("_seq").alias("_start"), F.count(F.lit(1)).alias("_len")
    )
    # One row per (group, partition): the partitions of one range sort, not the rows of the group.
    earlier = (
        Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    runs = runs.withColumn("_before", F.coalesce(F.sum("_len").over(earlier), F.lit(0))).select(
        *[F.col(c).alias(f"_g_{c}") for c in group],
        F.col("_part").alias("_run_part"),
        "_start",
        "_before",
    )
    same_run = F.col("_part") == F.col("_run_part")
    for c in group:
        same_run = same_run & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    number = F.col("_seq") - F.col("_start") + F.col("_before") + 1
    return placed.join(runs, same_run).select(*df.columns, number.alias(out))


def number_batches(df: DataFrame, order: list[str], size: int = 100, out: str = "batch") -> DataFrame:
    """Fixed-size batches in ``order``: 0 for the first ``size`` rows, 1 for the next, ..."""
    numbered = occurrence_number(df, [], order, out="_n")
    return numbered.withColumn(out, F.expr(f"(_n - 1) div {int(size)}")).drop("_n")
