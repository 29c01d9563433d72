"""Run health: null profiles, counters, status, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import write_once

SUMMARY = (
    "object_type STRING, status STRING, duration_seconds DOUBLE, records_fetched BIGINT,"
    " records_processed_ok BIGINT, records_failed BIGINT, db_upserts BIGINT,"
    " db_insert_errors BIGINT, pipelines_loaded BIGINT, stages_loaded BIGINT,"
    " association_tables_created BIGINT, associations_found BIGINT, schema_changes BIGINT,"
    " columns_truncated BIGINT, records_deleted BIGINT, sync_mode STRING, finished_at TIMESTAMP_NTZ"
)

#: What a run writes down about its load: emptiest columns, names that were cut, and all objects at once.
NULLS = (
    "object_type STRING, finished_at TIMESTAMP_NTZ, `column` STRING, null_count BIGINT, pct DOUBLE, alert BOOLEAN"
)
TRUNCATED = "object_type STRING, finished_at TIMESTAMP_NTZ, original STRING, final STRING"
ROLL_UP = (
    "finished_at TIMESTAMP_NTZ, all_healthy BOOLEAN, objects BIGINT, records_processed_ok BIGINT,"
    " records_failed BIGINT, objects_failed BIGINT"
)


def _share(nulls: Column, rows: Column) -> Column:
    # An empty load has no share.
    return F.try_divide(nulls, rows) * 100


def _as_rows(wide: DataFrame, columns: list[str]) -> DataFrame:
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"_{i}.nulls").alias("null_count"),
                F.col(f"_{i}.pct").alias("pct"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return wide.select(F.inline(entries)).where(F.col("null_count") > 0)


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, null_count, pct) over the whole load, from one pass and one aggregate row."""
    columns = columns or df.columns
    rows = F.count(F.lit(1))
    counts = [F.count_if(F.col(c).isNull()) for c in columns]
    wide = df.agg(
        *[
            F.struct(n.alias("nulls"), _share(n, rows).alias("pct")).alias(f"_{i}")
            for i, n in enumerate(counts)
        ]
    )
    return _as_rows(wide, columns)


def null_worst_batch(
    df: DataFrame, batch: str, columns: list[str] | None = None
) -> DataFrame:
    """The same numbers from each column's worst batch; of equally bad batches the first."""
    columns = columns or [c for c in df.columns if c != batch]
    rows = F.count(F.lit(1)).alias("_rows")
    per_batch = df.groupBy(batch).agg(
        rows, *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)]
    )
    worst = per_batch.agg(
        *[
            F.min(
                F.struct(
                    (-_share(F.col(f"_n{i}"), F.col("_rows"))).alias("rank"),
                    F.col(batch).alias("batch"),
                    F.col(f"_n{i}").alias("nulls"),
                )
            ).alias(f"_w{i}")
            for i in range(len(columns))
        ]
    )
    wide = worst.select(
        *[
            F.struct(
                F.col(f"_w{i}.nulls").alias("nulls"), (-F.col(f"_w{i}.rank")).alias("pct")
            ).alias(f"_{i}")
            for i in range(len(columns))
        ]
    )
    return _as_rows(wide, columns)


def top_null_columns(profile: DataFrame, n: int = 10, alert: float = 10.0) -> DataFrame:
    """The ``n`` emptiest columns, flagged above ``alert`` per cent."""
    top = profile.orderBy(F.desc("pct"), "column").limit(n)
    return top.select("*", (F.col("pct") > alert).alias("alert"))


def truncated_report(columns: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` of the distinct (original, final) pairs by name, with how many are left out."""
    pairs = write_once(columns.select("original", "final").distinct(), "truncated-names")
    total = pairs.agg(F.count(F.lit(1))).scalar()
    top = pairs.orderBy("original", "final").limit(n)
    return top.select("*", F.greatest(total - n, F.lit(0)).alias("not_shown"))


def status(failed: Column, errors: Column) -> Column:
    return F.when((failed == 0) & (errors == 0), "healthy").otherwise("with_errors")


def health(counters: DataFrame) -> DataFrame:
    """Counters per object with their status."""
    return counters.withColumn(
        "status", status(F.col("records_failed"), F.col("db_insert_errors"))
    )


def roll_up(runs: DataFrame) -> DataFrame:
    """All objects of a run in one row."""
    return runs.agg(
        F.bool_and(F.col("status") == "healthy").alias("all_healthy"),
        F.count(F.lit(1)).alias("objects"),
        F.sum("records_processed_ok").alias("records_processed_ok"),
        F.sum("records_failed").alias("records_failed"),
    )
