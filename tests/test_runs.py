from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.casts import parse_instant
from tidemark.meta import MetaColumns
from tidemark.operators import evolve as V
from tidemark.operators import profile as P
from tidemark.operators import state as S
from tidemark.operators.ordinal import number_batches, occurrence_number


def test_state_log(spark):
    log = spark.createDataFrame(
        [("contacts", datetime(2024, 6, 1, 10), 500, "full", datetime(2024, 6, 1, 11)),
         ("contacts", datetime(2024, 6, 2, 10), 5, "incremental", datetime(2024, 6, 2, 11)),
         ("deals", datetime(2024, 6, 3), 7, "full", datetime(2024, 6, 3))], S.STATE)
    assert S.last_mark(log, "contacts") == datetime(2024, 6, 2, 10)
    assert S.last_mark(log, "meters") is None
    assert {r.object_type: r.records_synced for r in S.latest_state(log).collect()} == {"contacts": 5, "deals": 7}


def test_modified_since_is_inclusive_and_ordered(spark):
    df = spark.createDataFrame([(1, "2024-06-01T10:00:00Z"), (2, "2024-06-01T09:59:59Z"), (3, "2024-06-03T00:00:00Z"), (4, None), (5, "2024-06-02T00:00:00Z")], "id int, at string")
    changed = S.modified_since(df, parse_instant(F.col("at")), datetime(2024, 6, 1, 10), ordered=True)
    assert [r.id for r in changed.collect()] == [1, 5, 3]
    assert S.exceeds(changed, 2) and not S.exceeds(changed, 3) and not S.exceeds(changed, None)


def test_mode():
    since = datetime(2024, 6, 1)
    assert S.choose_mode(None) == "full"
    assert S.choose_mode(since) == "incremental"
    assert S.choose_mode(since, force_full=True) == "full"
    assert S.choose_mode(since, over_threshold=True) == "full"


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, 5, "y"), (4, 6, "z")], "id int, a int, b string")
    got = {r.column: (r.null_count, r.pct) for r in P.null_profile(df).collect()}
    assert got == {"a": (2, 50.0), "b": (1, 25.0)}
    assert P.null_profile(df.where("a = 6")).count() == 0


def test_worst_batch_and_ties(spark):
    cells = [(0, None), (0, 1), (1, None), (1, None), (1, 1), (2, None), (2, None), (2, None), (2, 1), (2, 1), (2, 1)]
    df = spark.createDataFrame(cells, "batch int, a int")
    row = P.null_worst_batch(df, "batch").first()
    assert (row.column, row.null_count, round(row.pct, 3)) == ("a", 2, 66.667)
    tied = P.null_worst_batch(df.where("batch <> 1"), "batch").first()
    assert (tied.null_count, tied.pct) == (1, 50.0)


def test_top_null_columns(spark):
    profile = spark.createDataFrame([(f"c{i:02d}", i, float(i)) for i in range(15)], "column string, null_count bigint, pct double")
    top = P.top_null_columns(profile).collect()
    assert [r.column for r in top] == [f"c{i:02d}" for i in range(14, 4, -1)]
    assert [r.alert for r in top] == [True] * 4 + [False] * 6


def test_truncated_report(spark):
    pairs = [(f"n{i:02d}", f"s{i}") for i in range(12)] * 2
    rows = P.truncated_report(spark.createDataFrame(pairs, "original string, final string")).collect()
    assert [r.original for r in rows] == [f"n{i:02d}" for i in range(10)] and rows[0].not_shown == 2


def test_status_and_roll_up(spark):
    df = spark.createDataFrame([("a", 5, 0, 0), ("b", 4, 1, 0)], "object_type string, records_processed_ok int, records_failed int, db_insert_errors int")
    runs = P.health(df)
    assert {r.object_type: r.status for r in runs.collect()} == {"a": "healthy", "b": "with_errors"}
    assert tuple(P.roll_up(runs).first()) == (False, 2, 9, 1)


def test_occurrence_numbers_of_a_hot_group(spark):
    df = spark.range(0, 3000, numPartitions=5).select(
        F.when(F.col("id") % 3 == 0, "cold").when(F.col("id") == 1, None).otherwise("hot").alias("g"), (F.col("id") * 7 % 3001).alias("o"))
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    for parts in (None, 1, 7):
        got = occurrence_number(df, ["g"], ["o"], partitions=parts)
        assert got.exceptAll(want).isEmpty() and got.count() == 3000


def test_batches(spark):
    df = spark.range(250).select((F.lit(1000) - F.col("id")).alias("o"))
    got = number_batches(df, ["o"]).groupBy("batch").agg(F.count("*"), F.min("o")).orderBy("batch")
    assert [tuple(r) for r in got.collect()] == [(0, 100, 751), (1, 100, 851), (2, 50, 951)]


def test_evolution_adds_columns_once(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS evo")
    V.create_table(spark, "evo.t", V.base_columns(MetaColumns()))
    load = spark.createDataFrame([], "hs_object_id bigint, email string")
    assert V.add_columns(spark, "evo.t", load.schema) == ["email"]
    assert V.add_columns(spark, "evo.t", load.schema) == []
    both = spark.createDataFrame([], "hs_object_id bigint, EMAIL string, phone double")
    assert V.add_columns(spark, "evo.t", both.schema) == ["phone"]
    assert V.add_columns(spark, "evo.missing", load.schema) == []
    assert dict(spark.table("evo.t").dtypes)["phone"] == "double"


def test_align_and_stack(spark):
    target = spark.createDataFrame([(1, 5.0)], "id bigint, v double")
    load = spark.createDataFrame([("2", "x", True), ("3", "7", None)], "id string, v string, extra boolean")
    aligned = V.align(load, target.schema)
    assert aligned.dtypes == [("id", "bigint"), ("v", "double"), ("extra", "boolean")]
    assert sorted(map(tuple, V.stack(target, aligned).collect())) == [(1, 5.0, None), (2, None, True), (3, 7.0, None)]
    assert V.evolve(target, aligned.schema).columns == ["id", "v", "extra"]
