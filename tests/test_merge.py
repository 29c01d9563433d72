from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.meta import MetaColumns
from tidemark.operators import merge as M
from tidemark.operators import tombstones as X
from tidemark.operators.records import at

MARK, BEFORE = datetime(2024, 7, 1), datetime(2024, 1, 1)
META = MetaColumns()


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


def test_upsert_overwrites_only_present_columns(spark):
    target = spark.createDataFrame([(1, "a", "keep"), (2, "b", "keep")], "id int, x string, y string")
    load = spark.createDataFrame([(2, None, 5), (3, "c", 6)], "id int, x string, z int")
    want = [(1, "a", "keep", None), (2, None, "keep", 5), (3, "c", None, 6)]
    assert rows(M.upsert(target, load, ["id"])) == want


def test_upsert_twice_is_upsert_once(spark):
    target = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "id int, x string")
    load = spark.createDataFrame([(i, f"s{i}") for i in range(10, 30)], "id int, x string")
    once = M.upsert(target, load, ["id"])
    assert rows(M.upsert(once, load, ["id"])) == rows(once)


def test_guard_keeps_newer_rows(spark):
    target = spark.createDataFrame([(1, "t", 5), (2, "t", 5), (3, "t", None), (4, "t", 5)], "id int, x string, at int")
    load = spark.createDataFrame([(1, "s", 4), (2, "s", 5), (3, "s", 1), (4, "s", None), (5, "s", 1)], "id int, x string, at int")
    got = {r.id: r.x for r in M.upsert(target, load, ["id"], guard="at").collect()}
    assert got == {1: "t", 2: "s", 3: "s", 4: "t", 5: "s"}


def test_keep_last_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i % 7, i, None if i % 3 == 0 else i) for i in range(500)], "k int, ord int, v int")
    want = [(k, max(i for i in range(500) if i % 7 == k)) for k in range(7)]
    for parts in (1, 3, 8):
        got = M.keep_last(df.repartition(parts), ["k"], ["ord"])
        assert rows(got, "k", "ord") == want
        assert rows(got.where("v IS NULL"), "ord") == sorted((o,) for _, o in want if o % 3 == 0)


def test_keep_last_of_bare_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(M.keep_last(df, ["k"], ["k"])) == [(1,), (2,)]


def test_keep_last_carries_maps_and_order_columns(spark):
    df = spark.range(20).select((F.col("id") % 2).alias("k"), F.col("id").alias("ord"), F.create_map(F.lit("a"), "id").alias("m"), F.lit(None).cast("int").alias("n"))
    assert rows(M.keep_last(df, ["k"], ["ord"])) == [(0, 18, {"a": 18}, None), (1, 19, {"a": 19}, None)]


def people(spark, *cells):
    df = spark.createDataFrame(list(cells), f"{META.id} bigint, {META.deleted} boolean, x string")
    return df.withColumn(META.synced, at(BEFORE))


def test_absent_rows_are_marked(spark):
    target = people(spark, (1, False, "a"), (2, None, "b"), (3, True, "c"), (4, False, "d"))
    ids = spark.createDataFrame([(1,), (4,), (4,)], f"{META.id} bigint")
    got = {r[0]: (r[1], r[2]) for r in rows(X.mark_absent(target, ids, MARK), META.id, META.deleted, META.synced)}
    assert got == {1: (False, BEFORE), 2: (True, MARK), 3: (True, BEFORE), 4: (False, BEFORE)}


def test_empty_load_marks_nothing(spark):
    target = people(spark, (1, False, "a"))
    none = spark.createDataFrame([], f"{META.id} bigint")
    assert rows(X.mark_absent(target, none, MARK)) == rows(target)
    empty = target.limit(0)
    assert rows(M.full_sync(target, empty, MARK)) == rows(target)


def test_listed_rows_are_marked(spark):
    target = people(spark, (201, False, "a"), (202, None, "b"), (203, False, "c"), (204, True, "d"))
    ids = spark.createDataFrame([(201,), (202,), (204,), (999,)], f"{META.id} bigint")
    out = X.mark_listed(target, ids, MARK)
    assert out.count() == 4
    assert rows(out.where(F.col(META.synced) == at(MARK)), META.id) == [(201,), (202,)]


def test_full_sync_equals_upsert_then_mark(spark):
    target = people(spark, (1, False, "a"), (2, False, "b"), (3, True, "c"), (5, None, "e"))
    load = people(spark, (1, False, None), (3, False, "back"), (4, False, "new")).withColumn(META.synced, at(MARK))
    one = M.full_sync(target, load, MARK)
    two = X.mark_absent(M.upsert(target, load, [META.id]), load, MARK)
    assert rows(one) == rows(two.select(*one.columns))
    state = {r[META.id]: (r[META.deleted], r["x"]) for r in one.collect()}
    assert state == {1: (False, None), 2: (True, "b"), 3: (False, "back"), 4: (False, "new"), 5: (True, "e")}


def test_changes_in_one_pass_equal_upsert_then_mark(spark):
    target = people(spark, (1, False, "a"), (2, False, "b"), (3, True, "c"), (5, None, "e"), (6, False, "f"))
    load = people(spark, (1, False, None), (3, False, "back"), (4, False, "new"), (6, False, "g"))
    load = load.withColumn(META.synced, at(MARK)).withColumn("extra", F.lit(7))
    gone = spark.createDataFrame([(2,), (3,), (4,), (5,), (5,), (99,)], f"{META.id} bigint")
    one = M.apply_changes(target, load, gone, MARK, META)
    two = X.mark_listed(M.upsert(target, load, [META.id]), gone, MARK)
    assert rows(one) == rows(two.select(*one.columns))


@pytest.mark.parametrize("since, want", [(datetime(2024, 6, 5), [101, 103, 104, 105]), (None, [101, 102, 103, 104, 105])])
def test_archived_since(spark, since, want):
    feed = [
        ("101", "true", "2024-06-10T12:00:00Z"),
        ("102", "true", "2024-06-01T08:00:00Z"),
        ("103", "true", "2024-06-10T15:00:00Z"),
        ("104", "true", None),
        ("105", "true", "garbled"),
        ("x106", "true", "2024-06-10T15:00:00Z"),
        ("107", "false", "2024-06-10T15:00:00Z"),
    ]
    df = spark.createDataFrame(feed, "id string, archived string, archivedAt string")
    assert [r[0] for r in rows(X.archived_since(df, since))] == want


def test_archive_mark_is_exclusive(spark):
    df = spark.createDataFrame([("1", "true", "2024-06-05T00:00:00Z")], "id string, archived string, archivedAt string")
    assert X.archived_since(df, datetime(2024, 6, 5)).count() == 0


def test_replace_where_listed(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    load = spark.createDataFrame([(1, "z")], "k int, v string")
    assert rows(M.replace_where_listed(target, load, ["k"], load)) == [(1, "z"), (2, "c")]


@pytest.mark.parametrize("repeats", [0, 3, 90])
def test_last_rows_of_a_written_table(spark, repeats):
    """Few repeated keys, many or none, null ones among them: the rows are those of keep_last."""
    few = [(None, 1, "n1"), (None, 2, "n2")] if repeats == 3 else []
    df = spark.createDataFrame([(i, 0, f"a{i}") for i in range(100)] + [(i, 1, f"b{i}") for i in range(repeats)] + few, "k int, o int, x string")
    assert rows(M.keep_last_written(df, ["k"], ["o"])) == rows(M.keep_last(df, ["k"], ["o"]))


def test_rows_whose_key_comes_once_are_not_moved(spark):
    df = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("o"))
    assert "Exchange" not in M.keep_last_written(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
