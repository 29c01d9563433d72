import llm_brute
import pytest
from tidemark.llm.linededup import LineRuns, batch_of, dedup_lines, keyed_lines
from pyspark.sql import functions as F

DOCS = "doc_id long, text string"
LONG, OTHER = "a line that many documents hold", "another line of enough letters"

ROWS = [
    (1, f"{LONG}\nown one\n{LONG}"),
    (2, f"  {LONG.upper()}\t\nx"),
    (3, f"y\n{LONG}\n{OTHER}\n{LONG}\n"),
    (4, OTHER),
    (5, None),
    (6, ""),
    (7, "\n\n"),
    (8, "short\nshort"),
    (9, "short"),
    (10, "short"),
    (None, f"{OTHER}\nz"),
    (4, f"{OTHER}\nsame id again"),
    (3, f"y\n{LONG}\n{OTHER}\n{LONG}\n"),
    (11, "é" * 19 + "\n" + "é" * 20),
    (12, "é" * 19 + "\n" + "é" * 20),
    (13, "é" * 19 + "\n" + "é" * 20),
    (14, "\n".join(["q" * 30] * 3000)),
    (15, "q" * 30),
    (16, "q" * 30 + "\n\n"),
]


def answer(df):
    df = df.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("s"))
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("batches, fanout", [(1, 4), (3, 2), (6, 2), (6, 4)])
def test_matches_brute_force(spark, batches, fanout):
    got = answer(dedup_lines(spark.createDataFrame(ROWS, DOCS), batches=batches, fanout=fanout))
    assert got == sorted(llm_brute.dedup_lines(ROWS), key=str)


def test_empty_and_null_tables(spark):
    assert dedup_lines(spark.createDataFrame([], DOCS)).collect() == []
    got = dedup_lines(spark.createDataFrame([(None, None), (None, None)], DOCS)).collect()
    assert [(r.text, r.n_lines, r.n_dropped) for r in got] == [("", 1, 0)] * 2


def keys_of(spark, *rows):
    return keyed_lines(spark.createDataFrame(list(rows), DOCS), 20)


def test_runs_level_up_and_leave_nothing(spark):
    runs = LineRuns(spark, fanout=2)
    for i in range(5):
        runs.add(keys_of(spark, (9 - i, f"{LONG}\nline number {i} of some length")))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    # Three documents were known to hold the shared line when the last two came.
    kept = runs._merged(runs.tables())
    assert {(r.docs, r.top) for r in kept.where("docs > 1").collect()} == {(3, 9)}
    assert [(r.docs, r.top) for r in spark.table(runs.levels[0][0]).collect()] == [(1, 5)]
    assert [r.top for r in runs.shared().collect()] == [9]
    names = runs.tables()
    runs.close()
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_the_anti_join_decides_what_enters_a_run(spark):
    runs = LineRuns(spark, min_docs=2)
    try:
        runs.add(keys_of(spark, (9, LONG), (8, OTHER), (7, OTHER)))
        news = runs.news(keys_of(spark, (6, LONG), (5, OTHER), (4, "a line that no run holds yet")))
        # The settled line stays out, the known one brings its count, the new one its document.
        assert sorted((r.docs, r.top or 0) for r in news.collect()) == [(1, 0), (1, 4)]
        runs.add(keys_of(spark, (6, LONG), (5, OTHER)))
        assert sorted(r.top for r in runs.shared().collect()) == [8, 9]
    finally:
        runs.close()


def test_batches_fall_and_null_ids_come_last(spark):
    ids = spark.createDataFrame([(n,) for n in [1, 5, 6, 9, 10, 11, None]], "doc_id long")
    got = {r.doc_id: r.b for r in ids.select("doc_id", batch_of([5, 10]).alias("b")).collect()}
    assert got == {11: 0, 10: 1, 9: 1, 6: 1, 5: 2, 1: 2, None: 2}


def test_a_failing_run_leaves_no_database(spark, monkeypatch):
    def fail(self, keys):
        raise RuntimeError("lost")

    before = {d.name for d in spark.catalog.listDatabases()}
    monkeypatch.setattr(LineRuns, "add", fail)
    with pytest.raises(RuntimeError):
        dedup_lines(spark.createDataFrame(ROWS, DOCS))
    assert {d.name for d in spark.catalog.listDatabases()} == before


def test_runs_merge_where_they_lie(spark):
    runs = LineRuns(spark)
    for i in range(2):
        runs.add(keys_of(spark, (9 - i, f"{LONG} {i}")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = runs._merged(runs.tables())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    runs.close()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
