import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tidemark.llm.shards import shard_documents

DOCS = "doc_id long, text string"


def key(row):
    word = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:15], 16)
    return word(row[1] or ""), word("" if row[0] is None else str(row[0]))


def size(row):
    return len((row[1] or "").encode()) + 1


def check(rows, got, n):
    got = sorted(((r.doc_id, r.text, r.shard, r.slot) for r in got), key=lambda r: (r[2], r[3]))
    assert sorted(map(key, got)) == sorted(map(key, rows))
    # Shards are stretches of the key order, and slots have no gaps.
    assert [key(r) for r in got] == sorted(map(key, rows))
    for s in range(n):
        assert [r[3] for r in got if r[2] == s] == list(range(sum(r[2] == s for r in got)))
    total, below = sum(map(size, rows)), 0
    edges = {}
    for r in got:
        edges.setdefault(key(r), below)
        below += size(r)
    for s in range(1, n):
        at = sum(size(r) for r in got if r[2] < s)
        off = abs(n * at - total * s)
        nearest = min(abs(n * e - total * s) for e in [*edges.values(), total])
        # Within the tolerance, or as near as whole rows allow.
        assert off * 100 <= total or off == nearest
        # A group of equal texts is cut only if neither of its edges will do.
        left, right = ([r for r in got if (r[2] < s) == low] for low in (True, False))
        if left and right and (left[-1][1] or "") == (right[0][1] or ""):
            group = [edges[key(r)] for r in got if (r[1] or "") == (right[0][1] or "")]
            ends = min(group), max(group) + size(right[0])
            assert all(abs(n * e - total * s) * 100 > total for e in ends)


def documents(n, seed):
    rng = random.Random(seed)
    rows = [(i, "x" * rng.choice([0, 3, 50, 400])  + str(rng.randrange(10**6))) for i in range(n)]
    return rows + [(n + i, "one text that a third of all rows hold " * 3) for i in range(n // 2)]


@pytest.mark.parametrize("n", [1, 4, 16])
def test_shards_are_near_equal(spark, n):
    rows = documents(600, n)
    check(rows, shard_documents(spark.createDataFrame(rows, DOCS), n).collect(), n)


def test_odd_rows(spark):
    rows = [(None, None), (None, ""), (1, None), (2, "é" * 9), (3, "a" * 200_000), (3, "a" * 200_000)]
    rows += [(9, "b"), (9, "c")]
    check(rows, shard_documents(spark.createDataFrame(rows, DOCS), 16).collect(), 16)


def test_empty_table_and_single_row(spark):
    assert shard_documents(spark.createDataFrame([], DOCS), 16).collect() == []
    got = shard_documents(spark.createDataFrame([(1, "a")], DOCS), 16).collect()
    assert [r.slot for r in got] == [0] and 0 <= got[0].shard < 16


def test_only_equal_texts_are_cut_by_id(spark):
    rows = [(i, "same") for i in range(160)]
    got = shard_documents(spark.createDataFrame(rows, DOCS), 16).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in got) == [10] * 16


def test_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], DOCS)
    df = df.withColumns({"_h": F.lit("h"), "_cell": F.lit(7), "slot": F.lit("old"), "n": F.lit(1)})
    got = shard_documents(df, 2)
    assert got.columns == ["doc_id", "text", "_h", "_cell", "n", "shard", "slot"]
    assert {(r._h, r._cell, r.n) for r in got.collect()} == {("h", 7, 1)}
