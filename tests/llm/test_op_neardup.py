import random

import llm_brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from tidemark.llm import neardup
from tidemark.llm.graph import components
from tidemark.llm.neardup import drop_near_duplicates, near_duplicates
from tidemark.llm.shingles import shingles

DOCS = "doc_id long, text string"


def answer(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def edited(words, share, rng):
    return " ".join(w if rng.random() > share else f"e{rng.randrange(10**9)}" for w in words)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    base = [f"w{rng.randrange(400)}" for _ in range(150)]
    other = [f"v{rng.randrange(400)}" for _ in range(60)]
    rows = [(i, edited(base, rng.choice([0, 0.01, 0.03, 0.05, 0.08]), rng)) for i in range(80)]
    rows += [(100 + i, " ".join(other) + "\n" + edited(base[:40], 0.5, rng)) for i in range(6)]
    rows += [(200, " ".join(base).upper()), (201, " ".join(base)), (201, "one two"), (202, "one  TWO")]
    rows += [(300, None), (301, ""), (302, " \t\n"), (None, " ".join(base)), (None, None)]
    rows += [(400 + i, " ".join(f"u{i}x{j}" for j in range(30))) for i in range(10)]
    return rows + [(500, "a b c d e"), (501, "a b c d e f"), (502, "A B C D E"), (200, " ".join(base).upper())]


def test_components_match_brute_force(spark, corpus):
    got = answer(near_duplicates(spark.createDataFrame(corpus, DOCS)))
    assert got == sorted(llm_brute.near_duplicates(corpus), key=str)


def test_kept_is_the_smallest_and_null_ids_stay(spark, corpus):
    rows = near_duplicates(spark.createDataFrame(corpus, DOCS)).collect()
    assert len(rows) == len(corpus)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in rows)


def test_one_table_only_still_finds_what_meets(spark, corpus, monkeypatch):
    """The exact end finds the links of mixed buckets without any round before it."""
    monkeypatch.setattr(neardup, "ROUNDS", 0)
    got = answer(near_duplicates(spark.createDataFrame(corpus, DOCS)))
    assert got == sorted(llm_brute.near_duplicates(corpus), key=str)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_dropping_keeps_columns_of_any_name(spark):
    text = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(2, text, 1), (1, text, 2), (3, None, 3)], "doc_id long, text string, n long")
    df = df.withColumn("label", F.lit("x")).withColumn("cid", F.lit("y"))
    got = drop_near_duplicates(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id, r.n, r.label, r.cid) for r in got.collect()) == [(1, 2, "x", "y"), (3, 3, "x", "y")]


def test_shingles_are_the_sets_of_words():
    for text in ["a", "a b", "b a", "a b c d", "a b c d e", "a b c d e a b c d e", "x " * 500, None, " "]:
        assert len(shingles(text)) == len(llm_brute.shingle_set(text))
    assert len(np.intersect1d(shingles("A b c d e f"), shingles("a B c d e"))) == 1
    assert len(np.intersect1d(shingles("a"), shingles("a a"))) == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert {r.node: r.label for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_rows_without_id_are_copies_like_any_others(spark):
    """A third of the rows have no id, another third one and the same."""
    from tidemark.llm.neardup import drop_near_duplicates

    text = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    near = lambda k: text(k) + " end"
    rows = [(None, text(k)) for k in (0, 0, 1)] + [(None, near(0)), (7, text(1)), (7, near(2)), (7, text(2)), (7, text(3)), (4, near(1))]
    rows += [(None, ""), (None, None), (7, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS _row")
    got = drop_near_duplicates(docs)
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    short = [t for t in kept if not (t[1] or "").strip()]
    assert sorted(short, key=str) == sorted([(None, ""), (None, None), (7, " ")], key=str)
    words = [t for t in kept if (t[1] or "").strip()]
    # One row of each group, of its smallest id.
    assert len(words) == 4 and (4, near(1)) in words and (7, text(3)) in words
    assert sum(t[0] is None for t in words) == 1 and sum(t[1] in (text(2), near(2)) for t in words) == 1
