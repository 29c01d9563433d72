import re
from collections import Counter

import llm_brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from tidemark.llm import mixing
from tidemark.llm.mixing import WORD, deal_slots, mix, mixed_documents, op2_source_mix, permuted, sized_rows

DOCS = "doc_id long, text string, source string"


def text(n, word="w"):
    return " ".join(f"{word}{i}" for i in range(n))


ROWS = [
    (1, text(700), "b"),
    (2, text(3), "b"),
    (3, text(10), "a"),
    (4, None, "a"),
    (5, " \n", "c"),
    (6, text(2000), None),
    (7, text(300), "é"),
    (8, text(1), "z"),
    (8, text(1), "z"),
    (8, text(9), "z"),
    (None, text(40), "z"),
    (None, None, None),
    (9, text(5000), "b"),
]


def sums(spark, rows, **options):
    base = sized_rows(spark.createDataFrame(rows, DOCS))
    sources, drawn = mix(base, **options)
    names = {r.sid: r.source for r in sources.collect()}
    return base, sources.collect(), [(names[r.sid], r) for r in drawn.collect()]


@pytest.mark.parametrize("block", [1, 7, 256])
def test_sources_get_their_targets(spark, block):
    base, sources, drawn = sums(spark, ROWS, block=block)
    size = Counter()
    for d, t, s in ROWS:
        size[s] += len(re.findall(WORD, t or ""))
    want = llm_brute.targets(dict(size))
    assert {r.source: pytest.approx(r.target) for r in sources} == want
    taken = Counter()
    for source, r in drawn:
        taken[source] += r.words
    assert all(taken[s] == int(want[s] + 0.5) for s in want)
    sizes = {r.rid: r["size"] for r in base.collect()}
    by_doc = Counter()
    for _, r in drawn:
        by_doc[r.rid] += r.words
    assert all(by_doc[d] <= 3 * n for d, n in sizes.items())


def test_slots_have_no_gaps_and_blocks_come_in_turn(spark):
    _, sources, drawn = sums(spark, ROWS, block=7, n_shards=4)
    slots, passes = {}, {}
    for source, r in drawn:
        slots.setdefault(r.shard, {}).setdefault(r.slot, set()).add((source, r.block, r.epoch))
        passes.setdefault((source, r.block), set()).add(r.epoch)
    # Every slot of a shard is filled, by one block; shards are of one length.
    assert all(set(s) == set(range(len(s))) for s in slots.values())
    assert all(len(b) == 1 for s in slots.values() for b in s.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(p == set(range(len(p))) for p in passes.values())
    assert set(slots) == {0, 1, 2, 3}
    # Sources are mixed within a shard, not one after the other.
    big = [min(s[n])[0] or "" for s in slots.values() for n in range(len(s))]
    assert sum(x != y for x, y in zip(big, big[1:])) > 100


def test_shards_draw_their_sources():
    slots = np.array([0, 1, 7, 1000, 300_000, 10**12])
    dealt = deal_slots(slots, 16, 1)
    assert (dealt >= 0).all() and (dealt.sum(axis=1) == slots).all()
    lengths = dealt.sum(axis=0)
    assert lengths.max() - lengths.min() <= 1
    # Counts vary as draws do: about the mean, but not equal to it.
    counts, mean = dealt[4], 300_000 / 16
    assert len(set(counts)) > 8 and (abs(counts - mean) < 12 * mean**0.5).all()
    assert (deal_slots(slots, 16, 2) != dealt).any() and (deal_slots(slots, 16, 1) == dealt).all()
    assert deal_slots(np.array([], np.int64), 4, 1).shape == (0, 4)
    assert deal_slots(np.array([5]), 16, 1).sum() == 5


def test_the_draw_decides_which_shard_holds_a_word(spark, monkeypatch):
    def at_home(slots, n_shards, seed):
        dealt = np.zeros((len(slots), n_shards), np.int64)
        dealt[:, 0] = slots
        return dealt

    def held():
        return {(s, r.rid, r.shard) for s, r in sums(spark, ROWS, block=7, n_shards=4)[2]}

    drawn = held()
    monkeypatch.setattr(mixing, "deal_slots", at_home)
    assert {k[2] for k in held()} == {0} and {k[2] for k in drawn} == {0, 1, 2, 3}


def test_too_many_sources_are_refused(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 3)
    with pytest.raises(Exception, match="more than 3 sources"):
        sums(spark, ROWS)


def test_reruns_agree_whatever_the_partitions(spark, tmp_path):
    df = spark.createDataFrame(ROWS, DOCS)
    answers = []
    for n in (1, 5):
        path = str(tmp_path / f"run{n}")
        df.repartition(n).write.parquet(f"{path}/documents.parquet")
        answers.append(sorted((tuple(r) for r in op2_source_mix(spark, path).collect()), key=str))
    assert all(bool(a[-1]) == (a[-2] > 0) for a in answers[0])
    assert answers[0] == answers[1] and len(answers[0]) == len(ROWS)


def test_mixed_documents_hold_the_words_taken(spark):
    df = spark.createDataFrame(ROWS, DOCS).withColumns({"rid": F.lit("mine"), "n_chars": F.lit(0).cast("long")})
    got = mixed_documents(df, block=7)
    assert got.columns == df.columns
    rows = got.collect()
    want = llm_brute.targets({"a": 10, "b": 5703, "c": 0, "z": 51, "é": 300, None: 2000})
    taken = Counter()
    for r in rows:
        taken[r.source] += len(re.findall(WORD, r.text))
        assert r.n_chars == len(r.text) and r.rid == "mine"
    assert all(taken[s] == int(want[s] + 0.5) for s in want)
    whole = {t for _, t, _ in ROWS}
    assert any(r.text in whole for r in rows)


def test_empty_tables(spark):
    assert mixed_documents(spark.createDataFrame([], DOCS)).collect() == []
    assert mixed_documents(spark.createDataFrame([(1, None, None), (2, "", "a")], DOCS)).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 4097])
def test_permutations_are_whole_and_go_back(n):
    there = permuted(np.arange(n), n, 99)
    assert sorted(there) == list(range(n))
    assert (permuted(there, n, 99, inverse=True) == np.arange(n)).all()
