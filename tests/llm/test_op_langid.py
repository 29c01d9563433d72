from collections import Counter

import pytest
from pyspark.sql import functions as F
from tidemark.llm import langid
from tidemark.llm.langid import drop_unknown, grams, held_out, identify, learn_profiles, op9_language_id, predict, ranked

DOCS = "doc_id long, text string, lang string"
EN = "the cat and the dog were in the house with that other thing and they had then this"
DE = "der hund und die katze waren in dem haus und sie hatten nicht das ding mit ihnen"


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, EN, "en") for i in range(0, 40, 2)] + [(i, DE, "de") for i in range(1, 40, 2)]
    return spark.createDataFrame(rows, DOCS)


def plain_grams(text):
    letters = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())
    padded = f" {letters} "
    count = Counter()
    for n in (1, 2, 3):
        for i in range(len(padded) - n + 1):
            g = padded[i : i + n]
            if g.strip() and not (n == 3 and g[1] == " "):
                count[g] += 1
    return count


def unpacked(code):
    out = ""
    while code:
        out, code = chr(code & 0x1FFFFF) + out, code >> 21
    return out


@pytest.mark.parametrize("text", ["a", "Ab, ab!", EN, DE, "é1ß  x\n\ny", "ÀÉ " * 40, "𝒜bc 漢字"])
def test_profiles_are_those_of_plain_counts(text):
    assert Counter(map(unpacked, grams(text).tolist())) == plain_grams(text)
    code = lambda g: sum(ord(c) << 21 * i for i, c in enumerate(reversed(g)))
    want = sorted(plain_grams(text).items(), key=lambda x: (-x[1], code(x[0])))
    assert [unpacked(c) for c in ranked(text).tolist()] == [g for g, _ in want][: langid.GRAMS]


def test_distance_is_out_of_place(labelled):
    profiles = learn_profiles(labelled)
    assert [p[0] for p in profiles] == ["de", "en"]
    own = ranked("this and that").tolist()
    best = []
    for lang, codes, ranks in profiles:
        place = dict(zip(codes.tolist(), ranks.tolist()))
        best.append((sum(abs(place[g] - i) if g in place else langid.GRAMS for i, g in enumerate(own)), lang))
    off, lang = min(best)
    assert predict("this and that", profiles) == (lang, pytest.approx(1 - off / langid.GRAMS / len(own)))


def test_rows_without_letters_and_odd_labels(spark, labelled):
    odd = [(50, None, "en"), (51, "", "en"), (52, " 12 \n!", "de"), (53, EN, None), (None, DE, "de"), (53, EN, None)]
    docs = labelled.unionByName(spark.createDataFrame(odd, DOCS)).withColumn("score", F.lit("mine"))
    got = identify(docs, learn_profiles(docs)).where("doc_id >= 50 or doc_id is null").collect()
    assert sorted((str(r.doc_id), r.lang_pred) for r in got) == [
        ("50", "und"), ("51", "und"), ("52", "und"), ("53", "en"), ("53", "en"), ("None", "de"),
    ]
    assert all(0 <= r.score <= 1 for r in got)
    kept = drop_unknown(docs.withColumn("lang_pred", F.lit(1)))
    assert kept.columns == [*docs.columns, "lang_pred"]
    assert kept.count() == 40 + 3


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, EN, None)], DOCS)
    assert learn_profiles(docs) == []
    assert [r.lang_pred for r in identify(docs, []).collect()] == ["und"]
    assert identify(docs.limit(0), learn_profiles(docs.limit(0))).collect() == []


def test_labels_of_held_out_rows_teach_nothing(labelled):
    lied = labelled.withColumn("lang", F.when(held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert [p[0] for p in learn_profiles(lied)] == ["de", "en"]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = op9_language_id(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id")
    held = got.where("held_out").select((F.col("lang") == F.col("lang_pred")).alias("right"))
    assert held.agg(F.avg(F.col("right").cast("int"))).first()[0] > 0.98
