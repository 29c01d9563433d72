"""Spelling variants by pivotal bigrams, against comparing all words with all."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from tidemark.llm.variants import near_pairs, pivotal, roots, spelling_variants

SCHEMA = "doc_id long, text string, word string"


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


def plain(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "a" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    best = {w: min(o, key=lambda x: (-words[x], x)) for w, o in near.items() if o}
    form = {w: b for w, b in best.items() if words[b] >= 2 * words[w]}
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return out


def invented(seed, words=150, letters="abcé"):
    rng = random.Random(seed)
    stems = ["".join(rng.choices(letters, k=rng.randint(4, 9))) for _ in range(words)]

    def spelt():
        w = rng.choice(stems[: rng.randint(1, words)])
        at = rng.randrange(len(w))
        return rng.choice([w, w, w, w.upper(), w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + "b" + w[at + 1 :]])

    return [(d, rng.choice([" ", ", ", "×÷ ", "\n1"]).join(spelt() for _ in range(60))) for d in range(80)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_pairs(spark, seed):
    rows = invented(seed)
    got = spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"))
    got = got.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert {tuple(r) for r in got} == plain(rows) and len(got) == len(plain(rows))


def test_pairs_of_few_letters(spark):
    """Words of one repeated bigram, where every bigram is as rare as the third."""
    words = [c * n for c in "ab" for n in range(5, 30)] + ["ab" * n + x for n in range(3, 9) for x in ("", "a", "b", "ba")]
    words = sorted({*words, "a" * 7 + "b", "b" + "a" * 7, "a" * 400, "a" * 399 + "b", "a" * 401})
    got = near_pairs(spark.createDataFrame([(w, 3) for w in words], "word string, n long")).collect()
    want = {(a, b) for a, b in itertools.combinations(words, 2) if one_edit(a, b)}
    assert {(r.a, r.b) for r in got} == want and len(got) == len(want)


def test_pivots_are_the_rarest_disjoint_pair():
    rng = random.Random(9)
    for _ in range(300):
        places = sorted(rng.sample(range(12), rng.randint(3, 8)))
        grams = [(p, rng.randrange(50), rng.randrange(20)) for p in places]
        cost = {(a[0], b[0]): a[2] + b[2] for a, b in itertools.combinations(grams, 2) if b[0] - a[0] >= 2}
        assert cost[pivotal(grams)] == min(cost.values())


def test_long_chains_reach_their_root(spark):
    links = [(f"w{i:03}", f"w{i + 1:03}") for i in range(37)] + [("x", "w005")]
    got = roots(spark.createDataFrame(links, "word string, form string")).collect()
    assert {r.root for r in got} == {"w037"} and len(got) == 38


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "spelling spelling Spelling"), (4, "speling " * 7), (4, "speling " * 7), (5, "four ÀÉÎÕÜ àéîõü 1234"), (6, "q" * 30_000)] * 3
    docs = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    got = spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert {tuple(r) for r in got} == plain(rows) and len(got) == len(plain(rows))
    assert spelling_variants(docs.limit(0)).count() == 0
    assert spelling_variants(docs.where("doc_id < 3")).count() == 0


def test_a_word_that_holds_most_of_the_text(spark):
    rows = [(d, "letter " * 500 + "lettér leter lettre") for d in range(60)]
    got = spelling_variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == plain(rows)
