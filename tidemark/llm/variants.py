"""Groups of spelling variants: words at one edit from each other, found by pivotal bigrams.

Words are counted over all texts first; only those with enough letters and occurrences go on. Bigrams have
one order, rarest first. A word's prefix is its three first bigrams in that order, with all that are as
rare as the third; of these, dynamic programming picks two that do not overlap and are rarest together:
the pivots. One edit spoils at most one of two disjoint bigrams. So of two words at one edit, the one
whose prefix ends earlier in the order shares a pivot with the other's prefix. Where the pivot can stand
is limited too. The edit is on one side of it, so on the other side it is as far from the word's end as
in the other word, and all letters there are the same. An edit behind the first pivot leaves alone that
one and all before it, any other edit the second pivot and all behind it. Pivots therefore meet prefixes
on equality of (bigram, side, place from that side, checksum of that side, length), for the three lengths
that one edit allows, and the words that meet are verified by their edit distance.

The alphabet bounds the bigrams' order, the only thing that passes through the driver: at most
``MAX_BIGRAMS`` entries. Counts are summed up before they are shuffled, so frequent words and documents
weigh nothing; a bigram that many words share is split by AQE, and pairs are reduced to one row a word
by map-side aggregation. Roots are followed by doubling, each step written down.

A null or empty text has no words. A null id counts as an empty one in the misspelling rule. Rows that
repeat count each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import documents
from tidemark.session import collect_catalog, write_once

#: Fixed value: what a word is made of.
LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: 26 lower-case letters and 64 beyond ASCII, squared.
MAX_BIGRAMS = 90 * 90
MIN_LENGTH, MIN_COUNT = 5, 3
MISSPELT = 97
#: Lengths of the other word, less that of this one, that one edit allows.
SHIFTS = (0, 1, -1)
SPOT = ["gram", "side", "place", "flank", "length"]


def lowered(run: Column) -> Column:
    """A-Z in lower case; few runs have any."""
    return F.when(run.rlike("[A-Z]"), F.translate(run, UPPER, LOWER)).otherwise(run)


def misspelt(run: Column, key: Column) -> Column:
    """The run, with a letter missing in one of ``MISSPELT`` documents, as a checksum of both decides."""
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % MISSPELT == 0, shorter).otherwise(run)


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    runs = F.explode(F.regexp_extract_all(F.col(text), F.lit(LETTERS), F.lit(0)))
    each = docs.select(F.col(key).alias("key"), runs.alias("run")).select("key", lowered(F.col("run")).alias("run"))
    words = each.select(misspelt(F.col("run"), F.col("key")).alias("word")).where(F.length("word") >= MIN_LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT)


def bigram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Bigram -> (place in the order, words' places that hold it), rarest first."""
    places = F.sequence(F.lit(1), F.length("word") - 1)
    each = words.where(F.length("word") > 1).select(
        F.explode(F.transform(places, lambda p: F.substring("word", p, F.lit(2)))).alias("gram")
    )
    held = collect_catalog(each.groupBy("gram").count(), MAX_BIGRAMS)
    ranked = sorted(held, key=lambda r: (r["count"], r.gram))
    return {r.gram: (rank, r["count"]) for rank, r in enumerate(ranked)}


def pivotal(grams: list[tuple[int, int, int]]) -> tuple[int, int]:
    """Places of the two disjoint bigrams that are rarest together.

    ``grams`` are (place, order, frequency) by rising place. ``best`` is the rarest bigram so far that
    ends before the one at hand, so each is tried with its best partner to the left.
    """
    top, pair = None, (-1, -1)
    best, waiting = None, 0
    for place, order, frequency in grams:
        while grams[waiting][0] + 2 <= place:
            left = (grams[waiting][2], grams[waiting][1], grams[waiting][0])
            best = left if best is None else min(best, left)
            waiting += 1
        if best is not None:
            cost = (best[0] + frequency, best[1] + order)
            if top is None or cost < top:
                top, pair = cost, (best[2], place)
    return pair


def prefix_of(word: str, ranks: dict[str, tuple[int, int]]) -> tuple[list[tuple[int, int, int]], int]:
    """The prefix as (place, order, frequency) by rising place, and the order that it ends with."""
    grams = [(p, *ranks[word[p : p + 2]]) for p in range(len(word) - 1)]
    last = sorted(order for _, order, _ in grams)[min(2, len(grams) - 1)]
    return [g for g in grams if g[1] <= last], last


def prefixes(words: DataFrame, ranks: dict[str, tuple[int, int]]) -> DataFrame:
    """The prefix bigrams of every word: ``word, n, gram, place, length, last, pivot``,
    which is 0 for the first pivot, 1 for the second and null for all others."""
    sent = words.sparkSession.sparkContext.broadcast(ranks)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for word, n in zip(b["word"], b["n"]):
                prefix, last = prefix_of(word, sent.value)
                pivots = pivotal(prefix)
                rows += [(word, n, order, place, len(word), last, pivots.index(place) if place in pivots else None) for place, order, _ in prefix]
            out = pd.DataFrame(rows, columns=["word", "n", "gram", "place", "length", "last", "pivot"])
            yield out.astype({"pivot": "Int32"})

    schema = "word string, n long, gram int, place int, length int, last int, pivot int"
    return words.mapInPandas(cut, schema)


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, na, b, nb`` with ``a < b``: all pairs of words (``word, n``) at exactly one edit."""
    grams = write_once(prefixes(words, bigram_order(words)), "bigram-prefixes")
    left, right = F.col("place") + 2, F.col("length") - F.col("place")
    sides = F.array(
        F.struct(F.lit(0).alias("side"), left.alias("at"), F.xxhash64(F.substring("word", F.lit(1), left)).alias("flank")),
        F.struct(F.lit(1).alias("side"), right.alias("at"), F.xxhash64(F.substring("word", F.col("place") + 1, right)).alias("flank")),
    )
    flanked = grams.select("word", "n", "gram", "length", "last", "pivot", F.inline(sides)).withColumnRenamed("at", "place")
    lengths = F.explode(F.array(*[F.col("length") + d for d in SHIFTS]))
    asked = flanked.where("pivot = side").select(
        "gram", "side", "place", "flank", lengths.alias("length"),
        F.col("word").alias("a"), F.col("n").alias("na"), F.col("last").alias("last_a"),
    )
    held = flanked.select(*SPOT, F.col("word").alias("b"), F.col("n").alias("nb"), "last")
    met = asked.join(held, SPOT).where("last_a <= last and a <> b")
    met = met.where(F.levenshtein("a", "b", 1) == 1)
    first = F.col("a") < F.col("b")
    pair = [
        F.when(first, F.col(x)).otherwise(F.col(y)).alias(c)
        for c, x, y in (("a", "a", "b"), ("na", "na", "nb"), ("b", "b", "a"), ("nb", "nb", "na"))
    ]
    return met.select(*pair).distinct()


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """Every word with ``form``, its most frequent near word if that is at least twice as frequent,
    ``form_n`` and ``n_near``."""
    ends = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("near_n")),
    )
    each = pairs.select(F.inline(ends))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = each.groupBy("word").agg(best.alias("best"), F.count(F.lit(1)).alias("n_near"))
    takes = -F.col("best.less") >= 2 * F.col("n")
    return words.join(near, "word", "left").select(
        "word",
        "n",
        F.when(takes, F.col("best.near")).alias("form"),
        F.when(takes, -F.col("best.less")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
    )


def roots(links: DataFrame) -> DataFrame:
    """``word, root``: where the links (``word, form``, no cycles) lead in the end."""
    now = write_once(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if now.join(on, "root", "left_semi").isEmpty():
            return now
        further = now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        now = write_once(further, "roots")


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word: see :func:`forms` and :func:`roots`."""
    words = write_once(word_counts(docs, key, text), "words")
    found = write_once(forms(words, near_pairs(words)), "forms")
    ends = roots(found.where("form is not null"))
    root = F.coalesce("root", "word").alias("root")
    return found.join(ends, "word", "left").select("word", "form", root, "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(documents(spark, folder))


#: The same over deletions: words at one edit share what is left when one letter is taken out.
OP13_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                          b) ORDER BY b) AS t
  FROM (SELECT unnest(range(256)) AS b)
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), kinds AS (
  SELECT doc_id, run, count(*) AS c FROM runs GROUP BY ALL
), bytes AS (
  SELECT *, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
                   ELSE [192 + (unicode(x) >> 6)::BIGINT, 128 + (unicode(x) & 63)::BIGINT] END)) AS b
  FROM kinds
), hashed AS (
  SELECT run, c, xor(list_reduce(b, lambda h, x: xor(h >> 8, t[xor(h, x) % 256 + 1]), 4294967295::BIGINT),
                     4294967295::BIGINT) AS h
  FROM bytes, crc
), spelt AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, c
  FROM hashed
), words AS (
  SELECT word, sum(c)::BIGINT AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3
), cuts AS (
  SELECT word, n, i, word[:i] || word[i + 2:] AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.rest = w.word
), best AS (
  SELECT word, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n, count(*) AS n_near
  FROM near GROUP BY word
), formed AS (
  SELECT word, n, CASE WHEN other_n >= 2 * n THEN other END AS form,
         CASE WHEN other_n >= 2 * n THEN other_n END AS form_n, coalesce(n_near, 0) AS n_near
  FROM words LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS here, 0 AS steps FROM formed
  UNION ALL SELECT c.word, f.form, steps + 1 FROM chain c JOIN formed f ON c.here = f.word WHERE f.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n
FROM formed JOIN (SELECT word, arg_max(here, steps) AS root FROM chain GROUP BY word) USING (word)
"""
