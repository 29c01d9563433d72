"""Language identification by rank-order profiles.

A profile is the ``GRAMS`` most frequent letter n-grams (1 to 3 letters, with the gaps between words
as a letter at either end) in order of frequency, ties by code. A document is as far from a language
as the sum of how many places each n-gram of its own profile is out of place in the language's;
absent ones count ``GRAMS``. The nearest language is predicted, the first by name if several are
as near. ``score`` is 1 minus that distance over the largest possible one.

Profiles are learned from a bounded sample of labelled rows: about ``sample_rows`` of each language,
drawn by a hash of id and text. Whole texts count, in learning and in prediction. Predictions see the text
alone. What the driver holds is ``GRAMS`` codes for each language; languages are a catalog.

A text that is null, empty or without a letter is ``und`` with score 0, and so is every text when
nothing was learned. Rows without label or text teach nothing; a null id counts as an empty id text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import documents
from tidemark.session import collect_catalog

GRAMS = 300
SAMPLE_ROWS = 2_000
#: A catalog with more languages is refused.
MAX_LANGUAGES = 10_000
GAP = 0x20
UNKNOWN = "und"
#: Below this a pipeline takes a text for no language that it knows.
MIN_SCORE = 0.05

Profiles = list[tuple[str, np.ndarray, np.ndarray]]


#: For every code point met so far: itself if it is a letter, else a gap. One table per task.
_LETTERS = {"table": np.empty(0, np.int64)}


def letters(points: np.ndarray) -> np.ndarray:
    table, top = _LETTERS["table"], int(points.max(initial=0)) + 1
    if top > len(table):
        more = range(len(table), max(top, 0x250))
        new = np.fromiter((p if chr(p).isalpha() else GAP for p in more), np.int64, len(more))
        table = _LETTERS["table"] = np.concatenate((table, new))
    return table[points]


def grams(text: str) -> np.ndarray:
    """Codes of all n-grams of a text, repeats included: 21 bits for each letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    a = letters(np.concatenate(([GAP], points, [GAP])).astype(np.int64))
    keep = np.ones(len(a), bool)
    keep[1:] = (a[1:] != GAP) | (a[:-1] != GAP)
    a = a[keep]
    one = a[a != GAP]
    two = (a[:-1] << 21) | a[1:]
    three = ((a[:-2] << 42) | (a[1:-1] << 21) | a[2:])[a[1:-1] != GAP] if len(a) > 2 else a[:0]
    return np.concatenate((one, two[two != (GAP << 21 | GAP)], three)) if len(one) else a[:0]


def ranked(text: str) -> np.ndarray:
    """The text's profile: its most frequent n-grams in order."""
    codes, counts = np.unique(grams(text), return_counts=True)
    if len(codes) > GRAMS:
        # All codes that may be among the first; ties at the edge stay in for the order below.
        edge = np.partition(counts, len(counts) - GRAMS)[len(counts) - GRAMS]
        codes, counts = codes[counts >= edge], counts[counts >= edge]
    return codes[np.lexsort((codes, -counts))][:GRAMS]


def predict(text: str | None, profiles: Profiles) -> tuple[str, float]:
    own = ranked(text) if text else np.empty(0, np.int64)
    if not len(own) or not profiles:
        return UNKNOWN, 0.0
    place = np.arange(len(own))
    best = None
    for lang, codes, ranks in profiles:
        at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
        off = np.where(codes[at] == own, np.abs(ranks[at] - place), GRAMS).sum()
        if best is None or off < best[0]:
            best = off, lang
    return best[1], float(1 - best[0] / (GRAMS * len(own)))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3 == 1


def learn_profiles(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Profiles:
    """Profiles from labelled rows of ``doc_id, text, lang`` that are not held out."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    labelled = labelled.select("doc_id", "text", "lang")
    n = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    n = docs.sparkSession.createDataFrame(collect_catalog(n, MAX_LANGUAGES), "lang string, _n long")
    draw = F.pmod(F.xxhash64(F.lit(9), "doc_id", "text"), F.lit(1_000_000)) * F.col("_n")
    # At most MAX_LANGUAGES rows, checked; texts stay where they are.
    sample = labelled.join(F.broadcast(n), "lang").where(draw < sample_rows * 1_000_000)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, texts in b.groupby("lang")["text"]:
                codes, counts = np.unique(np.concatenate([grams(t) for t in texts]), return_counts=True)
                yield pd.DataFrame({"lang": lang, "code": codes, "n": counts})

    counted = sample.select("lang", "text").mapInPandas(count, "lang string, code long, n long")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    best = (
        counted.groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
        .withColumn("at", F.row_number().over(order) - 1)
        .where(F.col("at") < GRAMS)
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("code", "at"))).alias("grams"))
    )
    return [
        (r.lang, np.array([g.code for g in r.grams]), np.array([g.at for g in r.grams]))
        for r in sorted(collect_catalog(best, MAX_LANGUAGES), key=lambda r: r.lang)
    ]


def language(profiles: Profiles) -> Callable[[Column], Column]:
    """``struct<lang_pred, score>`` of a text column."""

    @F.pandas_udf("lang_pred string, score double")
    def told(texts: pd.Series) -> pd.DataFrame:
        found = [predict(t, profiles) for t in texts]
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    return told


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """Every row with ``lang_pred`` and ``score``; columns of those names are replaced."""
    kept = docs.drop("lang_pred", "score")
    told = kept.select(
        F.struct(*[kept[c] for c in kept.columns]).alias("_row"),
        language(profiles)(F.col("text")).alias("_told"),
    )
    return told.select("_row.*", "_told.*")


def drop_unknown(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text has a language, by profiles learned from them.

    Where no row has a label to learn from, every text with a letter stays.
    """
    profiles = learn_profiles(docs)
    if not profiles:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told = language(profiles)(F.col("text"))
    return docs.where((told["lang_pred"] != UNKNOWN) & (told["score"] >= min_score))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    profiles = learn_profiles(docs)
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    return identify(rows, profiles).select("doc_id", "held_out", "lang_pred", "score")
