"""Near-duplicates by MinHash with tensored banding; every link is confirmed on full sets.

A document's set is that of its distinct five-word shingles. Documents with equal sets are one class
and go on as its smallest id. Each class has two small collections of half keys, ``HALVES`` of
``WIDTH`` minhashes each; a table key is a pair of one half from either side. So
``2 * HALVES * WIDTH`` minhashes fill ``HALVES ** 2`` tables with keys of ``2 * WIDTH`` minhashes: a
pair at 0.75 shares a table with probability 0.9999. A class whose half meets no other's
there is in no table of that half, so table keys are formed of the halves that meet only, and most
documents form none.

Classes that share a bucket are candidates. All pairs of a bucket are never formed. In rounds, every
class is compared with one class of its buckets that is not known to be in its component: the one
that meets most others, which in a group of edited copies is the one next to the original; in a
second round, the next such one. What is confirmed joins components, so groups of copies collapse.
Buckets that still hold several components are finished exactly: their classes are joined on the
rarest quarter of their shingles, one of which two sets of similarity 0.75 must share, restricted to
pairs of different components whose sizes, places of the shingle, numbers of shingles that anyone
else has, and bitmaps of hashed shingles allow that similarity.
Each such pair is confirmed or refuted on full sets. No bucket, partner or candidate is cut off.

``component_id`` is the smallest id reachable by links. A document without words or with null text
has no set and is linked with nothing. Rows that repeat an id are one document. A row with a null id
is linked with nothing, has a null component and is kept. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.llm.shingles import shingles, spread
from tidemark.llm.tables import documents
from tidemark.session import write_once, write_result

HALVES, WIDTH = 12, 2
#: The least similarity, as a fraction of whole numbers.
NUM, DEN = 3, 4
ROUNDS = 2
#: Longs of a set's bitmap.
BITS = 16

_N = 2 * HALVES * WIDTH
MULTIPLY = spread(np.arange(1, _N + 1, dtype=np.uint64)) | np.uint64(1)
ADD = spread(np.arange(1001, 1001 + _N, dtype=np.uint64))


def minhashes(hashes: np.ndarray) -> np.ndarray:
    out = np.full(_N, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(0, len(hashes), 4096):
            part = hashes[k : k + 4096, None] * MULTIPLY + ADD
            out = np.minimum(out, part.min(axis=0))
    return out


def half_keys(hashes: np.ndarray) -> np.ndarray:
    """The half keys of both sides, each told apart by its place."""
    m = minhashes(hashes).reshape(2 * HALVES, WIDTH)
    with np.errstate(over="ignore"):
        key = np.arange(1, 2 * HALVES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(WIDTH):
            key = spread(key + m[:, k])
    return key.view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n, f1, f2, halves``: the size of each set, a 128-bit print of it, its half keys."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text in b["text"]:
                h = shingles(text)
                with np.errstate(over="ignore"):
                    f1 = spread(h).sum(dtype=np.uint64).view(np.int64)
                    f2 = np.bitwise_xor.reduce(spread(h + np.uint64(7)), initial=np.uint64(0)).view(np.int64)
                rows.append((len(h), f1, f2, half_keys(h) if len(h) else []))
            out = pd.DataFrame(rows, columns=["n", "f1", "f2", "halves"])
            yield out.assign(doc_id=b["doc_id"].astype("Int64").array)

    return docs.select("doc_id", "text").mapInPandas(
        sign, "n long, f1 long, f2 long, halves array<long>, doc_id long"
    )


def _met(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key another row has too."""
    often = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)
    return rows.join(often, key, "left_semi")


def buckets_of(classes: DataFrame) -> DataFrame:
    """``key, cid``: every bucket of the tables that holds more than one class."""
    halves = classes.select("cid", F.posexplode("halves").alias("at", "half"))
    met = _met(halves, "half").groupBy("cid").agg(F.collect_list(F.struct("at", "half")).alias("met"))
    left = F.filter("met", lambda x: x["at"] < HALVES)
    right = F.filter("met", lambda x: x["at"] >= HALVES)
    paired = met.select("cid", F.explode(left).alias("l"), right.alias("rights"))
    paired = paired.select("cid", "l", F.explode("rights").alias("r"))
    keys = paired.select(F.xxhash64("l.half", "r.half").alias("key"), "cid")
    return write_once(_met(write_once(keys, "table-keys"), "key"), "buckets")


def bitmap(hashes: np.ndarray) -> np.ndarray:
    bits = np.zeros(64 * BITS, bool)
    bits[(hashes % np.uint64(64 * BITS)).astype(np.int64)] = True
    return np.packbits(bits).view(np.int64)


def class_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``cid, tokens, bits``: the sorted shingle hashes of the classes' smallest documents."""
    wanted = classes.select(F.col("cid").alias("doc_id"), "f1")
    texts = docs.select("doc_id", "text").join(wanted, "doc_id")

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [shingles(t) for t in b["text"]]
            with np.errstate(over="ignore"):
                own = [int(spread(s).sum(dtype=np.uint64).view(np.int64)) for s in sets]
            out = pd.DataFrame({"cid": b["doc_id"], "tokens": [s.view(np.int64) for s in sets]})
            out["bits"] = [bitmap(s) for s in sets]
            yield out[np.array(own) == b["f1"].to_numpy()]

    # An id that repeats may come with several texts, and one text in several rows.
    hashed_rows = texts.mapInPandas(hashed, "cid long, tokens array<long>, bits array<long>")
    return write_once(hashed_rows.dropDuplicates(["cid"]), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets reach the similarity."""
    left = sets.select(F.col("cid").alias("a"), F.col("tokens").alias("tokens_a"))
    right = sets.select(F.col("cid").alias("b"), F.col("tokens").alias("tokens_b"))
    met = pairs.join(left, "a").join(right, "b")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            good = []
            for x, y in zip(b["tokens_a"], b["tokens_b"]):
                both = np.intersect1d(x, y, assume_unique=True).size
                good.append(DEN * both >= NUM * (len(x) + len(y) - both))
            yield b.loc[good, ["a", "b"]]

    return met.mapInPandas(compare, "a long, b long")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    named = labels.withColumnRenamed("node", "cid")
    return rows.join(named, "cid", "left").withColumn("label", F.coalesce("label", "cid"))


def _mixed(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Bucket rows with their labels, of buckets that hold several components."""
    rows = _labelled(buckets, labels)
    ends = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    return rows.join(ends.where("lo <> hi").select("key"), "key", "left_semi")


def _round(buckets: DataFrame, ranks: DataFrame, labels: DataFrame) -> DataFrame:
    """One partner of another component for each class of a mixed bucket: the highest in rank."""
    rows = write_once(_mixed(buckets, labels).join(ranks, "cid"), "mixed")
    tops = rows.groupBy("key").agg(F.max(F.struct("rank", "cid", "label")).alias("top"))
    aim = rows.join(tops, "key").where("label <> top.label")
    best = aim.groupBy("cid").agg(F.max("top").alias("top"))
    return best.select(F.col("cid").alias("a"), F.col("top.cid").alias("b"))


def _rest(buckets: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Every pair of mixed buckets' classes, of different components, that may be similar enough.

    With overlap o and sizes n, m, the similarity asks for ``o * (DEN + NUM) >= NUM * (n + m)``; o is at
    most the number of shingles that another of these classes has too, at most n less the bits that the
    other bitmap lacks, and, if a shingle is the first that both have, at most what follows it in either.
    In the order of frequency here, rarest first, two similar sets share a shingle of their first n - ceil(n * NUM / DEN) + 1.
    """
    mixed = write_once(_mixed(buckets, labels).select("cid", "label").distinct(), "rest")
    size = mixed.groupBy("label").agg(F.count(F.lit(1)).alias("label_n"))
    mixed = mixed.join(size, "label").withColumn("rank", F.struct("label_n", "label"))
    sets = sets.join(mixed.select("cid"), "cid", "left_semi")
    tokens = sets.select("cid", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    known = tokens.join(often, "token").groupBy("cid", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("known")
    )
    own = F.size("known")
    prefix = F.col("n") - F.ceil(F.col("n") * NUM / DEN) + 1 - (F.col("n") - own)
    known = known.withColumn("c", own).withColumn("prefix", prefix.cast("int")).where("prefix > 0")
    first = F.posexplode(F.slice("known", F.lit(1), F.col("prefix"))).alias("at", "x")
    rows = known.select("cid", "n", "c", first)
    rows = rows.select("cid", "n", "c", F.col("x.token").alias("token"), (F.col("c") - F.col("at")).alias("rest"))
    rows = rows.join(mixed.select("cid", "rank"), "cid").join(sets.select("cid", "bits"), "cid")
    rows = write_once(rows, "prefixes")
    # A pair is formed from its lower component, so the highest one of a shingle forms none, and
    # neither does a class that is too much its own for even the shortest set there.
    tops = rows.groupBy("token").agg(
        F.max("rank").alias("top"), F.min("rank").alias("low"), F.min("n").alias("least")
    )
    tops = tops.where("low < top")
    may = (DEN + NUM) * F.col("rest") >= NUM * (F.col("n") + F.greatest("least", F.col("n") * NUM / DEN))
    first = rows.join(tops, "token").where("rank < top").where(may)
    a, b = first.alias("a"), rows.alias("b")

    def enough(most: Column) -> Column:
        return most * (DEN + NUM) >= (F.col("a.n") + F.col("b.n")) * NUM

    def lacks(x: str, y: str) -> Column:
        """Bits of one that the other has not."""
        own = [F.bit_count(F.col(f"{x}.bits")[i].bitwiseAND(F.bitwise_not(F.col(f"{y}.bits")[i]))) for i in range(BITS)]
        return reduce(Column.__add__, own)

    shared = enough(F.least("a.rest", "b.rest")) & enough(F.col("a.n") - lacks("a", "b"))
    shared = shared & enough(F.col("b.n") - lacks("b", "a"))
    near = (F.col("a.n") * DEN >= F.col("b.n") * NUM) & (F.col("b.n") * DEN >= F.col("a.n") * NUM)
    met = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.rank") < F.col("b.rank")) & shared & near)
    return met.select(F.col("a.cid").alias("a"), F.col("b.cid").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``doc_id, text``."""
    spark = docs.sparkSession
    signed = write_once(signatures(docs), "signatures")
    usable = signed.where("n > 0 and doc_id is not null")
    grouped = usable.groupBy("n", "f1", "f2").agg(F.min(F.struct("doc_id", "halves")).alias("_least"))
    classes = write_once(
        grouped.select(F.col("_least.doc_id").alias("cid"), "n", "f1", "f2", "_least.halves"), "classes"
    )
    named = usable.join(classes.select("cid", "n", "f1", "f2"), ["n", "f1", "f2"])
    named = write_once(named.select("doc_id", "n", "cid"), "class-members")

    # An id that repeats with different texts ties their classes together.
    several = named.groupBy("doc_id").agg(F.min("cid").alias("a"), F.max("cid").alias("_b"))
    tied = named.join(several.where("a <> _b"), "doc_id").select("a", F.col("cid").alias("b"))
    links = write_once(tied.where("a <> b").distinct(), "links")
    labels = components(links)

    buckets = buckets_of(classes)
    met = buckets.select("cid").distinct()
    sets = class_sets(docs, classes.join(met, "cid", "left_semi"))
    counted = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    degree = buckets.join(counted, "key").groupBy("cid").agg(F.sum("_n").alias("rank"))
    degree = write_once(degree, "degrees")
    for turn in range(ROUNDS + 1):
        pairs = _round(buckets, degree, labels) if turn < ROUNDS else _rest(buckets, sets, labels)
        pairs = write_once(pairs, "candidates")
        # Whom others were compared with comes last in the next round.
        used = pairs.select(F.col("b").alias("cid"), F.lit(0).alias("_used")).distinct()
        degree = degree.join(used, "cid", "left").select("cid", F.coalesce("_used", "rank").alias("rank"))
        found = write_once(confirmed(pairs, sets), "links")
        links = links.union(found)
        labels = components(links)

    whole = _labelled(named, labels).select("doc_id", "n", "label")
    alone = signed.where("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("label"))
    # A class's own id may sit in a component with a smaller one through another row's text.
    return whole.union(alone).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("label").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("label"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of every component of near-duplicate rows: of the smallest id, null last, the first.

    Rows are judged by a number of their own, so those without id, or with one that repeats, are near
    copies like any others; rows without words stay.
    """
    row = "_row"
    while row in map(str.lower, docs.columns):
        row += "_"
    # Written with its numbers, which would differ if the rows were read anew.
    numbered = write_once(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")

    def judged() -> DataFrame:
        rows = near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"))
        return rows.where("n_shingles > 0").select(F.col("doc_id").alias(row), "component_id")

    # Signatures, buckets and sets outweigh the documents: they go before the next stage writes.
    found = write_result(docs.sparkSession, judged, "near-rows")
    ids = numbered.select(row, F.col("doc_id").alias("_id")).join(found, row)
    first = F.min(F.struct(F.col("_id").isNull(), "_id", row)).getField(row).alias(row)
    # Only the rows that go are joined back: few of a large table.
    kept = ids.groupBy("component_id").agg(first).select(row)
    lost = found.select(row).join(kept, row, "left_anti")
    return numbered.join(lost, row, "left_anti").drop(row)


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(documents(spark, folder))
