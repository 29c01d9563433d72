"""Approximate nearest neighbours by cross-polytope hashing.

A table hashes a vector, scaled to length 1, by pseudo-rotations (three rounds of random signs and a
fast Hadamard transform, over the next power of two), each to the signed axis nearest to it; the axes of all
its rotations together name the vector's bucket. A dimension has as many rotations as keep a bucket near
``BLOCK`` vectors, three at most, whatever the number of vectors. A query looks into those ``PROBES`` buckets
of each table whose axes, summed over the rotations, are least farther away than the nearest; all vectors
there are candidates, and candidates are ranked exactly: by inner product in double precision on the
original vectors, ties to the smaller id.

Buckets see directions only, but a long vector can score high from afar. So the longest vectors of
each dimension are candidates of every query: about ``sqrt(n * BLOCK) / 4`` of n. A query that meets fewer
than ``CROWD * top`` others is compared with all; that takes in tables of few vectors, and no more than the
queries whose buckets are almost empty.

Buckets are cut into blocks of about ``BLOCK`` vectors and ``BLOCK`` queries, counted before, so a
bucket that a common vector fills is spread over tasks; a block is one matrix product and gives the
best ``top`` of each of its queries, which is all that the best of the union need.

Vectors that are null, empty or zero or hold a null, an infinity or a NaN take no part, and neither
do rows without id. Vectors of another length are never candidates of each other. Rows that repeat an
id count with their best score; a query never finds its own id. Only a query with fewer than ``top``
others of its dimension returns fewer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import table
from tidemark.session import write_once

TABLES = 10
#: By number of rotations.
PROBES = (12, 200, 3200)
BLOCK = 2048
TOP = 20
QUERY_STEP = 20
#: Candidates that a query must have met, in multiples of ``top``.
CROWD = 4
#: Rows that are hashed at a time.
HASHED = 256
SPOT = ["dim", "tab", "axis", "vb", "qb"]
#: Shares of the longest vectors, as powers of 1/2, of which one is chosen.
SHARES = 40
#: Numbers of the tables that hold the longest vectors and all vectors.
LONGEST, ALL = -1, -2


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of every row, of a power of two of columns."""
    rows, n = x.shape
    step = 1
    while step < n:
        pairs = x.reshape(rows, -1, 2, step)
        x = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), 2).reshape(rows, n)
        step *= 2
    return x / np.sqrt(n)


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    wide = 1 << max(1, (x.shape[1] - 1).bit_length())
    x = np.pad(x / np.linalg.norm(x, axis=1, keepdims=True), ((0, 0), (0, wide - x.shape[1])))
    signs = np.random.Generator(np.random.Philox(seed)).choice([-1.0, 1.0], (3, wide))
    for sign in signs:
        x = hadamard(x * sign)
    return x


def nearest_axes(x: np.ndarray, seed: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Signed axes next to each row, nearest first, and how much farther than the first each is: axis a is
    2a, its opposite 2a + 1."""
    y = rotated(x, seed)
    near = np.stack((-y, y), 2).reshape(len(y), -1)
    axes = np.argsort(near, axis=1, kind="stable")[:, :probes]
    apart = np.take_along_axis(near, axes, 1)
    return axes, apart - apart[:, :1]


def buckets(x: np.ndarray, table: int, rotations: int, probes: int) -> np.ndarray:
    """The buckets of a table to look into for each row, the row's own first."""
    codes = gaps = None
    for r in range(rotations):
        axes, apart = nearest_axes(x, table * len(PROBES) + r + 1, probes)
        if codes is None:
            codes, gaps = axes, apart
            continue
        size = 2 << max(1, (x.shape[1] - 1).bit_length())
        codes = (codes[:, :, None] * size + axes[:, None, :]).reshape(len(x), -1)
        gaps = (gaps[:, :, None] + apart[:, None, :]).reshape(len(x), -1)
        order = np.argsort(gaps, axis=1, kind="stable")[:, :probes]
        codes, gaps = np.take_along_axis(codes, order, 1), np.take_along_axis(gaps, order, 1)
    return codes


def hashed(vectors: DataFrame, tables: int, probes: tuple[int, ...]) -> DataFrame:
    """``id, vector`` once for each table and probed bucket, with ``dim, tab, axis``; rows carry ``rotations``."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for (dim, rotations), part in b.groupby([b["vector"].map(len), "rotations"]):
                x = np.stack(part["vector"].to_numpy()).astype(np.float64)
                for t in range(tables):
                    # A few rows at a time: all their probes are held at once.
                    for start in range(0, len(x), HASHED):
                        codes = buckets(x[start : start + HASHED], t, rotations, probes[rotations - 1])
                        rows = start + np.repeat(np.arange(len(codes)), codes.shape[1])
                        out = part.iloc[rows].assign(dim=dim, tab=t, axis=codes.ravel())
                        yield out[["id", "vector", "dim", "tab", "axis"]]

    schema = "id long, vector array<float>, dim int, tab int, axis long"
    return vectors.select("id", "vector", "rotations").mapInPandas(spread, schema)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    v = F.col("vector")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("vector"))
    return rows.where(F.col("id").isNotNull() & v.isNotNull() & fine & F.exists(v, lambda x: x != 0))


def best_of_block(queries: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, top: int) -> pd.DataFrame:
    """The ``top`` nearest of a block for each query, scores added up in one fixed order."""
    rough = q @ x.T
    found = []
    for n, query in enumerate(queries):
        others = np.flatnonzero(ids != query)
        if not len(others):
            continue
        near = rough[n, others]
        if len(others) > top:
            edge = np.partition(near, len(near) - top)[len(near) - top]
            # What rounding might have put below the edge is weighed exactly as well.
            others = others[near >= edge - 1e-9 * max(1.0, np.abs(near).max())]
        score = (x[others] * q[n]).sum(axis=1)
        order = np.lexsort((ids[others], -score))[:top]
        found.append((np.full(len(order), query), ids[others][order], score[order]))
    cols = [np.concatenate(c) for c in zip(*found)] if found else [[], [], []]
    return pd.DataFrame(dict(zip(["query_id", "vec_id", "score"], cols)))


def sized(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Usable rows with ``dim`` and ``norm``, which differs by a trifle where lengths are equal."""
    square = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    norm = F.sqrt(square) * (1 + F.pmod(F.xxhash64("id"), F.lit(1_000_000)) * 1e-12)
    return usable(vectors, key, vector).select("id", "vector", F.size("vector").alias("dim"), norm.alias("norm"))


def lengths(rows: DataFrame) -> DataFrame:
    """``dim, n, least, rotations``: vectors of a dimension, above what norm they are candidates of every
    query, and rotations of a table."""
    shares = F.array(*[F.lit(1 - 0.5**k) for k in range(1, SHARES + 1)])
    per = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("norm", shares).alias("norms"))
    level = F.ceil(F.log2(4 * F.sqrt(F.col("n") / BLOCK))).cast("int")
    least = F.element_at("norms", F.greatest(F.lit(1), F.least(F.lit(SHARES), level)))
    full = [F.col("n") > BLOCK * F.pow(2 * F.col("dim"), F.lit(r)) for r in range(1, len(PROBES))]
    rotations = sum((f.cast("int") for f in full), F.lit(1))
    return per.select("dim", "n", least.alias("least"), rotations.alias("rotations"))


def in_table(rows: DataFrame, tab: int) -> DataFrame:
    """Rows of ``id, vector, dim`` as one bucket of each dimension."""
    return rows.select("id", "vector", "dim", F.lit(tab).alias("tab"), F.lit(0).cast("long").alias("axis"))


def best_found(index: DataFrame, asked: DataFrame, top: int) -> DataFrame:
    """``query_id, vec_id, score, rank, met``: the best that each query finds in its buckets, and among how
    many: the best of each block."""
    place = ["dim", "tab", "axis"]
    counts = index.groupBy(*place).agg(F.count(F.lit(1)).alias("nv")).join(
        asked.groupBy(*place).agg(F.count(F.lit(1)).alias("nq")), place
    )
    blocks = counts.select(
        *place, F.ceil(F.col("nv") / BLOCK).cast("int").alias("nvb"), F.ceil(F.col("nq") / BLOCK).cast("int").alias("nqb")
    )
    blocks = write_once(blocks, "axis-blocks")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def one(n: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.col(n)).cast("int")

    left = asked.join(blocks, place).withColumn("qb", one("nqb")).withColumn("vb", every("nvb"))
    right = index.join(blocks, place).withColumn("vb", one("nvb")).withColumn("qb", every("nqb"))

    def rank(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return best_of_block(np.empty(0), np.empty((0, 1)), np.empty(0), np.empty((0, 1)), top)
        q, x = (np.stack(side["vector"].to_numpy()).astype(np.float64) for side in (a, b))
        return best_of_block(a["id"].to_numpy(), q, b["id"].to_numpy(), x, top)

    cols = [*SPOT, "id", "vector"]
    found = left.select(*cols).groupBy(*SPOT).cogroup(right.select(*cols).groupBy(*SPOT))
    return best_of(found.applyInPandas(rank, "query_id long, vec_id long, score double"), top)


def best_of(found: DataFrame, top: int) -> DataFrame:
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    own = Window.partitionBy("query_id")
    ranked = found.withColumn("rank", F.row_number().over(own.orderBy(F.desc("score"), "vec_id")))
    return ranked.withColumn("met", F.count(F.lit(1)).over(own)).where(F.col("rank") <= top)


def candidates(rows: DataFrame, asks: DataFrame, tables: int, probes: tuple[int, ...]) -> tuple[DataFrame, DataFrame]:
    """The index, and where each query looks, both as rows of ``id, vector, dim, tab, axis``."""
    index = hashed(rows, tables, (1,) * len(probes)).union(in_table(rows.where("norm > least"), LONGEST))
    asked = hashed(asks, tables, probes).union(in_table(asks, LONGEST))
    return write_once(index, "axis-index"), write_once(asked, "axis-probes")


def search(
    vectors: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    top: int = TOP,
    tables: int = TABLES,
    probes: tuple[int, ...] = PROBES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found of every query, among all rows."""
    rows = write_once(sized(vectors, key, vector), "vectors")
    long = F.broadcast(write_once(lengths(rows), "lengths"))
    rows = rows.join(long, "dim")
    asks = write_once(sized(vectors.where(is_query), key, vector), "queries").join(long, "dim")
    index, asked = candidates(rows, asks, tables, probes)
    found = write_once(best_found(index, asked, top), "found")
    full = found.where((F.col("rank") == top) & (F.col("met") >= CROWD * top)).select(F.col("query_id").alias("id"))
    short = write_once(in_table(asks.join(full, "id", "left_anti"), ALL), "short")
    if not short.isEmpty():
        dims = F.broadcast(short.select("dim").distinct())
        rest = best_found(in_table(rows.join(dims, "dim", "left_semi"), ALL), short, top)
        found = best_of(found.drop("rank", "met").unionByName(rest.drop("rank", "met")), top)
    return found.select("query_id", "rank", "vec_id", "score")


def op6_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)
