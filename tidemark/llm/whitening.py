"""Whitening of embeddings by incremental eigendecomposition.

An entry ``c`` counts as the whole number ``floor(256 * c)``. Each distinct whole-number vector is once
on the fit list. Tasks take the list's vectors one by one into an eigendecomposition, by centred rank-one
updates with deflation (``spectra``); the tasks' spectra are joined by successive rank-one updates, few
of them in a task, level by level, until one is left. Its leading eigenvectors are then refined by
Rayleigh-Ritz steps: every task multiplies its part of the exact covariance with them, the sums give the
best eigenvectors in their span, and what these leave over widens the span for the next step, until
nothing is left over but rounding.

Copies of a vector are reduced to one before they are shuffled, so a hot vector costs nothing. Spectra,
sums and multiplied bases have the size of the dimension, whatever the number of rows; only ``BASIS``
columns of one pass to the driver.

Rows whose vector is null or holds a null, a NaN or an infinity are dropped, rows without id are not, and
rows that repeat are whitened each. Vectors of another length are whitened among themselves, with at most
``MAX_LENGTHS`` different lengths; an empty one has no components, and no row. A component without
variance has null in ``whitened`` and is left out of ``identity_error``, which is null where no component
has any; ``explained`` is null where the fit list has no variance at all. Entries beyond 2^53 / 256
fail, as no double holds them exactly, and so does a ``deviation`` beyond a long. An empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.spectra import EPS, Spectrum
from tidemark.llm.tables import table
from tidemark.session import collect_catalog, write_once

TOP = 4
#: Eigenvectors that the refinement starts from.
BASIS = 12
#: Spectra that one task joins.
JOINED = 8
MAX_LENGTHS = 64
MAX_PASSES = 30
SCALE = 256
SPECTRUM = "dim int, part long, n long, sums array<long>, eigen array<double>, vectors array<double>"


def quantised(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, x`` of every usable row: its entries as whole numbers."""
    v = F.col("v")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(
        v,
        lambda c: F.when(F.abs(c) * SCALE < 2.0**53, F.floor(c * SCALE)).otherwise(
            F.raise_error(F.lit("an entry is too large to be whitened exactly")).cast("long")
        ),
    )
    return rows.where(v.isNotNull() & fine).select("id", whole.alias("x"))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def by_length(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame]]:
    for b in batches:
        for dim, part in b.groupby(b["x"].map(len)):
            if dim:
                yield int(dim), part


def _rows(spectra: dict[int, Spectrum], part: int) -> pd.DataFrame:
    return pd.DataFrame(
        [(dim, part, s.n, s.sums.tolist(), s.values, s.vectors.ravel()) for dim, s in spectra.items()],
        columns=["dim", "part", "n", "sums", "eigen", "vectors"],
    )


def spectra_of(fit: DataFrame) -> DataFrame:
    """A spectrum for each length and task."""

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        held: dict[int, Spectrum] = {}
        for dim, part in by_length(batches):
            own = held.setdefault(dim, Spectrum(dim))
            for x in matrix(part["x"]):
                own.take(x)
        yield _rows(held, TaskContext.get().partitionId())

    return fit.mapInPandas(take, SPECTRUM)


def joined(spectra: DataFrame, size: int = JOINED) -> DataFrame:
    """One spectrum for each length."""

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        whole: Spectrum | None = None
        for r in rows.itertuples():
            own = Spectrum.of(r.n, r.sums, r.eigen, r.vectors)
            if whole is None:
                whole = own
            else:
                whole.join(own)
        return _rows({int(rows["dim"].iloc[0]): whole}, int(rows["part"].iloc[0]) // size)

    while True:
        spectra = write_once(spectra, "spectra")
        if not spectra.agg(F.max("part").alias("last")).first().last:
            return spectra
        spectra = spectra.groupBy("dim", F.expr(f"part div {size}")).applyInPandas(join, SPECTRUM)


@dataclass
class Fit:
    """What whitens vectors of one length: number, sums, components as columns, their variances."""

    n: int
    sums: np.ndarray
    trace: float
    basis: np.ndarray
    values: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return (self.sums / self.n).astype(np.float64)

    @property
    def varied(self) -> np.ndarray:
        return self.values > 8 * len(self.sums) * EPS * max(self.trace, 0.0)


def times_covariance(fit: DataFrame, bases: dict[int, tuple[np.ndarray, np.ndarray, int]]) -> dict[int, np.ndarray]:
    """The covariance times a basis, for each length: ``bases`` has mean, basis and number of vectors."""
    sent = fit.sparkSession.sparkContext.broadcast(bases)

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for dim, part in by_length(batches):
            mean, basis, _ = sent.value[dim]
            x = matrix(part["x"]) - mean
            sums[dim] = sums.get(dim, 0.0) + x.T @ (x @ basis)
        for dim, s in sums.items():
            yield pd.DataFrame({"dim": dim, "at": np.arange(s.size), "s": s.ravel()})

    parts = fit.mapInPandas(multiply, "dim int, at int, s double").groupBy("dim", "at").agg(F.sum("s").alias("s"))
    found = {dim: np.zeros(basis.size) for dim, (_, basis, _) in bases.items()}
    # As many rows as the bases have entries.
    for r in parts.collect():
        found[r.dim][r["at"]] = r.s
    return {dim: found[dim].reshape(basis.shape) / n for dim, (_, basis, n) in bases.items()}


def refined(fit: DataFrame, start: dict[int, tuple[np.ndarray, np.ndarray, int]], top: int) -> dict:
    """``dim -> (values, vectors)``: the ``top`` leading eigenpairs, by Rayleigh-Ritz steps."""
    open_, done, least = dict(start), {}, {}
    for _ in range(MAX_PASSES):
        products = times_covariance(fit, open_)
        for dim, (mean, basis, n) in list(open_.items()):
            product = products[dim]
            ritz = basis.T @ product
            values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
            values, turn = values[::-1], turn[:, ::-1]
            vectors, product = basis @ turn, product @ turn
            left = (product - vectors * values)[:, :top]
            size = np.linalg.norm(left, axis=0).max(initial=0.0)
            before = least.get(dim, (np.inf,))[0]
            if size < before:
                least[dim] = (size, values[:top], vectors[:, :top])
            # Rounding is all that is left, or no step makes it less.
            if size <= 4 * EPS * max(values[0], 0.0) * np.sqrt(dim) or size > before / 2:
                done[dim] = least[dim][1:]
                del open_[dim]
            else:
                wider, _ = np.linalg.qr(np.hstack((vectors, left)))
                open_[dim] = (mean, wider[:, :dim], n)
        if not open_:
            break
    done.update({dim: least[dim][1:] for dim in open_})
    return done


def identity_errors(fit: DataFrame, fits: dict[int, Fit]) -> dict[int, float | None]:
    """How far the covariance of the whitened fit list is from the identity, at most in any entry."""
    sent = fit.sparkSession.sparkContext.broadcast(fits)

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for dim, part in by_length(batches):
            w = whitened(matrix(part["x"]), sent.value[dim])[:, sent.value[dim].varied]
            w = np.hstack((np.ones((len(w), 1)), w))
            sums[dim] = sums.get(dim, 0.0) + w.T @ w
        for dim, s in sums.items():
            yield pd.DataFrame({"dim": dim, "at": np.arange(s.size), "s": s.ravel()})

    parts = fit.mapInPandas(gather, "dim int, at int, s double").groupBy("dim", "at").agg(F.sum("s").alias("s"))
    sums = {dim: np.zeros((f.varied.sum() + 1) ** 2) for dim, f in fits.items()}
    for r in parts.collect():
        sums[r.dim][r["at"]] = r.s
    errors: dict[int, float | None] = {}
    for dim, f in fits.items():
        k = int(f.varied.sum())
        s = sums[dim].reshape(k + 1, k + 1) / f.n
        off = np.abs(s[1:, 1:] - np.outer(s[0, 1:], s[0, 1:]) - np.eye(k))
        errors[dim] = float(off.max()) if k else None
    return errors


def fit_whitening(fit: DataFrame, top: int = TOP) -> dict[int, Fit]:
    """The fitted components of every length on a written fit list (column ``x``)."""
    # An even share of the vectors for every task, as each vector costs a decomposition's update.
    tasks = int(fit.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = joined(spectra_of(fit.where("size(x) > 0").repartition(tasks)))
    start, made = {}, {}
    for r in collect_catalog(leaders(whole), MAX_LENGTHS):
        sums = np.array(r.sums, object)
        basis = np.array(r.basis, np.float64).reshape(r.dim, -1)
        start[r.dim] = ((sums / r.n).astype(np.float64), basis, r.n)
        made[r.dim] = (r.n, sums, r.trace / r.n)
    pairs = refined(fit, start, top) if start else {}
    fits = {}
    for dim, (values, vectors) in pairs.items():
        n, sums, trace = made[dim]
        # Either sign is right; this one is the same in every run.
        largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
        fits[dim] = Fit(n, sums, trace, vectors * np.where(largest < 0, -1.0, 1.0), np.maximum(values, 0.0))
    return fits


def leaders(spectra: DataFrame) -> DataFrame:
    """``dim, n, sums, trace, basis``: the last ``BASIS`` eigenvectors only, and the sum of eigenvalues."""

    def lead(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame(
                [
                    (r.dim, r.n, r.sums, float(r.eigen.sum()), r.vectors.reshape(r.dim, -1)[:, -BASIS:].ravel())
                    for r in b.itertuples()
                ],
                columns=["dim", "n", "sums", "trace", "basis"],
            )

    schema = "dim int, n long, sums array<long>, trace double, basis array<double>"
    return spectra.mapInPandas(lead, schema)


def whitened(x: np.ndarray, fit: Fit) -> np.ndarray:
    """The components of each row, NaN where one has no variance; equal rows give equal bits."""
    scale = np.where(fit.varied, np.sqrt(fit.values), np.nan)
    apart = x - fit.mean
    return np.stack([(apart * column).sum(axis=1) for column in fit.basis.T], axis=1) / scale


def deviations(x: np.ndarray, fit: Fit) -> list[int]:
    """``sum((n * x - S) ** 2)`` of each row, exactly."""
    most = fit.n * int(np.abs(x).max(initial=0)) + max(map(abs, fit.sums.tolist()), default=0)
    if most * most * len(fit.sums) < 2**63:
        apart = fit.n * x - fit.sums.astype(np.int64)
        return (apart * apart).sum(axis=1).tolist()
    apart = fit.n * x.astype(object) - fit.sums
    return [int(d) for d in (apart * apart).sum(axis=1)]


WHITENED = (
    "vec_id string, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", top: int = TOP) -> DataFrame:
    """A row for every usable row of ``vectors`` and each of its ``top`` leading components.

    ``n`` is the length of the fit list, ``deviation`` the exact squared distance from its mean, times
    ``n`` squared, ``explained`` the component's share of all variance, and ``identity_error`` tells how
    far the covariance of the whitened fit list is from the identity.
    """
    rows = write_once(quantised(vectors, key, vector), "whole-vectors")
    fit = write_once(rows.select("x").distinct(), "fit-list")
    fits = fit_whitening(fit, top)
    errors = identity_errors(fit, fits) if fits else {}
    sent = rows.sparkSession.sparkContext.broadcast((fits, errors))

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fits, errors = sent.value
        for dim, part in by_length(batches):
            own, x = fits[dim], matrix(part["x"])
            k = len(own.values)
            shares = own.values / own.trace if own.trace > 0 else np.full(k, np.nan)
            yield pd.DataFrame(
                {
                    "vec_id": part["id"].repeat(k).array,
                    "component": np.tile(np.arange(1, k + 1), len(part)),
                    "n": own.n,
                    "deviation": np.repeat(np.array(deviations(x, own), object), k),
                    "whitened": whitened(x, own).ravel(),
                    "explained": np.tile(shares, len(part)),
                    "identity_error": errors[dim],
                }
            )

    # As text, ids beside nulls keep all their digits.
    found = rows.withColumn("id", F.col("id").cast("string")).mapInPandas(project, WHITENED)
    found = found.withColumn("vec_id", F.col("vec_id").cast("long"))
    blank = {c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in ("whitened", "explained", "identity_error")}
    return found.withColumns(blank)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))
