"""Whitening by incremental eigendecomposition, against numpy on the whole matrix."""

import numpy as np
import pytest
from tidemark.llm.spectra import Spectrum, rank_one, secular_roots
from tidemark.llm.whitening import JOINED, op12_whitening, spectra_of, joined, whiten

SCHEMA = "vec_id long, embedding array<float>, n string"


def plain(vectors):
    """Whole numbers, fit list, eigenpairs by falling eigenvalue."""
    x = np.floor(256 * np.array(vectors, np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    values, basis = np.linalg.eigh(np.atleast_2d(np.cov(fit.T, bias=True)))
    return x, fit, values[::-1], basis[:, ::-1]


def check(rows, ids, vectors, top=4, tolerance=1e-8):
    x, fit, values, basis = plain(vectors)
    n, sums, top = len(fit), fit.sum(axis=0), min(top, fit.shape[1])
    want = (x - sums / n) @ basis[:, :top] / np.sqrt(values[:top])
    got = sorted(rows, key=lambda r: (r.vec_id, r.component))
    assert [(r.vec_id, r.component) for r in got] == [(i, c + 1) for i in sorted(ids) for c in range(top)]
    order = np.argsort(ids, kind="stable")
    w = np.array([r.whitened for r in got]).reshape(-1, top)
    signs = np.sign((w * want[order]).sum(axis=0))
    assert np.abs(w * signs - want[order]).max() < tolerance
    assert [r.deviation for r in got[::top]] == [int(d) for d in ((n * x - sums) ** 2).sum(axis=1)[order]]
    assert np.allclose([r.explained for r in got[:top]], values[:top] / values.sum(), rtol=1e-10)
    assert all(r.n == n and r.identity_error < 1e-9 for r in got)


@pytest.mark.parametrize("seed", range(5))
def test_rank_one_against_eigh(seed):
    rng = np.random.default_rng(seed)
    values = np.sort(np.repeat(rng.normal(size=8) ** 2, rng.integers(1, 4, 8)))
    vectors, _ = np.linalg.qr(rng.normal(size=(len(values),) * 2))
    v = vectors @ (rng.normal(size=len(values)) * rng.integers(0, 2, len(values)) * 10.0 ** rng.integers(-12, 3, len(values)))
    got, basis = rank_one(values, vectors, v)
    whole = vectors * values @ vectors.T + np.outer(v, v)
    assert np.abs(basis.T @ basis - np.eye(len(values))).max() < 1e-12
    assert np.abs(basis * got @ basis.T - whole).max() < 1e-13 * max(1, np.abs(whole).max()) * len(values)
    assert (np.diff(got) >= 0).all()


def test_secular_roots_close_to_poles():
    poles, weights = np.array([0.0, 1.0, 1.0 + 1e-9, 5.0]), np.array([1e-14, 1.0, 1e-16, 3.0])
    base, x = secular_roots(poles, weights)
    roots = poles[base] + x
    assert (roots >= poles).all() and (roots[:-1] <= poles[1:]).all()
    want = np.linalg.eigvalsh(np.diag(poles) + np.outer(np.sqrt(weights), np.sqrt(weights)))
    assert np.abs(roots - want).max() < 1e-12


def test_spectra_of_parts_join_to_that_of_all():
    rng = np.random.default_rng(3)
    x = rng.integers(-500, 500, (90, 7)) * np.arange(1, 8)
    parts = [Spectrum(7) for _ in range(3)]
    for i, row in enumerate(x):
        parts[min(i // 40, 2)].take(row)
    for other in parts[1:]:
        parts[0].join(other)
    scatter = np.cov(x.T, bias=True) * len(x)
    whole = parts[0]
    assert whole.n == 90 and whole.sums.tolist() == x.sum(axis=0).tolist()
    assert np.abs(whole.vectors * whole.values @ whole.vectors.T - scatter).max() < 1e-12 * scatter.max()


def test_many_tasks_are_joined_level_by_level(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(-90, 90, (200, 3))
    fit = spark.createDataFrame([(r.tolist(),) for r in x], "x array<long>").repartition(JOINED + 3)
    assert spectra_of(fit).count() == JOINED + 3
    (row,) = joined(spectra_of(fit)).collect()
    scatter = np.cov(x.T, bias=True) * len(x)
    assert (row.n, row.sums) == (200, x.sum(axis=0).tolist())
    assert np.allclose(row.eigen, np.linalg.eigvalsh(scatter), rtol=1e-11)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    fine = rng.normal(size=(60, 6)).astype(np.float32)
    ids = list(range(62))
    vectors = [*fine.tolist(), fine[7].tolist(), fine[8].tolist()]
    odd = [(90, None, "a"), (91, [1.0, None, 0.0, 0.0, 0.0, 0.0], "a"), (92, [float("nan")] * 6, "a"), (93, [float("inf")] * 6, None), (94, [], "a")]
    rows = [(i, v, "x") for i, v in zip(ids, vectors)] + odd
    check(whiten(spark.createDataFrame(rows, SCHEMA)).collect(), np.array(ids), vectors)
    twice = whiten(spark.createDataFrame(rows[:5] + rows[:1], SCHEMA)).collect()
    assert len([r for r in twice if r.vec_id == 0]) == 8 and len({tuple(map(str, r)) for r in twice if r.vec_id == 0}) == 4
    nobody = whiten(spark.createDataFrame([(None, fine[0].tolist(), ""), (2**60 + 1, fine[1].tolist(), "")], SCHEMA)).collect()
    assert {r.vec_id for r in nobody} == {None, 2**60 + 1}
    assert whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame(odd, SCHEMA)).count() == 0


def test_no_variance_and_too_few_dimensions(spark):
    same = whiten(spark.createDataFrame([(i, [1.0, 2.0], "") for i in range(5)], SCHEMA)).collect()
    assert len(same) == 10 and {r.n for r in same} == {1} and {r.deviation for r in same} == {0}
    assert {(r.whitened, r.explained, r.identity_error) for r in same} == {(None, None, None)}
    line = whiten(spark.createDataFrame([(i, [float(i), 2.0 * i], "") for i in range(5)], SCHEMA)).collect()
    second = [r for r in line if r.component == 2]
    assert all(r.whitened is None and r.explained == pytest.approx(0, abs=1e-12) for r in second)
    assert all(r.identity_error < 1e-9 for r in line)


def test_lengths_are_whitened_apart(spark):
    rng = np.random.default_rng(2)
    short, long = rng.normal(size=(30, 3)), rng.normal(size=(50, 9))
    rows = [(i, v.tolist(), "") for i, v in enumerate([*short, *long])]
    got = whiten(spark.createDataFrame(rows, SCHEMA.replace("float", "double"))).collect()
    check([r for r in got if r.vec_id < 30], np.arange(30), short)
    check([r for r in got if r.vec_id >= 30], np.arange(30, 80), long)


def test_large_entries_are_exact_or_refused(spark):
    rows = [(i, [float(i * 2**14 + 1), float(-i)], "") for i in range(20)]
    ids, vectors = np.arange(20), [v for _, v, _ in rows]
    x, fit, _, _ = plain(vectors)
    got = {r.vec_id: r.deviation for r in whiten(spark.createDataFrame(rows, SCHEMA.replace("float", "double"))).collect()}
    apart = 20 * x.astype(object) - fit.astype(object).sum(axis=0)
    assert [got[i] for i in ids] == [int(d) for d in (apart * apart).sum(axis=1)]
    with pytest.raises(Exception, match="too large"):
        whiten(spark.createDataFrame([(1, [1e30], "")], SCHEMA)).collect()


def test_query_on_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    check(op12_whitening(spark, folder).collect(), np.array([r.vec_id for r in given]), [r.embedding for r in given])
