"""Whitening against a plain eigendecomposition, and its defined cases."""

import math

import numpy as np
import pytest

from tests.conftest import SMALL
from wardflow.llm import queries, whitening as wh


def plain(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(integer vectors, eigenvalues, eigenvectors, trace) by the library routine."""
    x = (np.floor(1024 * vectors.astype(np.float64)) + 100000).astype(np.int64)
    c = x - x.mean(axis=0)
    v = c.T @ c / len(x)
    values, turn = np.linalg.eigh(v)
    return x, values[::-1], turn[:, ::-1], float(np.trace(v))


def test_query_matches_plain_eigendecomposition(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    ids = {r.vec_id: i for i, r in enumerate(rows)}
    x, values, turn, trace = plain(np.array([r.embedding for r in rows]))
    n, total = len(x), x.sum(axis=0)
    got = queries.QUERIES["op13_feast_whitening"](spark, SMALL).collect()
    assert len(got) == 8 * n and len({(r.vec_id, r.component) for r in got}) == 8 * n
    want = (x - total / n) @ (turn[:, :8] / np.sqrt(values[:8]))
    mine = np.zeros_like(want)
    for r in got:
        mine[ids[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and abs(r.explained / (values[r.component - 1] / trace) - 1) < 1e-10
        assert r.deviation == sum(int(y) ** 2 for y in n * x[ids[r.vec_id]] - total)
    sign = np.sign((mine * want).sum(axis=0))
    assert np.abs(mine * sign - want).max() < 1e-9
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-10


@pytest.mark.parametrize("spectrum", [
    [9, 8, 7, 6, 5, 4, 3, 2, 1, .5, .1], [5] * 12 + [1] * 8, [1e6] + [1e-3] * 30, [3, 2], [1e3, 1, 1e-6, 0, 0, 0], list(np.linspace(1, 1.2, 40)),
])
def test_contour_finds_the_leading_pairs(spectrum):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.standard_normal((len(spectrum),) * 2))[0]
    v = q @ np.diag(np.array(spectrum, float)) @ q.T
    v = (v + v.T) / 2
    got = wh.leading(v)
    want = np.array(sorted((e for e in spectrum if e > 0), reverse=True)[:8])
    assert len(got.values) == len(want) and got.counted >= len(want)
    assert np.abs(got.values - want).max() < 1e-11 * max(spectrum)
    assert np.abs(got.vectors.T @ got.vectors - np.eye(len(want))).max() < 1e-12
    assert np.linalg.norm(v @ got.vectors - got.vectors * got.values) < 1e-10 * max(spectrum)


def test_inertia_counts_match_eigenvalues():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((30, 30))
    v = a @ a.T
    values = np.linalg.eigvalsh(v)
    for bound in [*((values[1:] + values[:-1]) / 2), values[0] / 2, values[-1] * 2, v[0, 0]]:
        assert wh.above(v, bound) == (values > bound).sum()


def test_filter_damps_what_lies_outside():
    v = np.diag([1.0, 2.0, 3.0, 10.0])
    out = wh.filtered(v, np.eye(4), 1.5, 3.5, 16)
    assert np.abs(out - np.diag([0, 1, 1, 0])).max() < 1e-6


ROW = "vec_id long, embedding array<double>, v int, i int, label int"


def test_rows_that_are_left_out(spark):
    fine = [[float(math.sin(7 * i + j)) for j in range(3)] for i in range(20)]
    bad = [None, [], [1.0, None, 2.0], [1.0, math.nan, 2.0], [math.inf, 0.0, 0.0], [1.0, 2.0], [1e300, 0.0, 0.0]]
    ids = [None, 3, 3, *range(4, 21)]
    table = spark.createDataFrame([(i, e, 1, 2, 3) for i, e in zip(ids, fine)] + [(100 + i, e, 1, 2, 3) for i, e in enumerate(bad)], ROW)
    got = wh.whiten(table).collect()
    assert len(got) == 60 and {r.component for r in got} == {1, 2, 3} and {r.n for r in got} == {20}
    assert {r.vec_id for r in got} == set(ids)
    assert abs(sum(r.whitened for r in got if r.component == 1)) < 1e-9


def test_tables_without_variance(spark):
    empty = spark.createDataFrame([], ROW)
    one = spark.createDataFrame([(1, [1.0, 2.0], 0, 0, 0)], ROW)
    same = spark.createDataFrame([(i, [1.0, 2.0], 0, 0, 0) for i in range(5)], ROW)
    for table in (empty, one, same):
        out = wh.whiten(table)
        assert out.count() == 0 and out.columns[:4] == ["vec_id", "component", "n", "deviation"]


def test_deviation_beyond_a_long_is_null():
    x = np.array([[100000, 100000], [100000 + (1 << 40), 100000]])
    got = wh.deviations(x, 2, x.sum(axis=0)).to_pylist()
    assert got == [None, None]
    assert wh.deviations(x[:1], 1, x[0]).to_pylist() == [0]
